"""Canonical type of a radio-frequency record from its free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The canonical names, which are also column names.
CANONICAL = (
    "tower", "ground", "approach", "departure", "approach_departure", "atis",
    "awos", "ctaf_unicom", "clearance_delivery", "fss", "center", "other",
)
# Ordered words of each type.
WORDS = (
    ("twr|tower", "tower"),
    ("gnd|ground", "ground"),
    ("app|appr|aprch|approach", "approach"),
    ("dep|dept|departure", "departure"),
    ("a[_/]*d", "approach_departure"),
    ("d[_]*atis|atis", "atis"),
    ("awos|wx[_]*asos|wxas|asos", "awos"),
    ("ctaf|unicom", "ctaf_unicom"),
    ("cld|clr|clnc[_]*del|clearance", "clearance_delivery"),
    ("fss|rfss|rco", "fss"),
    ("cntr|ctr|center", "center"),
)
# Types whose words may stand anywhere in the text, and the literal patterns that are more than their words.
ANYWHERE = ("ctaf_unicom", "clearance_delivery")
LITERAL = {
    "approach_departure": r"(a[_/]*d|app[_/]*dep|approach[_/]*departure)",
    "atis": r"\b(d[_]*atis|d-atis|d_atis|atis)\b",
    "ctaf_unicom": r"(ctaf.*|.*ctaf|unicom)",
    "clearance_delivery": r"(cld|clr|clnc[_]*del|clrd|clrn|clearance)",
}

# '_' and '/' are word limits here, so 'twr_' is a tower and 'radio' is not an approach/departure pair.
TOKEN_RULES = tuple((w if kind in ANYWHERE else f"(^|[^a-z0-9])({w})([^a-z0-9]|$)", kind) for w, kind in WORDS)
# The same rules with word boundaries that do not see '_' as a limit.
LITERAL_RULES = tuple((LITERAL.get(kind, rf"\b({w})\b"), kind) for w, kind in WORDS)


def canonical_type(kind="freq_type", description="description", rules=TOKEN_RULES) -> Column:
    """First rule that matches the record's type and description, 'other' when none does."""
    words = F.concat_ws(" ", F.coalesce(F.col(kind), F.lit("")), F.coalesce(F.col(description), F.lit("")))
    words = F.lower(F.regexp_replace(words, r"[\s\-]+", "_"))
    hits = [F.when(words.rlike(pattern), F.lit(name)) for pattern, name in rules]
    return F.coalesce(*hits, F.lit(CANONICAL[-1]))
