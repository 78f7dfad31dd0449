"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def documents(spark, rows=None):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rng = random.Random(5)
    given = rows if rows is not None else [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45),
        (2, "Alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 4),
        (6, LONG, "en", "a", len(LONG)),
        (7, "one two three", "fr", "c", 13),
        (7, "one two three", "fr", "c", 13),
        (7, "another text of the same id", "fr", "c", 27),
        (None, "no id at all in this row", "de", None, 24),
        (None, "no id at all in this row", "de", None, 24),
        *((100 + i, " ".join(rng.choice("red green blue black white grey".split()) for _ in range(rng.randint(1, 80))), "en",
           rng.choice(["a", "a", "b", "c", None]), 1) for i in range(60)),
    ]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("id", "key", "label", "score", "size", "fp", "start", "length", "class", "rank", "offset", "words", "quality_score")
    for name in clash:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
