"""Airport dimension and its single steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from delayworks.functions.frequencies import CANONICAL, LITERAL_RULES, canonical_type as canonical
from delayworks.operators import airports as ap
from delayworks.plans import fixtures as fx
from delayworks.plans.oracle import sql
from delayworks.plans.registry import query

IDS = ("airport_id", "ident", "name", "airport_type", "municipality", "iso_country", "iso_region", "continent",
       "latitude_deg", "longitude_deg", "elevation_ft", "scheduled_service_bool", "has_geo")
IDS_SQL = ", ".join(IDS)


def us_airports(spark, d):
    return ap.airport_filter(ap.load_airports(fx.airports(spark, d)))


def core(spark, d):
    airports = us_airports(spark, d)
    freqs = ap.frequencies_of(ap.load_frequencies(fx.frequencies(spark, d)), airports)
    return ap.airport_core(freqs, airports)


def wide(spark, d):
    return ap.airport_dimension(fx.airports(spark, d), fx.frequencies(spark, d))


def as_text(df):
    """Frequency sets as text with three decimals."""
    text = lambda c: F.array_join(F.transform(c, lambda x: F.format_string("%.3f", x)), "|")
    return df.withColumns({f"freq_{c}": text(f"freq_{c}") for c in CANONICAL})


_SETS = ", ".join(
    f"""coalesce(string_agg(DISTINCT printf('%.3f', frequency_mhz), '|' ORDER BY printf('%.3f', frequency_mhz))
        FILTER (WHERE canonical_type = '{c}'), '') AS freq_{c}""" for c in CANONICAL)
_HAS = ", ".join(f"count(*) FILTER (WHERE canonical_type = '{c}') > 0 AS has_{c}" for c in CANONICAL)


@query("airport_filter", sql(f"SELECT {IDS_SQL} FROM us_airports", "us_airports"))
def airport_filter(spark, d):
    return us_airports(spark, d).select(*IDS)


@query("airport_filter_scheduled", sql("SELECT airport_id, ident FROM us_airports WHERE scheduled_service_bool", "us_airports"))
def airport_filter_scheduled(spark, d):
    rows = ap.airport_filter(ap.load_airports(fx.airports(spark, d)), scheduled_only=True)
    return rows.select("airport_id", "ident")


@query("freqs_semi", sql("""
    SELECT id AS freq_id, airport_ref, type AS freq_type FROM fx_freqs
    WHERE airport_ref IN (SELECT airport_id FROM us_airports) AND type IN ('TWR', 'APP', 'A/D', 'ATIS', 'AWOS', 'GND')""",
    "fx_freqs", "us_airports"))
def freqs_semi(spark, d):
    types = ("twr", "app", "a/d", "atis", "awos", "gnd")
    rows = ap.frequencies_of(ap.load_frequencies(fx.frequencies(spark, d)), us_airports(spark, d), types)
    return rows.select("freq_id", "airport_ref", "freq_type")


@query("airport_core", sql(f"SELECT freq_id, airport_ref, {IDS_SQL}, ident_match FROM core", "core"))
def airport_core(spark, d):
    return core(spark, d).select("freq_id", "airport_ref", *IDS, "ident_match")


@query("canonical_type", sql("SELECT freq_id, freq_type, description, canonical_type FROM core", "core"))
def canonical_type(spark, d):
    return core(spark, d).select("freq_id", "freq_type", "description", "canonical_type")


@query("canonical_type_literal", sql(r"""
    SELECT id AS freq_id, CASE
        WHEN regexp_matches(w, '\b(twr|tower)\b') THEN 'tower' WHEN regexp_matches(w, '\b(gnd|ground)\b') THEN 'ground'
        WHEN regexp_matches(w, '\b(app|appr|aprch|approach)\b') THEN 'approach'
        WHEN regexp_matches(w, '\b(dep|dept|departure)\b') THEN 'departure'
        WHEN regexp_matches(w, 'a[_/]*d|app[_/]*dep|approach[_/]*departure') THEN 'approach_departure'
        WHEN regexp_matches(w, '\b(d[_]*atis|d-atis|atis)\b') THEN 'atis'
        WHEN regexp_matches(w, '\b(awos|wx[_]*asos|wxas|asos)\b') THEN 'awos'
        WHEN regexp_matches(w, 'ctaf|unicom') THEN 'ctaf_unicom'
        WHEN regexp_matches(w, 'cld|clr|clnc[_]*del|clearance') THEN 'clearance_delivery'
        WHEN regexp_matches(w, '\b(fss|rfss|rco)\b') THEN 'fss' WHEN regexp_matches(w, '\b(cntr|ctr|center)\b') THEN 'center'
        ELSE 'other' END AS canonical_type
    FROM (SELECT id, lower(regexp_replace(type || ' ' || coalesce(description, ''), '[\s\-]+', '_', 'g')) AS w FROM fx_freqs)""", "fx_freqs"))
def canonical_type_literal(spark, d):
    return fx.frequencies(spark, d).select(F.col("id").alias("freq_id"), canonical("type", rules=LITERAL_RULES).alias("canonical_type"))


@query("airport_wide", sql(f"SELECT airport_id, max(ident_match) AS ident_match, {_SETS} FROM core GROUP BY airport_id", "core"))
def airport_wide(spark, d):
    return wide(spark, d).transform(as_text).select("airport_id", "ident_match", *[f"freq_{c}" for c in CANONICAL])


@query("airport_has_flags", sql(f"SELECT airport_id, {_HAS} FROM core GROUP BY airport_id", "core"))
def airport_has_flags(spark, d):
    return wide(spark, d).select("airport_id", *[f"has_{c}" for c in CANONICAL])


@query("airport_subset", sql("""
    SELECT DISTINCT c.airport_id, c.ident, a.iata_code, c.name, c.iso_region FROM core c JOIN fx_airports a ON a.id = c.airport_id
    WHERE a.iata_code IN ('JFK', 'LGA', 'EWR') OR c.ident_norm IN ('KJFK', 'KLGA', 'KEWR', 'K00007')""", "core"))
def airport_subset(spark, d):
    rows = ap.airport_subset(wide(spark, d), fx.airports(spark, d), ["jfk", " LGA", "EWR", "00007"])
    return rows.select("airport_id", "ident", "iata_code", "name", "iso_region")


@query("airport_dimension", sql(f"""
    SELECT {IDS_SQL}, max(ident_match) AS ident_match, {_SETS}, {_HAS} FROM core GROUP BY {IDS_SQL}""", "core"))
def airport_dimension(spark, d):
    return wide(spark, d).transform(as_text)
