"""Airport dimension with its radio frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions.frequencies import CANONICAL, TOKEN_RULES, canonical_type
from delayworks.operators.cleaning import keep_first
from delayworks.operators.joins import lookup_join

# Descriptive columns of an airport.
AIRPORT_IDS = (
    "airport_id", "ident", "name", "airport_type", "municipality", "iso_country", "iso_region",
    "continent", "latitude_deg", "longitude_deg", "elevation_ft", "scheduled_service_bool", "has_geo",
)


def _norm(column: str):
    return F.upper(F.trim(F.col(column)))


def _one_per(df: DataFrame, key: str) -> DataFrame:
    rest = sorted(c for c in df.columns if c != key)
    return keep_first(df, [key], [F.col(c).asc_nulls_first() for c in rest])


def load_airports(raw: DataFrame) -> DataFrame:
    """Airports with normalised keys, one row per id."""
    named = raw.withColumnsRenamed({"id": "airport_id", "type": "airport_type"})
    service = _norm("scheduled_service")
    return _one_per(named.withColumns({
        "ident_norm": _norm("ident"),
        "iso_country_norm": _norm("iso_country"),
        "scheduled_service_bool": F.when(service == "YES", True).when(service == "NO", False),
        "has_geo": F.col("latitude_deg").isNotNull() & F.col("longitude_deg").isNotNull(),
    }), "airport_id")


def load_frequencies(raw: DataFrame) -> DataFrame:
    """Frequencies with normalised keys, one row per id."""
    named = raw.withColumnsRenamed({"id": "freq_id", "type": "freq_type"})
    return _one_per(named.withColumns({
        "airport_ident_norm": _norm("airport_ident"),
        "freq_type_norm": _norm("freq_type"),
    }), "freq_id")


def airport_filter(airports: DataFrame, country: str = "US", scheduled_only: bool | None = None) -> DataFrame:
    kept = airports.where(F.col("iso_country_norm") == country)
    if scheduled_only is not None:
        kept = kept.where(F.col("scheduled_service_bool") == F.lit(scheduled_only))
    return kept


def frequencies_of(freqs: DataFrame, airports: DataFrame, types=None) -> DataFrame:
    """Frequencies that belong to the kept airports, optionally of listed types only."""
    keys = airports.select(F.col("airport_id").alias("airport_ref"))
    kept = lookup_join(freqs, keys, ["airport_ref"], "left_semi")
    return kept.where(F.col("freq_type_norm").isin(*[t.upper() for t in types])) if types else kept


def airport_core(freqs: DataFrame, airports: DataFrame, rules=TOKEN_RULES) -> DataFrame:
    """Frequencies with their airport, the ident match and the canonical type."""
    parents = airports.withColumn("airport_ref", F.col("airport_id"))
    match = F.when(F.col("airport_ident_norm") == F.col("ident_norm"), 1).otherwise(0).cast("int")
    return lookup_join(freqs, parents, ["airport_ref"]).withColumns({
        "ident_match": match,
        "canonical_type": canonical_type(rules=rules),
    })


def airport_wide(core: DataFrame) -> DataFrame:
    """One row per airport: the set of frequencies of every canonical type, and presence flags.

    Each array is a set of channels of the radio band, whatever the number of records.
    """
    ids = [c for c in AIRPORT_IDS if c in core.columns]
    of_type = lambda c: F.when(F.col("canonical_type") == c, F.col("frequency_mhz"))
    sets = [F.array_sort(F.collect_set(of_type(c))).alias(f"freq_{c}") for c in CANONICAL]
    wide = core.groupBy(*ids).agg(F.max("ident_match").alias("ident_match"), *sets)
    return wide.withColumns({f"has_{c}": F.size(f"freq_{c}") > 0 for c in CANONICAL})


def airport_subset(wide: DataFrame, airports_raw: DataFrame, codes) -> DataFrame:
    """Airports whose code is listed, or whose ident is 'K' followed by a listed code."""
    codes = sorted({c.strip().upper() for c in codes})
    names = airports_raw.select(F.col("id").alias("airport_id"), _norm("iata_code").alias("iata_code"))
    rows = lookup_join(wide, names, ["airport_id"])
    listed = F.col("iata_code").isin(*codes) | _norm("ident").isin(*[f"K{c}" for c in codes])
    return rows.where(listed)


def airport_dimension(airports_raw: DataFrame, freqs_raw: DataFrame, rules=TOKEN_RULES,
                      scheduled_only: bool | None = None, types=None) -> DataFrame:
    airports = airport_filter(load_airports(airports_raw), scheduled_only=scheduled_only)
    freqs = frequencies_of(load_frequencies(freqs_raw), airports, types)
    return airport_wide(airport_core(freqs, airports, rules))
