"""Expressions on flight columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metro area, the delay cut-offs and the flag thresholds.
METRO = ("JFK", "LGA", "EWR")
DELAYED_MINUTES = 15
CLASS_CUTS = (60.0, 120.0)
RARE_BELOW = 3
ABNORMAL_ABOVE = 8000
PEAK_ABOVE = 2.0


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0).cast("int")


def date_from_parts(year="YEAR", month="MONTH", day="DAY_OF_MONTH") -> Column:
    """Date from its parts; null when they do not form a date."""
    parts = [_c(p).try_cast("int") for p in (year, month, day)]
    return F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def tolerant_date(column) -> Column:
    """Date out of mixed text: the first 19 characters as a time stamp, else the first 10 as a date."""
    text = _c(column).cast("string")
    stamp = F.try_to_timestamp(F.substring(text, 1, 19))
    day = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))
    return F.coalesce(stamp, day).cast("date")


def year_month(year="YEAR", month="MONTH") -> Column:
    """'YYYY-MM' partition key."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def month_floor(date) -> Column:
    return F.trunc(_c(date), "MM")


def touches_metro(metro=METRO, origin="ORIGIN", dest="DEST") -> Column:
    return _c(origin).isin(*metro) | _c(dest).isin(*metro)


def sort_time(metro=METRO) -> Column:
    """Scheduled departure when leaving the metro area, scheduled arrival otherwise."""
    return F.when(F.col("ORIGIN").isin(*metro), F.col("CRS_DEP_TIME")).otherwise(F.col("CRS_ARR_TIME"))


def is_delayed_15(delay="ARR_DELAY_NEW") -> Column:
    return flag(_c(delay) >= DELAYED_MINUTES)


def day_of_week(date="FlightDate") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(date))


def is_weekend(date="FlightDate") -> Column:
    return flag(F.dayofweek(_c(date)).isin(1, 7))


def delay_class(dep="DEP_DELAY_NEW", arr="ARR_DELAY_NEW") -> Column:
    """0, 1 or 2 by the worse of the two delays; a missing delay counts as none."""
    worst = F.greatest(*[F.coalesce(_c(c), F.lit(0.0)) for c in (dep, arr)])
    return sum((flag(worst >= cut) for cut in CLASS_CUTS[1:]), flag(worst >= CLASS_CUTS[0]))


def three_hour_bucket(block) -> Column:
    """'HHMM-HHMM' label of the three-hour bucket in which an hourly block starts."""
    block = _c(block)
    hour = F.substring(block, 1, 2).try_cast("int")
    start = F.when(hour >= 21, 21).otherwise(F.floor(hour / 3) * 3).cast("int")
    edge = lambda h: F.lpad(h.cast("string"), 2, "0")
    label = F.concat(edge(start), F.lit("00-"), edge(start + 2), F.lit("59"))
    return F.when(F.length(block) >= 4, label)


def bucket_slot(bucket) -> Column:
    """Start time 'HHmm' of a bucket label, the key of the weather slots."""
    return F.substring(_c(bucket), 1, 4)


def flight_id() -> Column:
    return F.concat_ws("_", F.col("OP_UNIQUE_CARRIER"), F.col("OP_CARRIER_FL_NUM").cast("string"))


def is_abnormal_num() -> Column:
    return flag(F.col("OP_CARRIER_FL_NUM") > ABNORMAL_ABOVE)


def is_peak_day() -> Column:
    return flag(F.col("volume_zscore") > PEAK_ABOVE)


def is_extra_candidate() -> Column:
    rare, odd = F.col("is_rare") == 1, F.col("is_abnormal_num") == 1
    peak, holiday = F.col("is_peak_day") == 1, F.col("IsPublicHoliday") == 1
    return flag(rare | odd | (rare & peak) | (odd & holiday))
