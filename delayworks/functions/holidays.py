"""Federal holidays as arithmetic on the date itself.

A date is tested against the rules where it stands, so flagging rows needs no
calendar table, no join and no Python function.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (name, month, day of month, first year).
FIXED_DATES = (
    ("New Year's Day", 1, 1, 1),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1),
    ("Veterans Day", 11, 11, 1),
    ("Christmas Day", 12, 25, 1),
)
# Fixed values: (name, month, weekday with 1 = Sunday, first and last day it can fall on, first year).
FLOATING_DATES = (
    ("Martin Luther King Jr. Day", 1, 2, 15, 21, 1986),
    ("Washington's Birthday", 2, 2, 15, 21, 1),
    ("Memorial Day", 5, 2, 25, 31, 1),
    ("Labor Day", 9, 2, 1, 7, 1),
    ("Columbus Day", 10, 2, 8, 14, 1),
    ("Thanksgiving Day", 11, 5, 22, 28, 1),
)


def _place(month: int, day: int, weekday: int) -> int:
    return month * 1000 + day * 10 + weekday


def _rules() -> list[tuple[str, int, list[int]]]:
    """(name, first year, places): a place is month, day and weekday in one number.

    A fixed date counts on every weekday; when it falls on a Sunday or Saturday, the
    Monday after or the Friday before is observed as well.
    """
    every = range(1, 8)
    rules = [(n, since, [_place(m, d, w) for w in every]) for n, m, d, since in FIXED_DATES]
    rules += [(n, since, [_place(m, d, dow) for d in range(first, last + 1)])
              for n, m, dow, first, last, since in FLOATING_DATES]
    for name, month, day, since in FIXED_DATES:
        date = datetime.date(2023, month, day)  # no rule touches the end of February
        before, after = date - datetime.timedelta(days=1), date + datetime.timedelta(days=1)
        places = [_place(after.month, after.day, 2), _place(before.month, before.day, 6)]
        rules.append((f"{name} (observed)", since, places))
    return rules


def _place_of(date: Column) -> Column:
    return F.month(date) * 1000 + F.dayofmonth(date) * 10 + F.dayofweek(date)


def holiday_name(date) -> Column:
    """Name of the holiday on a date, '(observed)' for a weekday standing in for a weekend; else null."""
    date = F.col(date) if isinstance(date, str) else date
    place, year = _place_of(date), F.year(date)
    return F.coalesce(*[F.when(place.isin(places) & (year >= since), F.lit(name)) for name, since, places in _rules()])


def is_public_holiday(date="FlightDate") -> Column:
    """1 on a holiday or its observed day. One set lookup per row for each first year."""
    date = F.col(date) if isinstance(date, str) else date
    by_year: dict[int, list[int]] = {}
    for _, since, places in _rules():
        by_year.setdefault(since, []).extend(places)
    place, year = _place_of(date), F.year(date)
    hits = [place.isin(places) & (year >= since) for since, places in sorted(by_year.items())]
    return F.when(reduce(lambda a, b: a | b, hits), 1).otherwise(0).cast("int")
