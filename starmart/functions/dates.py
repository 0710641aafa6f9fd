"""Date functions: lenient text -> date, calendar-year difference, week of month."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.util import as_col

# Accepted shapes: Y-M-D or Y/M/D (same separator twice, 1-6 digit year),
# optionally followed by a time of day and a zone suffix.  Anything else
# (bare year, year-month, trailing junk, M/D/Y) is not a date.
_FULL = (r"^\s*\d{1,6}([-/])\d{1,2}\1\d{1,2}"
         r"(\s*|[ T]([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d(\.\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?\s*)$")
_PARTS = r"^\s*(\d{1,6})[-/](\d{1,2})[-/](\d{1,2})"


def try_date(c) -> Column:
    """TRY_CAST(text AS DATE) with the lenient-but-strict rules of the marts.

    Invalid calendar days (2020-02-30) give NULL; the year is read as a number
    of up to six digits (20-01-05 -> year 20, 00001-01-01 -> year 1,
    12345-01-02 -> year 12345).  The date is built from its integer parts,
    and only for a month in 1..12 and a day within that month.
    """
    v = as_col(c).cast("string")
    y, m, d = (F.regexp_extract(v, _PARTS, i).try_cast("int") for i in (1, 2, 3))
    days_in_month = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return F.when(v.rlike(_FULL) & m.between(1, 12),
                  F.when(d.between(F.lit(1), days_in_month), F.make_date(y, m, d)))


def to_date(c) -> Column:
    """Timestamp / timestamp_ntz / date column -> DATE."""
    return as_col(c).cast("date")


def year_diff(start, end) -> Column:
    """Number of calendar-year boundaries crossed: year(end) - year(start)."""
    return F.year(as_col(end)) - F.year(as_col(start))


def as_of_date(as_of: _dt.date | str | None) -> Column:
    """A DATE literal for ``as_of``; ``current_date()`` when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def week_of_month(d) -> Column:
    """CEIL(day / 7): days 1-7 -> 1, 8-14 -> 2, 29-31 -> 5."""
    return F.ceil(F.dayofmonth(as_col(d)) / F.lit(7.0)).cast("int")


def week_start(ts) -> Column:
    """Monday of the ISO week holding ``ts``, as DATE."""
    return F.date_trunc("week", as_col(ts)).cast("date")
