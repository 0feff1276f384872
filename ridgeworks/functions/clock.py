"""Column expressions for hourly logs: dates, hours, sentinels, numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: two-digit years 69-99 belong to the 1900s, 00-68 to the 2000s
PIVOT_YEAR = 2069


def short_year_date(text: Column, pattern: str) -> Column:
    """Parse a date with a two-digit year (``yy`` in the pattern); null where it does not parse."""
    parsed = F.try_to_date(text, pattern)
    return F.when(F.year(parsed) >= PIVOT_YEAR, F.add_months(parsed, -1200)).otherwise(parsed)


def month_first_date(text: Column) -> Column:
    return short_year_date(text, "M/d/yy")


def day_first_date(text: Column) -> Column:
    """d/M/yyyy or d/M/yy in the same column; the four-digit form is tried first."""
    return F.coalesce(F.try_to_date(text, "d/M/yyyy"), short_year_date(text, "d/M/yy"))


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def hour_of(text: Column) -> Column:
    """The number before the last three characters of "HH:MM"; null where it is not a number."""
    return F.substr(text, F.lit(1), F.length(text) - 3).try_cast("int")


def number(text: Column) -> Column:
    return text.try_cast("double")


def without_sentinel(text: Column, missing: float = -999.0) -> Column:
    """Number from text; words such as "NoData" and the missing-value code become null."""
    return F.nullif(number(text), F.lit(missing))
