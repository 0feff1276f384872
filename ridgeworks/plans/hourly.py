"""Clean-up of hourly readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.clock import day_first_date, hour_of, iso_date, month_first_date, number, without_sentinel


def hour_skeleton(spans: DataFrame, first: str, last: str, *keys: str) -> DataFrame:
    """Every hour of every day from ``first`` to ``last``: (keys, date, hour) per input row."""
    days = F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date")))
    dated = spans.select(*keys, days.alias("date"))
    return dated.select(*keys, "date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))


def clean_hourly(readings: DataFrame, value: str = "delhipm") -> DataFrame:
    """Log lines (date d/M/yy or d/M/yyyy, time HH:MM, values) to (DATES, HH, pm25)."""
    return readings.select(
        iso_date(day_first_date(F.col("date"))).alias("DATES"),
        hour_of(F.col("time")).cast("double").alias("HH"),
        without_sentinel(F.col(value)).alias("pm25"),
    )


def clean_hourly_csv(readings: DataFrame, dates: str = "DATES", hour: str = "HH", value: str = "PM2.5") -> DataFrame:
    """CSV readings with month-first dates to (DATES, HH, pm25)."""
    return readings.select(
        iso_date(month_first_date(F.col(f"`{dates}`"))).alias("DATES"),
        number(F.col(f"`{hour}`").cast("string")).alias("HH"),
        without_sentinel(F.col(f"`{value}`").cast("string")).alias("pm25"),
    )
