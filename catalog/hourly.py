"""Dates, hours, sentinels and the hourly clean-up, on text derived from orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import table
from ridgeworks.functions.clock import day_first_date, hour_of, iso_date, month_first_date, without_sentinel
from ridgeworks.plans import hourly
from ridgeworks.sources.tables import parse_log


def parse_date(spark, folder):
    text = F.date_format("o_orderdate", "M/d/yy")
    return table(spark, folder, "orders").select("o_orderkey", iso_date(month_first_date(text)).alias("day"))


def parse_date_mixed(spark, folder):
    short, full = F.date_format("o_orderdate", "d/M/yy"), F.date_format("o_orderdate", "dd/MM/yyyy")
    text = F.when(F.col("o_custkey") % 2 == 0, short).otherwise(full)
    return table(spark, folder, "orders").select("o_orderkey", iso_date(day_first_date(text)).alias("day"))


def hour_from_time(spark, folder):
    text = F.date_format("ts", "H:mm")
    return table(spark, folder, "events").select("event_id", hour_of(text).alias("hour"))


def _reading():
    """Event value as logged text, with both forms of a missing value."""
    kind = F.col("event_type")
    return (
        F.when(kind == "error", "NoData").when(kind == "view", "-999").otherwise(F.col("value").cast("string"))
    )


def sentinel_to_null(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", without_sentinel(_reading()).alias("pm25"))


def hour_skeleton(spark, folder):
    spans = table(spark, folder, "events").groupBy("event_type").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    rows = hourly.hour_skeleton(spans, "first", "last", "event_type")
    return rows.select("event_type", iso_date(F.col("date")).alias("date"), "hour")


def log_lines(spark, folder):
    """Events as blank-separated log lines with two date forms and uneven blanks."""
    even = F.col("event_id") % 2 == 0
    day = F.when(even, F.date_format("ts", "d/M/yy")).otherwise(F.date_format("ts", "dd/MM/yyyy"))
    fields = [
        day,
        F.date_format("ts", "HH:mm"),
        F.date_format("ts", "a"),
        _reading(),
        F.col("user_id").cast("string"),
        F.lit("NoData"),
        F.col("event_type"),
        F.col("event_id").cast("string"),
    ]
    gap = F.when(even, "  ").otherwise(" \t")
    line = fields[0]
    for field in fields[1:]:
        line = F.concat(line, gap, field)
    return table(spark, folder, "events").select(F.concat(F.lit(" "), line).alias("value"))


def parsed_log(spark, folder):
    rows = parse_log(log_lines(spark, folder))
    return rows.select("time", "AMPM", "delhipm", "delhiaqi", "chennaipm", "aqichenn", "pmkol")


def clean_hourly(spark, folder):
    return hourly.clean_hourly(parse_log(log_lines(spark, folder)))


def clean_hourly_csv(spark, folder):
    rows = table(spark, folder, "events").select(
        F.date_format("ts", "M/d/yy").alias("DATES"),
        F.date_format("ts", "H").alias("HH"),
        _reading().alias("PM2.5"),
    )
    return hourly.clean_hourly_csv(rows)


QUERIES = {
    "parse_date": parse_date,
    "parse_date_mixed": parse_date_mixed,
    "hour_from_time": hour_from_time,
    "sentinel_to_null": sentinel_to_null,
    "hour_skeleton": hour_skeleton,
    "parse_log": parsed_log,
    "clean_hourly": clean_hourly,
    "clean_hourly_csv": clean_hourly_csv,
}

VALUE_SQL = "CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END"
ORDER_DAYS = "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"
CLEAN = f"""
    SELECT strftime(ts, '%Y-%m-%d') AS "DATES", CAST(hour(ts) AS DOUBLE) AS "HH", {VALUE_SQL} AS pm25 FROM events"""

ORACLES = {
    "parse_date": ORDER_DAYS,
    "parse_date_mixed": ORDER_DAYS,
    "hour_from_time": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events",
    "sentinel_to_null": f"SELECT event_id, {VALUE_SQL} AS pm25 FROM events",
    "hour_skeleton": """
        WITH s AS (SELECT event_type, min(ts)::DATE AS a, max(ts)::DATE AS b FROM events GROUP BY event_type)
        SELECT event_type, strftime(a + CAST(i AS INTEGER), '%Y-%m-%d') AS date, CAST(h AS INTEGER) AS hour
        FROM s, range(0, 10000) t(i), range(0, 24) u(h) WHERE a + CAST(i AS INTEGER) <= b""",
    "parse_log": """
        SELECT strftime(ts, '%H:%M') AS time, strftime(ts, '%p') AS "AMPM",
               CASE event_type WHEN 'error' THEN 'NoData' WHEN 'view' THEN '-999'
                    ELSE CAST(value AS VARCHAR) END AS delhipm,
               CAST(user_id AS VARCHAR) AS delhiaqi, 'NoData' AS chennaipm, event_type AS aqichenn,
               CAST(event_id AS VARCHAR) AS pmkol
        FROM events""",
    "clean_hourly": CLEAN,
    "clean_hourly_csv": CLEAN,
}
