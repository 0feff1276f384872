"""Scaling reports over a run log derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import table
from ridgeworks.operators.matrix import transpose_table
from ridgeworks.plans import reports

THREADS = [1, 2, 4, 8]


def run_log(spark, folder):
    """(config, threads, total_s, parallel_s, overhead_s), one row per event."""
    share = F.pmod(F.col("event_id"), F.lit(10)) / 10
    return table(spark, folder, "events").select(
        F.col("event_type").alias("config"),
        F.pow(F.lit(2), F.pmod(F.col("event_id"), F.lit(4))).cast("int").alias("threads"),
        F.col("value").alias("total_s"),
        (F.col("value") * share).alias("parallel_s"),
        (F.col("value") * (1 - share)).alias("overhead_s"),
    )


def max_elapsed(spark, folder):
    return reports.max_elapsed(table(spark, folder, "events"), "user_id", elapsed="value")


def scaling_report(spark, folder):
    report = reports.scaling_report(run_log(spark, folder), times=("total_s", "parallel_s"))
    rounded = [
        F.round(f"{name}_{time}", 6).alias(f"{name}_{time}")
        for name in ("speedup", "efficiency")
        for time in ("total_s", "parallel_s")
    ]
    return report.select("config", "threads", "total_s", "parallel_s", *rounded)


def transpose_timings(spark, folder):
    metrics = ["total_s", "parallel_s", "overhead_s"]
    by_threads = run_log(spark, folder).groupBy("config", "threads").agg(*[F.max(m).alias(m) for m in metrics])
    wide = transpose_table(by_threads, ["config"], "threads", metrics, THREADS)
    return wide.select("config", "metric", *[F.col(str(t)).alias(f"t{t}") for t in THREADS])


def cost_model(spark, folder):
    n = F.col("event_id") + 1000
    runs = table(spark, folder, "events").select(
        "event_id",
        n.alias("n"),
        (F.col("user_id") + 64).alias("d"),
        (F.pmod(F.col("event_id"), F.lit(9)) + 2).alias("k"),
        F.lit(10).alias("n_lambda"),
        F.floor(n / 5).alias("v"),
        F.col("value").alias("parallel_s"),
        (F.col("value") / 8).alias("overhead_s"),
        F.lit(2.0).alias("gamma"),
        (F.pmod(F.col("event_id"), F.lit(8)) + 1).alias("ranks"),
        F.lit(0.25).alias("cluster_overhead_s"),
    )
    model = reports.cost_model(runs)
    return model.select("event_id", F.col("operations").cast("long").alias("operations"), "node_s", F.round("cluster_s", 6).alias("cluster_s"))


def scaling_law(spark, folder):
    runs = table(spark, folder, "events").select(
        F.col("event_type").alias("config"),
        (F.col("event_id") + 500).alias("n"),
        (0.004 * (F.col("event_id") + 500) + F.col("value") + 5).alias("elapsed_s"),
    )
    fit = reports.scaling_law(runs, fixed=5.0)
    columns = ("slope", "intercept", "exponent", "factor")
    return fit.select("config", *[F.round(c, 7).alias(c) for c in columns])


QUERIES = {
    "max_elapsed": max_elapsed,
    "scaling_report": scaling_report,
    "transpose_timings": transpose_timings,
    "cost_model": cost_model,
    "scaling_law": scaling_law,
}

RUNS_SQL = """
runs AS (
  SELECT event_type AS config, CAST(pow(2, event_id % 4) AS INTEGER) AS threads, value AS total_s,
         value * (event_id % 10 / 10.0::DOUBLE) AS parallel_s,
         value * (1 - event_id % 10 / 10.0::DOUBLE) AS overhead_s
  FROM events),
agg AS (SELECT config, threads, max(total_s) AS total_s, max(parallel_s) AS parallel_s,
               max(overhead_s) AS overhead_s FROM runs GROUP BY config, threads)"""

ORACLES = {
    "max_elapsed": "SELECT user_id, max(value) AS elapsed_s FROM events GROUP BY user_id",
    "scaling_report": f"""
        WITH {RUNS_SQL},
        w AS (SELECT *, first_value(total_s) OVER o / total_s AS st, first_value(parallel_s) OVER o / parallel_s AS sp,
                     threads / first_value(threads) OVER o AS ratio
              FROM agg WINDOW o AS (PARTITION BY config ORDER BY threads))
        SELECT config, threads, total_s, parallel_s, round(st, 6) AS speedup_total_s,
               round(sp, 6) AS speedup_parallel_s, round(st / ratio, 6) AS efficiency_total_s,
               round(sp / ratio, 6) AS efficiency_parallel_s
        FROM w""",
    "transpose_timings": f"""
        WITH {RUNS_SQL},
        long AS (SELECT config, threads, 'total_s' AS metric, total_s AS v FROM agg
                 UNION ALL SELECT config, threads, 'parallel_s', parallel_s FROM agg
                 UNION ALL SELECT config, threads, 'overhead_s', overhead_s FROM agg)
        SELECT config, metric, max(v) FILTER (threads = 1) AS t1, max(v) FILTER (threads = 2) AS t2,
               max(v) FILTER (threads = 4) AS t4, max(v) FILTER (threads = 8) AS t8
        FROM long GROUP BY config, metric""",
    "cost_model": """
        WITH r AS (SELECT event_id, event_id + 1000 AS n, user_id + 64 AS d, event_id % 9 + 2 AS k,
                          (event_id + 1000) // 5 AS v, value FROM events)
        SELECT event_id, CAST(2 * 10 * (n * d * d + k * d * (d + n + 2 * v)) AS BIGINT) AS operations,
               value + value / 8 AS node_s,
               round(2.0::DOUBLE * (10.0::DOUBLE / (event_id % 8 + 1)) * (value + value / 8) + 0.25, 6) AS cluster_s
        FROM r""",
    "scaling_law": """
        WITH r AS (SELECT event_type AS config, CAST(event_id + 500 AS DOUBLE) AS n,
                          0.004::DOUBLE * (event_id + 500) + value + 5 AS t FROM events)
        SELECT config, round(regr_slope(t, n), 7) AS slope, round(regr_intercept(t, n), 7) AS intercept,
               round(regr_slope(ln(t - 5), ln(n)), 7) AS exponent,
               round(exp(regr_intercept(ln(t - 5), ln(n))), 7) AS factor
        FROM r GROUP BY config""",
}
