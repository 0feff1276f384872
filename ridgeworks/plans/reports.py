"""Scaling reports over a log of timed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_elapsed(runs: DataFrame, *keys: str, elapsed: str = "elapsed_s") -> DataFrame:
    """A run takes as long as its slowest worker."""
    return runs.groupBy(*keys).agg(F.max(elapsed).alias("elapsed_s"))


def scaling_report(
    runs: DataFrame, config: str = "config", threads: str = "threads", times: tuple[str, ...] = ("elapsed_s",)
) -> DataFrame:
    """Speedup and efficiency of every thread count against the smallest one of its configuration.

    The log may hold many runs per (config, threads); the slowest counts. The aggregates are
    small and joined back by configuration, so a configuration with most of the runs is no hot spot.
    """
    by_threads = runs.groupBy(config, threads).agg(*[F.max(t).alias(t) for t in times])
    base = by_threads.groupBy(config).agg(
        F.min(threads).alias("_base"), *[F.min_by(t, threads).alias(f"_{t}") for t in times]
    )
    report = by_threads.join(base, config)
    for t in times:
        suffix = "" if len(times) == 1 else f"_{t}"
        speedup = F.try_divide(F.col(f"_{t}"), F.col(t))
        report = report.withColumn(f"speedup{suffix}", speedup)
        ratio = F.col(threads) / F.col("_base")
        report = report.withColumn(f"efficiency{suffix}", speedup / ratio)
    return report.drop("_base", *[f"_{t}" for t in times])


def operations(n: Column, d: Column, k: Column, n_lambda: Column, v: Column) -> Column:
    """Parallel operations of a sweep: 2 n_lambda (n d^2 + k d (d + n + 2 v))."""
    return 2 * n_lambda * (n * d * d + k * d * (d + n + 2 * v))


def cluster_seconds(gamma: Column, n_lambda: Column, ranks: Column, node_s: Column, overhead_s: Column) -> Column:
    """Time of a sweep over ranks: gamma (n_lambda / ranks) node_s + overhead_s."""
    return gamma * (n_lambda / ranks) * node_s + overhead_s


def cost_model(runs: DataFrame) -> DataFrame:
    """Add operation count (a whole number of up to 38 digits) and node time to runs (n, d, k, n_lambda,
    v, parallel_s, overhead_s).

    Runs that also have gamma, ranks and cluster_overhead_s get the time of the whole cluster.
    """
    sizes = [F.col(c).cast("decimal(38,0)") for c in ("n", "d", "k", "n_lambda", "v")]
    timed = runs.withColumn("operations", operations(*sizes))
    timed = timed.withColumn("node_s", F.col("parallel_s") + F.col("overhead_s"))
    if not {"gamma", "ranks", "cluster_overhead_s"} <= set(runs.columns):
        return timed
    parts = [F.col(c) for c in ("gamma", "n_lambda", "ranks", "node_s", "cluster_overhead_s")]
    return timed.withColumn("cluster_s", cluster_seconds(*parts))


def scaling_law(runs: DataFrame, config: str = "config", n: str = "n", elapsed: str = "elapsed_s", fixed: float = 0.0):
    """Fit elapsed = slope * n + intercept, and elapsed - fixed = factor * n ^ exponent, per config.

    The power law is fitted on logarithms, over runs longer than the fixed part.
    """
    moving = F.col(elapsed) - F.lit(fixed)
    usable = (moving > 0) & (F.col(n) > 0)
    rows = runs.select(
        config,
        F.col(n).cast("double").alias("_n"),
        F.col(elapsed).alias("_t"),
        F.when(usable, F.ln(n)).alias("_ln_n"),
        F.when(usable, F.ln(F.when(usable, moving))).alias("_ln_t"),
    )
    return rows.groupBy(config).agg(
        F.regr_slope("_t", "_n").alias("slope"),
        F.regr_intercept("_t", "_n").alias("intercept"),
        F.regr_slope("_ln_t", "_ln_n").alias("exponent"),
        F.exp(F.regr_intercept("_ln_t", "_ln_n")).alias("factor"),
    )
