"""A sweep whose outcome goes to a result table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ridgeworks.operators.splits import row_count
from ridgeworks.plans.sweep import ridge_sweep
from ridgeworks.session import stored
from ridgeworks.sources.tables import RESULTS, append_results


def record_sweep(df: DataFrame, path: str, run: str, **options) -> DataFrame:
    """Sweep, and put (n, accuracy, lambda, elapsed_s) of the best lambda into the result table at ``path``.

    The best lambda is observed while the sweep's rows are written, so nothing runs twice; the elapsed time is
    that of the whole sweep. The same ``run`` again replaces its row. Returns the row. Options are those of
    ``ridge_sweep``; without validation rows accuracy and lambda are null.
    """
    spark, began = df.sparkSession, time.monotonic()
    n = row_count(df)
    seen = Observation()
    # on a tie the first lambda of the grid
    rank = F.struct("accuracy", (-F.col("lambda_id")).alias("first"), "lambda")
    best = F.max(F.when(F.col("accuracy").isNotNull(), rank)).alias("best")
    stored(ridge_sweep(df, **options).observe(seen, best), "sweep")
    found = seen.get["best"]
    accuracy, value = (found["accuracy"], found["lambda"]) if found else (None, None)
    row = spark.createDataFrame([(n, accuracy, value, time.monotonic() - began)], RESULTS)
    append_results(row, path, run)
    return row
