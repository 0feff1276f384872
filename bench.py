"""Time the headline queries; prints one JSON line.

``queries`` are seconds on the tables of BENCH_SF_DIR, best of two runs after a warm-up.
``sizes`` repeats the sweep on the first rows of images derived from the embeddings, with the row
counts and vector lengths of the published timings, and sets our seconds beside the published ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalog import QUERIES  # noqa: E402
from ridgeworks.operators.splits import first_rows  # noqa: E402
from ridgeworks.plans.sweep import ridge_sweep, ridge_sweep_sharded  # noqa: E402
from ridgeworks.session import build_session  # noqa: E402

HEADLINE = [
    "ridge_sweep",
    "ridge_sweep_images",
    "ridge_sweep_sharded",
    "ridge_sweep_n",
    "ridge_sweep_orders",
    "size_sweep",
    "ridge_weights_2f",
    "score_class_sums",
    "gram_matrix",
    "mean_image",
    "xty",
    "matmul_blocks",
    "center_features",
    "binarize",
    "split_hash",
    "seeded_order",
    "scores_by_class",
    "scaling_report",
    "scaling_law",
    "clean_hourly",
]

# published seconds: (rows, image height, image width, shards or None) -> whole run
PUBLISHED = {
    "784_pixels_500_rows": ((500, 28, 28, None), 7.015),
    "784_pixels_2000_rows": ((2000, 28, 28, None), 13.056),
    "784_pixels_8000_rows": ((8000, 28, 28, None), 37.081),
    "784_pixels_16000_rows": ((16000, 28, 28, None), 69.404),
    "784_pixels_32000_rows": ((32000, 28, 28, None), 133.945),
    "784_pixels_40000_rows_8_threads": ((40000, 28, 28, None), 35.577),
    "784_pixels_16000_rows_8_shards": ((16000, 28, 28, 8), None),
    "2400_pixels_16000_rows": ((16000, 40, 60, None), 470.0),
}
LARGEST = {(28, 28): 40000, (40, 60): 16000}


def images(spark: SparkSession, folder: str, rows: int, height: int, width: int) -> DataFrame:
    """Row r is an outer product of embedding r mod n, turned by r div n places."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    n = vectors.count()
    copy = F.explode(F.sequence(F.lit(0), F.lit((rows - 1) // n)))
    turned = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"), copy.alias("c"))
    turned = turned.select(
        (F.col("c") * n + F.col("vec_id")).alias("row_id"),
        "label",
        F.concat(F.slice("e", F.col("c") + 1, 64), F.slice("e", F.lit(1), F.col("c"))).alias("e"),
    ).where(F.col("row_id") < rows)
    across = F.slice("e", 1, width)
    pixels = F.transform(F.slice("e", 1, height), lambda a: F.transform(across, lambda b: a * b))
    return turned.repartition(spark.sparkContext.defaultParallelism).select(
        "row_id", "label", F.flatten(pixels).alias("features")
    )


def sweep(table: DataFrame, shards: int | None) -> DataFrame:
    return ridge_sweep(table) if shards is None else ridge_sweep_sharded(table, shards)


def seconds(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="bench", master=f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(query) -> float:
        return seconds(lambda: query(spark, folder).write.format("noop").mode("overwrite").save())

    run(QUERIES["ridge_sweep"])
    queries = {name: round(min(run(QUERIES[name]) for _ in range(2)), 3) for name in HEADLINE}

    sizes = {}
    scratch = tempfile.mkdtemp(prefix="run-")
    for (height, width), most in LARGEST.items():
        images(spark, folder, most, height, width).write.parquet(f"{scratch}/{height}x{width}")
    for name, ((rows, height, width, shards), published) in PUBLISHED.items():
        table = first_rows(spark.read.parquet(f"{scratch}/{height}x{width}"), rows)
        best = min(seconds(lambda: sweep(table, shards).collect()) for _ in range(2))
        sizes[name] = {"sec": round(best, 3), "published_sec": published}

    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sizes": sizes,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
