"""Inputs shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.functions.vectors import log_spaced, quantise
from ridgeworks.plans.sweep import Columns

VECTORS = Columns("vec_id", "label", "embedding")
LAMBDAS = log_spaced()
LAMBDA_VALUES = ", ".join(f"({i}, CAST({v!r} AS DOUBLE))" for i, v in enumerate(LAMBDAS))

# embeddings as whole numbers, one row per element: sums are exact in both engines
WHOLE_SQL = """
x AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos,
         CAST(floor(CAST(unnest(embedding) AS DOUBLE) * 65536) AS BIGINT) AS q
  FROM embeddings
)"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, label, embedding); vec_id runs from 0 without gaps."""
    return table(spark, folder, "embeddings")


def whole_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors(spark, folder).withColumn("embedding", quantise(F.col("embedding")))
