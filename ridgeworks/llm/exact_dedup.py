"""Exact deduplication against a persistent index of digests, bucketed and sorted by digest.

All of it is DataFrame operations. Only digests and ids are shuffled, never texts; equal texts are
those with equal SHA-256 of their UTF-8 bytes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.llm.common import LAST_ID, identifier, join_groups, keep_winners, whole, written
from ridgeworks.session import shared_path

BUCKETS = 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text as it is, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """The digests of all texts kept so far: (digest binary, keep_id long, batch string).

    A Parquet table with ``buckets`` buckets by digest, each file sorted by digest. New batches are
    compared with it by a sort-merge anti-join on the bucket columns, so the index itself is not
    shuffled. Give ``path`` to open an index again or to place it; the default is a new folder in
    the shared checkpoint folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        self.table = identifier(f"digest_index_{uuid.uuid4().hex}")
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add (digest, keep_id) rows, one sorted file per bucket."""
        (
            groups.select("digest", "keep_id", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def deduplicate(
    docs: DataFrame,
    index: DigestIndex,
    batch: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Decide which rows of a batch stay, and append the texts that are new to the index.

    Returns (decisions, winners). ``decisions``: one row per row of ``docs`` with doc_id, keep_id (of
    the row that stays), group_size (rows of this batch with that text), kept and digest. ``winners``:
    (digest, doc_id) of the rows that stay. The row with the largest id of a text stays, a null id
    being the smallest; of repeated rows with that id, one stays. A text that earlier batches hold
    keeps nothing of this one: keep_id is then the id in the index. Running a batch again under the
    same name gives the same decisions and appends nothing twice. An empty table gives empty results.
    """
    batch = batch or uuid.uuid4().hex
    digests = written(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_digest(F.col(text)).alias("digest"))
        .groupBy("digest", "doc_id")
        .agg(F.count("*").alias("copies")),
        "digests",
    )
    biggest = F.max(F.coalesce("doc_id", F.lit(-LAST_ID - 1)))
    groups = written(
        digests.groupBy("digest").agg(biggest.alias("own_id"), F.sum("copies").alias("group_size")),
        "digest-groups",
    )
    earlier = index.read().filter(F.col("batch") != batch)
    seen = written(
        groups.join(earlier.select("digest", F.col("keep_id").alias("old_id")), "digest"), "digests-seen"
    )
    new = groups.hint("merge").join(earlier.hint("merge"), "digest", "left_anti")
    real = F.when(F.col("own_id") != -LAST_ID - 1, F.col("own_id"))
    fresh = written(
        new.select("digest", real.alias("keep_id"), "group_size", F.lit(True).alias("fresh")), "digests-new"
    )
    again = index.read().filter(F.col("batch") == batch)
    index.append(fresh.hint("merge").join(again, "digest", "left_anti"), batch)

    old = seen.select("digest", F.col("old_id").alias("keep_id"), "group_size", F.lit(False).alias("fresh"))
    total = digests.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    placed = join_groups(digests, fresh.unionByName(old), "digest", "group_size", total)
    winner = F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    decisions = placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        "digest",
        winner.alias("_winner"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    )
    kept = F.col("_winner") & (F.col("_copy") == 1)
    decisions = decisions.withColumn("kept", kept).drop("_winner", "_copy")
    return decisions, placed.filter(winner).select("digest", "doc_id")


def distinct_rows(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    _, winners = deduplicate(docs, index, doc_id=doc_id, text=text)
    id_key = F.coalesce(F.col("doc_id"), F.lit(-LAST_ID - 1)).alias("id_key")
    rows = docs.select(
        whole(docs).alias("row"),
        text_digest(F.col(text)).alias("digest"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-LAST_ID - 1)).alias("id_key"),
    )
    return keep_winners(rows, winners.select("digest", id_key), ["digest", "id_key"])
