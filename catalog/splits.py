"""Subsets, splits, indexes, shards and joins by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import table
from ridgeworks.operators import splits
from ridgeworks.operators.indexing import row_index, seeded_order, shard_of

SEED = 7
SHARDS = 7


def first_n_rows(spark, folder):
    rows = splits.first_rows(table(spark, folder, "events"), 1000, "event_id")
    return rows.select("event_id", "user_id", "event_type", "value")


def split_train(spark, folder):
    events = table(spark, folder, "events")
    train, _ = splits.split_rows(events, splits.positional_split(events, "event_id"))
    return train.select("event_id", "value")


def split_validation(spark, folder):
    events = table(spark, folder, "events")
    split = splits.positional_split(events, "event_id", drop_last=True)
    return events.where(split.validation).select("event_id", "value")


def split_hash(spark, folder):
    events = table(spark, folder, "events")
    split = splits.hash_split(events, "event_id", seed=SEED, drop_last=True)
    part = F.when(split.train, "train").when(split.validation, "validation").otherwise("rest")
    return events.select("event_id", part.alias("part"))


def row_numbers(spark, folder):
    return row_index(table(spark, folder, "labels"), "doc_id").select("doc_id", "row_id")


def row_numbers_text(spark, folder):
    """Customers numbered by market segment, which very many share; null in place of one of them."""
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    rows = table(spark, folder, "customer").select(segment.alias("segment"), "c_custkey")
    numbers = row_index(rows, "segment").groupBy("segment")
    return numbers.agg(F.min("row_id").alias("low"), F.max("row_id").alias("high"), F.count_distinct("row_id").alias("rows"))


def seeded(spark, folder):
    return seeded_order(table(spark, folder, "events"), "event_id", SEED).select("event_id", "position")


def shard_rows(spark, folder):
    events = table(spark, folder, "events")
    n = splits.row_count(events)
    return events.select("event_id", shard_of(F.col("event_id"), n, SHARDS).alias("shard"))


def align_labels(spark, folder):
    rows = splits.align(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")
    return rows.select("doc_id", "n_chars", "quality", "toxic")


def semi_split(spark, folder):
    documents = table(spark, folder, "documents")
    return splits.rows_in(documents, table(spark, folder, "labels"), "doc_id").select("doc_id", "lang")


def anti_split(spark, folder):
    documents = table(spark, folder, "documents")
    return splits.rows_not_in(documents, table(spark, folder, "labels"), "doc_id").select("doc_id", "lang")


def semi_split_keys(spark, folder):
    """Lines of the orders placed in one year: a large set of keys that repeat on the other side."""
    orders = table(spark, folder, "orders").where(F.year("o_orderdate") == 1995)
    index = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, folder, "lineitem")
    return splits.rows_in(lines, index, "l_orderkey").select("l_orderkey", "l_linenumber")


QUERIES = {
    "first_n_rows": first_n_rows,
    "split_train": split_train,
    "split_validation": split_validation,
    "split_hash": split_hash,
    "row_index": row_numbers,
    "row_index_text": row_numbers_text,
    "seeded_order": seeded,
    "shard_rows": shard_rows,
    "align_labels": align_labels,
    "semi_split": semi_split,
    "anti_split": anti_split,
    "semi_split_keys": semi_split_keys,
}

ORACLES = {
    "first_n_rows": "SELECT event_id, user_id, event_type, value FROM events WHERE event_id < 1000",
    "split_train": """
        SELECT event_id, value FROM events WHERE event_id < (SELECT 4 * count(*) // 5 FROM events)""",
    "split_validation": """
        SELECT event_id, value FROM events
        WHERE event_id >= (SELECT 4 * count(*) // 5 FROM events)
          AND event_id < (SELECT count(*) - 1 FROM events)""",
    "split_hash": f"""
        WITH r AS (SELECT event_id, row_number() OVER (ORDER BY md5('{SEED}:' || event_id)) AS place,
                          count(*) OVER () AS n FROM events)
        SELECT event_id, CASE WHEN place <= 4 * n // 5 THEN 'train' WHEN place < n THEN 'validation'
                              ELSE 'rest' END AS part
        FROM r""",
    "row_index": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM labels",
    "row_index_text": """
        WITH r AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment,
                          row_number() OVER (ORDER BY nullif(c_mktsegment, 'BUILDING') NULLS FIRST) - 1 AS row_id
                   FROM customer)
        SELECT segment, min(row_id) AS low, max(row_id) AS high, count(*) AS rows FROM r GROUP BY segment""",
    "seeded_order": f"""
        SELECT event_id, row_number() OVER (ORDER BY md5('{SEED}:' || event_id)) - 1 AS position FROM events""",
    "shard_rows": f"""
        SELECT event_id, CAST(ntile({SHARDS}) OVER (ORDER BY event_id) - 1 AS INTEGER) AS shard FROM events""",
    "align_labels": """
        SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)""",
    "semi_split": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "anti_split": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "semi_split_keys": """
        SELECT l_orderkey, l_linenumber FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1995)""",
}
