import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeworks.operators import splits
from ridgeworks.operators.indexing import row_index, seeded_order, shard_bounds, shard_of


@pytest.mark.parametrize("n, p", [(10, 3), (11, 4), (3, 5), (100, 1), (7, 7), (1000, 13)])
def test_shards_are_near_equal(spark, n, p):
    rows = spark.range(n).select("id", shard_of(F.col("id"), n, p).alias("s")).orderBy("id").collect()
    parts = np.array_split(np.arange(n), p)
    assert [r["s"] for r in rows] == [s for s, part in enumerate(parts) for _ in part]
    assert shard_bounds(n, p) == [
        (sum(map(len, parts[:s])), sum(map(len, parts[: s + 1]))) for s in range(p)
    ]


@pytest.mark.parametrize("n", [1, 2, 5, 100, 9000])
@pytest.mark.parametrize("drop_last", [False, True])
def test_hash_split_is_exact(spark, n, drop_last):
    rows = spark.range(n).withColumnRenamed("id", "row_id")
    split = splits.hash_split(rows, seed=3, drop_last=drop_last)
    order = sorted(range(n), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    cut = int(0.8 * n)
    end = n - 1 if drop_last else n
    found = [
        sorted(r["row_id"] for r in rows.where(part).collect())
        for part in (split.train, split.validation, split.rest)
    ]
    assert found == [sorted(order[:cut]), sorted(order[cut:end]), sorted(order[max(cut, end):])]


@pytest.mark.parametrize("n", [1, 2, 5, 6, 103])
@pytest.mark.parametrize("drop_last", [False, True])
def test_positional_split(spark, n, drop_last):
    rows = spark.range(n).withColumnRenamed("id", "row_id")
    split = splits.positional_split(rows, drop_last=drop_last)
    found = [[r["row_id"] for r in rows.where(p).orderBy("row_id").collect()] for p in (split.train, split.validation)]
    every = list(range(n))
    cut = int(0.8 * n)
    assert found == [every[:cut], every[cut:-1] if drop_last else every[cut:]]


def test_row_index_of_clustered_keys(spark):
    keys = [5] + [10**6 + i for i in range(500)] + [10**12 + 7 * i for i in range(300)] + [-3]
    rows = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    found = {r["key"]: r["row_id"] for r in row_index(rows, "key").collect()}
    assert found == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("keys", ["k", ["k", "n"]])
def test_row_index_of_repeated_and_null_keys(spark, keys):
    """A third of all rows share a key, another third has none; ties keep the order of the table."""
    rng = np.random.default_rng(3)
    words = ["same", None, *(f"w{i}" for i in range(40))]
    data = [(words[j % 3] if j % 3 < 2 else words[int(rng.integers(2, 42))], int(rng.integers(5)), j) for j in range(2000)]
    df = spark.createDataFrame(data, "k string, n long, row long").coalesce(3).withColumn("place", F.lit(1))
    found = sorted(row_index(df, keys).collect(), key=lambda r: r["row_id"])
    assert [r["row_id"] for r in found] == list(range(2000))
    own = (lambda r: (r["k"] is not None, r["k"] or "", r["n"])) if isinstance(keys, list) else (lambda r: (r["k"] is not None, r["k"] or ""))
    assert [r["row"] for r in found] == [r["row"] for r in sorted(sorted(found, key=lambda r: r["row"]), key=own)]


def test_row_index_keeps_parts_even(spark):
    """The splitters cut through a key that nearly all rows share."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 50 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        found = row_index(df, "k").withColumn("part", F.floor(F.col("row_id") / 1000))
        assert found.agg(F.count_distinct("row_id")).first()[0] == 4000
        order = [F.col("k"), F.monotonically_increasing_id()]
        parts = df.repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in parts) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_row_index_of_no_rows(spark):
    assert row_index(spark.createDataFrame([], "k string, row_id string"), "k", "i").count() == 0


def test_seeded_order_is_a_permutation(spark):
    rows = spark.range(700).repartition(3)
    found = [r["position"] for r in seeded_order(rows, "id", 1).orderBy("id").collect()]
    assert sorted(found) == list(range(700)) and found != list(range(700))
    again = [r["position"] for r in seeded_order(rows.repartition(7), "id", 1).orderBy("id").collect()]
    assert found == again
    assert found != [r["position"] for r in seeded_order(rows, "id", 2).orderBy("id").collect()]


def test_semi_and_anti_joins_with_repeated_index_keys(spark):
    rows = spark.range(10).withColumnRenamed("id", "row_id")
    index = spark.createDataFrame([(1,), (1,), (4,), (99,)], "row_id long")
    assert sorted(r[0] for r in splits.rows_in(rows, index).collect()) == [1, 4]
    assert splits.rows_not_in(rows, index).count() == 8


@pytest.mark.parametrize("kind", ["long", "int", "string"])
@pytest.mark.parametrize("budget", [splits.BITMAP_BUDGET, 0])
def test_sets_of_any_keys(spark, kind, budget):
    numbers = [-40000, -32768, -32767, -1, 0, 1, 7, 8, 9, 32767, 32768, 32769, 65536, 10**9, None]
    if kind == "long":
        numbers += [2**63 - 1, -(2**63) + 1, 2**40]
    chosen = [x for i, x in enumerate(numbers) if i % 2 == 0]

    def frame(values, more):
        rows = spark.createDataFrame([(x, 1) for x in values], "k long, _bits int")
        return rows.select(F.col("k").cast(kind).alias("k"), F.col("_bits").alias(more))

    df, index = frame(numbers * 2, "v"), frame(chosen * 3, "w")
    inside = sorted(str(x) for x in chosen * 2 if x is not None)
    found = splits.rows_in(df, index, "k", budget), splits.rows_not_in(df, index, "k", budget)
    assert [x.columns for x in found] == [["k", "v"]] * 2
    assert sorted(str(r["k"]) for r in found[0].collect()) == inside
    outside = [x for x in numbers if x not in chosen or x is None] * 2
    assert sorted(str(r["k"]) for r in found[1].collect()) == sorted(map(str, outside))


def test_a_set_of_row_numbers_moves_no_row(spark):
    df = spark.range(300_000).withColumnRenamed("id", "row_id").withColumn("v", F.col("row_id") * 2)
    index = df.where("row_id % 3 = 0").select("row_id")
    for found, n in ((splits.rows_in(df, index), 100_000), (splits.rows_not_in(df, index), 200_000)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert found.count() == n


def test_split_predicates_reach_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    split = splits.positional_split(events, "event_id")
    plan = events.where(split.validation).select("value")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id,800)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
