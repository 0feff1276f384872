"""Dense row numbers, seeded permutations and near-equal shards, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeworks.session import stored


def _number_within_buckets(df: DataFrame, bucket: str, order: list[Column], name: str) -> DataFrame:
    """Global 0-based position: rows before the bucket plus the position inside it.

    ``bucket`` has a bounded number of values, so the running total over it is small; the rows
    themselves are only ever sorted bucket by bucket.
    """
    sizes = df.groupBy(bucket).agg(F.count("*").alias("_n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    return (
        df.withColumn("_inside", inside)
        .join(offsets, bucket)
        .withColumn(name, F.col("_before") + F.col("_inside") - 1)
        .drop("_before", "_inside", bucket)
    )


def row_index(df: DataFrame, key: str | list[str], name: str = "row_id") -> DataFrame:
    """Dense 0-based index in the order of any key that can be ordered, or of several.

    Null keys come first; rows of one key go on in the order of the table, so no key needs to be unique. The
    rows are range-partitioned between sampled splitters of key and place in the table, which cut through a
    key that very many rows share; each is sorted in its part and counts on from the rows of the parts before.
    The sorted rows are kept as Parquet in the shared checkpoint folder.
    """
    keys = [key] if isinstance(key, str) else list(key)
    row = F.struct(*[df[f"`{column}`"] for column in df.columns]).alias("row")
    order = [F.col(f"row.`{column}`") for column in keys] + [F.col("place")]
    ranged = df.select(row, F.monotonically_increasing_id().alias("place")).repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).select("row", F.monotonically_increasing_id().alias("at"))
    placed = stored(placed.withColumn("part", F.shiftright("at", 33)), "row-index")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = stored(sizes.select("part", shift.alias("shift")), "row-index-parts")
    numbered = placed.join(shifts, "part")
    return numbered.select("row.*", (F.col("at") + F.col("shift")).alias(name))


def shuffle_key(key: Column, seed: int) -> Column:
    """The value a seeded shuffle sorts by: md5 of "seed:key"."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def seeded_order(df: DataFrame, key: str, seed: int = 0, name: str = "position") -> DataFrame:
    """Reproducible random permutation: ``name`` is the row's place in it, 0-based and dense.

    The first four hash digits split the rows into at most 65 536 even buckets.
    """
    hashed = df.withColumn("_hash", shuffle_key(F.col(key), seed))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, 4))
    order = [F.col("_hash"), F.col(key)]
    return _number_within_buckets(hashed, "_bucket", order, name).drop("_hash")


def shard_of(row_id: Column, n: int, shards: int) -> Column:
    """Shard of a dense row number when n rows are cut into contiguous near-equal shards.

    The first n mod p shards hold one row more than the rest.
    """
    small, extra = divmod(n, shards)
    head = extra * (small + 1)
    late = extra + whole_part(row_id - head, max(small, 1))
    return F.when(row_id < head, whole_part(row_id, small + 1)).otherwise(late).cast("int")


def whole_part(value: Column, divisor: int) -> Column:
    """Integer division, exact for any long."""
    return F.call_function("div", value, F.lit(divisor).cast("long"))


def shard_bounds(n: int, shards: int) -> list[tuple[int, int]]:
    """[start, end) of every shard, on the driver."""
    small, extra = divmod(n, shards)
    starts = [i * small + min(i, extra) for i in range(shards + 1)]
    return list(zip(starts[:-1], starts[1:], strict=True))
