"""Train / validation splits as row predicates that reach the scan."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ridgeworks.operators.indexing import shuffle_key
from ridgeworks.session import stored

# fixed value: default share of training rows
TRAIN_SHARE = 0.8
# bytes of one bitmap, and of all that are broadcast: two thousand million row numbers in a row
BITMAP_BYTES = 4096
BITMAP_BUDGET = 256 * 1024 * 1024


def row_count(df: DataFrame) -> int:
    """Number of rows; on Parquet this reads file footers only."""
    return df.agg(F.count("*")).first()[0]


def dense_row_count(df: DataFrame, row_id: str) -> int:
    """Number of rows whose numbers must run from 0 to one less; on Parquet this reads footers only.

    Splits by position place rows by number, so a gap would lose rows without a sign: it is an error.
    """
    row = F.col(row_id)
    n, low, high = df.agg(F.count("*"), F.min(row), F.max(row)).first()
    if n and (low, high) != (0, n - 1):
        raise ValueError(
            f"{row_id} runs from {low} to {high} over {n} rows; number them from 0 without gaps (row_index)"
        )
    return n


def first_rows(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    """The first n rows by dense row number."""
    return df.where(F.col(row_id) < n)


@dataclass(frozen=True)
class Split:
    """Three disjoint row predicates; ``rest`` holds the row a split leaves out, if any."""

    train: Column
    validation: Column
    rest: Column
    n: int


def positional_split(
    df: DataFrame,
    row_id: str = "row_id",
    train_frac: float = TRAIN_SHARE,
    drop_last: bool = False,
    n: int | None = None,
) -> Split:
    """Train on the first ``int(train_frac * n)`` rows, validate on the others.

    ``drop_last`` leaves the very last row out of the validation set. Row numbers must be dense.
    """
    n = dense_row_count(df, row_id) if n is None else n
    cut, end = int(train_frac * n), n - int(drop_last)
    row = F.col(row_id)
    return Split(row < cut, (row >= cut) & (row < end), row >= max(cut, end), n)


def hash_split(
    df: DataFrame,
    row_id: str = "row_id",
    train_frac: float = TRAIN_SHARE,
    drop_last: bool = False,
    seed: int = 0,
) -> Split:
    """Random split with exactly ``int(train_frac * n)`` training rows, reproducible by seed.

    The rows with the smallest hashes train. Only the border value of the hash is looked up, so
    each row is then placed by a comparison: nothing is sorted, joined or shuffled.
    """
    n = row_count(df)
    cut = int(train_frac * n)
    hashes = df.select(shuffle_key(F.col(row_id), seed).alias("_hash"))
    value = shuffle_key(F.col(row_id), seed)
    train = value <= _kth_smallest(hashes, cut, n) if cut else F.lit(False)
    if drop_last and cut < n:
        last = value == hashes.agg(F.max("_hash")).first()[0]
    else:
        last = F.lit(False)
    return Split(train, ~train & ~last, ~train & last, n)


def _kth_smallest(hashes: DataFrame, k: int, n: int, exact_below: int = 4096) -> str:
    """k-th smallest (1-based) of n hex hashes, by counting prefixes up to four digits at a time."""
    prefix, inside = "", n
    while inside > exact_below and len(prefix) < 32:
        digits = len(prefix) + min(4, math.ceil(math.log(inside / exact_below, 16)) + 1)
        near = hashes.where(F.col("_hash").startswith(prefix)) if prefix else hashes
        counts = (
            near.groupBy(F.substring("_hash", 1, digits).alias("_prefix"))
            .agg(F.count("*").alias("_n"))
            .orderBy("_prefix")
            .collect()  # at most 65 536 rows
        )
        for row in counts:
            if k <= row["_n"]:
                break
            k -= row["_n"]
        prefix, inside = row["_prefix"], row["_n"]
    if len(prefix) == 32:
        return prefix
    near = hashes.where(F.col("_hash").startswith(prefix)) if prefix else hashes
    return near.orderBy("_hash").collect()[k - 1][0]


def split_rows(df: DataFrame, split: Split) -> tuple[DataFrame, DataFrame]:
    """(train, validation)."""
    return df.where(split.train), df.where(split.validation)


def key_bitmaps(index: DataFrame, key: str) -> DataFrame:
    """The integers of ``key`` as bitmaps of 32 768 neighbours: (_bucket, _bits); repeated ones cost nothing."""
    value = F.col(key).cast("long")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits")
    return index.where(value.isNotNull()).groupBy(F.bitmap_bucket_number(value).alias("_bucket")).agg(bits)


def _bit(bits: Column, key: Column) -> Column:
    """Whether the bit of an integer is set in the bitmap of its bucket."""
    place = F.bitmap_bit_position(key)
    byte = F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("getbit", value, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def _by_set(df: DataFrame, index: DataFrame, key: str, kind: str, budget: int) -> DataFrame:
    """Semi or anti join with a set of keys.

    Integer keys become bitmaps first. Within ``budget`` bytes of them, counted, they are broadcast and the
    rows of ``df`` stay where they are; a larger or a sparse set is joined by key, each of them once.
    """
    if isinstance(df.schema[key].dataType, IntegralType) and isinstance(index.schema[key].dataType, IntegralType):
        bitmaps = stored(key_bitmaps(index, key), "index-bitmaps")
        if bitmaps.count() * BITMAP_BYTES <= budget:
            value = df[f"`{key}`"].cast("long")
            met = df.withColumn("_bucket", F.bitmap_bucket_number(value)).join(F.broadcast(bitmaps), "_bucket", "left")
            found = F.coalesce(_bit(F.col("_bits"), value), F.lit(False))
            return met.where(found if kind == "left_semi" else ~found).select(*[f"`{x}`" for x in df.columns])
    return df.join(index.select(key).distinct(), key, kind)


def rows_in(df: DataFrame, index: DataFrame, key: str = "row_id", budget: int = BITMAP_BUDGET) -> DataFrame:
    """Rows whose key is in the index set; a null key is in none."""
    return _by_set(df, index, key, "left_semi", budget)


def rows_not_in(df: DataFrame, index: DataFrame, key: str = "row_id", budget: int = BITMAP_BUDGET) -> DataFrame:
    """Rows whose key is not in the index set, null keys among them."""
    return _by_set(df, index, key, "left_anti", budget)


def align(features: DataFrame, labels: DataFrame, key: str = "row_id") -> DataFrame:
    """Put each label beside its feature vector by key."""
    return features.join(labels, key)
