"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform. A table puts a unit
vector into the bucket of the signed axis nearest to its rotation; a query looks into the buckets of its
``probes`` nearest signed axes in every table. All rows of those buckets are ranked by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeworks.llm.common import written

TABLES = 12
PROBES = 8
NEAREST = 10
SEED = 11
# rows, and queries, that meet in one group at most (about: they are dealt by hash)
ROWS = 8192
QUERIES = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows of ``x``, scaled to keep lengths; width a power of 2."""
    n = x.shape[1]
    step = 1
    while step < n:
        x = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotations(vectors: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The pseudo-rotation of one table, of vectors padded with zeros to a power of 2."""
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), width))
    x[:, : vectors.shape[1]] = vectors
    random = np.random.default_rng([seed, table, width])
    for _ in range(3):
        x = hadamard(x * random.choice([-1.0, 1.0], width))
    return x


def axes(vectors: np.ndarray, table: int, probes: int, seed: int = SEED) -> np.ndarray:
    """The nearest signed axes, nearest first; axis i is bucket i, its opposite bucket width + i."""
    turned = rotations(vectors, table, seed)
    both = np.concatenate([turned, -turned], axis=1)
    probes = min(probes, both.shape[1])
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not all zero, no null or non-finite component."""
    limit = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _hashed(vectors: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """(place, bucket, id, vector): one row per vector, table and probe; bucket holds width and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == width))
                x = _matrix(rows.column(1))
                x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                for table in range(tables):
                    found = axes(x, table, probes, seed)
                    for probe in range(found.shape[1]):
                        key = (np.int64(width) * 1024 + table) * (1 << 20) + found[:, probe]
                        yield pa.RecordBatch.from_arrays([pa.array(key), *rows.columns], ["bucket", "id", "vector"])

    return vectors.mapInArrow(run, "bucket long, id long, vector array<double>")


def _best(squared: np.ndarray, nearest: int, slack: float) -> np.ndarray:
    """Places of the nearest, with all that ``slack`` cannot tell from the last of them."""
    if len(squared) <= nearest:
        return np.arange(len(squared))
    return np.flatnonzero(squared <= np.partition(squared, nearest - 1)[nearest - 1] + slack)


def search(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` rows found for each query, by Euclidean distance.

    Queries are the rows that ``is_query`` holds for; candidates are all rows of the same width but the
    query's own id. The distance is that of the original vectors in double precision; ties go to the
    smaller id; repeated rows of one id count once. Null, zero and non-finite vectors, and rows with a null
    id, take no part. A query with no candidate has no rows, an empty table gives an empty result.

    Rows and queries meet bucket by bucket (``_meet``). Queries that find fewer rows than there are to find,
    for the table is small or their buckets are, meet all rows: every bucket of one table.
    """
    held = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        is_query.alias("asked"),
    )
    held = held.groupBy("id", "vector").agg(F.bool_or("asked").alias("asked"))
    held = written(held.select("id", "vector", "asked", F.size("vector").cast("long").alias("width")), "ann-vectors")
    rows = written(_hashed(held.select("id", "vector"), tables, 1, seed), "ann-rows")
    asked = held.filter("asked").select("id", "vector")
    found = written(_meet(rows, _hashed(asked, tables, probes, seed), nearest, seed), "ann-found")
    # how many ids a query should find, and how many it did
    ids = held.groupBy("width").agg(F.countDistinct("id").alias("ids"))
    wanted = held.filter("asked").select("id", "width").distinct().join(F.broadcast(ids), "width")
    wanted = wanted.select("id", "width", F.least(F.lit(nearest), F.col("ids") - 1).alias("wanted"))
    counts = found.groupBy(F.col("query_id").alias("id"), "width").agg(F.countDistinct("vec_id").alias("held"))
    short = wanted.join(counts, ["id", "width"], "left").filter(F.coalesce("held", F.lit(0)) < F.col("wanted"))
    short = written(short.select("id", "width"), "ann-short")
    if not short.isEmpty():
        again = held.filter("asked").join(short, ["id", "width"], "left_semi").select("id", "vector")
        every = _hashed(again, 1, 1 << 20, seed)
        one_table = rows.filter(_table(F.col("bucket")) == 0)
        found = found.unionByName(_meet(one_table, every, nearest, seed))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _table(bucket: Column) -> Column:
    return F.pmod(F.shiftright(bucket, 20), F.lit(1024))


def _meet(rows: DataFrame, asked: DataFrame, nearest: int, seed: int) -> DataFrame:
    """(query_id, width, vec_id, score): the ``nearest`` ids of every block that a query meets.

    ``rows`` and ``asked`` are (bucket, id, vector). A bucket with many rows, or queries, is dealt by hash
    over blocks of about ROWS and QUERIES, so a bucket with a third of all rows is many groups, and so is an
    id with many vectors; the number of buckets is tables x 2 x width whatever the data, and so is the
    broadcast table of their sizes. Each group ranks its own candidates and returns ``nearest`` ids per
    query; pairs are never rows.
    """
    asked = written(asked, "ann-queries")
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / ROWS).alias("row_blocks"))
    counts = asked.groupBy("bucket").agg(F.ceil(F.count("*") / QUERIES).alias("query_blocks"))
    cells = written(sizes.join(counts, "bucket"), "ann-cells")
    few = F.broadcast(cells)
    salt = F.xxhash64("id", "vector", F.lit(seed))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    row_side = rows.join(few, "bucket").select(
        "bucket", F.pmod(salt, "row_blocks").alias("row_block"), every("query_blocks").alias("query_block"), "id", "vector"
    )
    query_side = asked.join(few, "bucket").select(
        "bucket", every("row_blocks").alias("row_block"), F.pmod(salt, "query_blocks").alias("query_block"), "id", "vector"
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "width": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        empty = {name: pa.array([], kind) for name, kind in names.items()}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        ids, x = left.column("id").to_numpy(), _matrix(left.column("vector").combine_chunks())
        who, q = right.column("id").to_numpy(), _matrix(right.column("vector").combine_chunks())
        squares = (x * x).sum(axis=1)
        out: list[list[np.ndarray]] = [[], [], [], []]
        distinct = np.unique(ids)
        for first in range(0, len(q), 256):
            part = q[first : first + 256]
            close = squares[None, :] - 2 * (part @ x.T) + (part * part).sum(axis=1)[:, None]
            for i, own in enumerate(who[first : first + 256].tolist()):
                others = np.flatnonzero(ids != own)
                # more than asked for, then exact: the product loses digits of small distances
                slack = 1e-12 * (float(squares.max()) + float(part[i] @ part[i]))
                wanted = min(nearest, len(distinct) - int(own in distinct))
                reach = 2 * nearest
                near = others[_best(close[i][others], reach, slack)]
                while len(np.unique(ids[near])) < wanted:  # ids with several vectors
                    reach *= 4
                    near = others[_best(close[i][others], reach, slack)]
                exact = np.sqrt(((x[near] - part[i]) ** 2).sum(axis=1))
                order = np.lexsort((ids[near], exact))
                _, once = np.unique(ids[near][order], return_index=True)
                order = order[np.sort(once)][:nearest]
                out[0].append(np.full(len(order), own))
                out[1].append(np.full(len(order), x.shape[1]))
                out[2].append(ids[near][order])
                out[3].append(exact[order])
        return pa.table({name: np.concatenate(parts) for name, parts in zip(names, out, strict=True)})

    keys = ["bucket", "row_block", "query_block"]
    found = row_side.groupBy(*keys).cogroup(query_side.groupBy(*keys))
    return found.applyInArrow(rank, "query_id long, width long, vec_id long, score double")
