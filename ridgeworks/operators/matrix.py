"""Matrix product and reshaping on coordinate tables (i, j, v)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import to_matrix
from ridgeworks.operators.indexing import whole_part
from ridgeworks.session import stored

TILE = "bi int, bj int, h int, w int, tile binary"
TILE_SCHEMA = pa.schema(
    [("bi", pa.int32()), ("bj", pa.int32()), ("h", pa.int32()), ("w", pa.int32()), ("tile", pa.binary())]
)
# bytes of product tiles one task may hold before it ships them
TASK_BUDGET = 256 * 1024 * 1024
# a group of a tiled product holds so many rows and columns of tiles, by so many inner blocks
GRID, SLAB = 8, 16
# cells of one inner index and side that meet in one task
HEAVY = 4096


def cells(df: DataFrame, row: str, features: str) -> DataFrame:
    """A table of row vectors as cells (i, j, v)."""
    return df.select(F.col(row).cast("long").alias("i"), F.posexplode(features).alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v")
    )


def transpose(matrix: DataFrame) -> DataFrame:
    return matrix.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def shape_of(matrix: DataFrame) -> tuple[int, int]:
    top = matrix.agg(F.max("i"), F.max("j")).first()
    return (0, 0) if top[0] is None else (top[0] + 1, top[1] + 1)


def tiles(matrix: DataFrame, shape: tuple[int, int], size: int) -> DataFrame:
    """Dense size x size tiles; at most size^2 cells meet in one group."""
    rows, columns = shape

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bi, bj = key[0].as_py(), key[1].as_py()
        h, w = min(size, rows - bi * size), min(size, columns - bj * size)
        tile = np.zeros((h, w))
        for batch in batches:
            i = batch.column("i").to_numpy() - bi * size
            j = batch.column("j").to_numpy() - bj * size
            np.add.at(tile, (i, j), batch.column("v").to_numpy())
        yield _tile_batch([(bi, bj, tile)])

    block = [whole_part(F.col(c), size).cast("int").alias(b) for c, b in (("i", "bi"), ("j", "bj"))]
    return matrix.select("*", *block).groupBy("bi", "bj").applyInArrow(pack, TILE)


def row_tiles(df: DataFrame, row: str, features: str, shape: tuple[int, int], size: int) -> DataFrame:
    """Tiles of a table of row vectors with dense row numbers: vectors move, not single cells."""
    rows, columns = shape

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bi = key[0].as_py()
        panel = np.zeros((min(size, rows - bi * size), columns))
        for batch in batches:
            if batch.num_rows:
                panel[batch.column("i").to_numpy() - bi * size] = to_matrix(batch.column("features"))
        tiled = [(bi, bj, panel[:, bj * size : (bj + 1) * size]) for bj in range(-(-columns // size))]
        yield _tile_batch(tiled)

    vectors = df.select(F.col(row).cast("long").alias("i"), F.col(features).alias("features"))
    return vectors.withColumn("bi", whole_part(F.col("i"), size).cast("int")).groupBy("bi").applyInArrow(pack, TILE)


def transpose_tiles(tiled: DataFrame) -> DataFrame:
    """Tiles of the transposed matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bi, bj = batch.column("bi")[row].as_py(), batch.column("bj")[row].as_py()
                yield _tile_batch([(bj, bi, np.ascontiguousarray(_tile(batch, row, "").T))])

    return tiled.mapInArrow(run, TILE)


def _tile_batch(entries: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([e[0] for e in entries], pa.int32()),
            pa.array([e[1] for e in entries], pa.int32()),
            pa.array([e[2].shape[0] for e in entries], pa.int32()),
            pa.array([e[2].shape[1] for e in entries], pa.int32()),
            pa.array([e[2].tobytes() for e in entries], pa.binary()),
        ],
        schema=TILE_SCHEMA,
    )


def _tile(batch: pa.RecordBatch, row: int, side: str) -> np.ndarray:
    h, w = batch.column(f"h{side}")[row].as_py(), batch.column(f"w{side}")[row].as_py()
    return np.frombuffer(batch.column(f"tile{side}")[row].as_buffer(), np.float64).reshape(h, w)


def _multiply(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the tiles of one cell of the grid, added up per output tile."""
    stored: dict[int, list[tuple[int, np.ndarray]]] = {}
    for batch in right:
        for row in range(batch.num_rows):
            inner, bj = batch.column("inner")[row].as_py(), batch.column("bj")[row].as_py()
            stored.setdefault(inner, []).append((bj, _tile(batch, row, "")))
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in left:
        for row in range(batch.num_rows):
            bi, inner = batch.column("bi")[row].as_py(), batch.column("inner")[row].as_py()
            tile = _tile(batch, row, "")
            for bj, other in stored.get(inner, []):
                product = tile @ other
                held[bi, bj] = held[bi, bj] + product if (bi, bj) in held else product
    if held:
        yield _tile_batch([(*k, v) for k, v in held.items()])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the partial tiles of one task, as many at a time as its budget holds."""
    held: dict[tuple[int, int], np.ndarray] = {}
    size = 0
    for batch in batches:
        for row in range(batch.num_rows):
            key = batch.column("bi")[row].as_py(), batch.column("bj")[row].as_py()
            part = _tile(batch, row, "")
            if key in held:
                held[key] += part
                continue
            if size + part.nbytes > TASK_BUDGET and held:
                yield _tile_batch([(*k, v) for k, v in held.items()])
                held, size = {}, 0
            held[key] = part.copy()
            size += part.nbytes
    if held:
        yield _tile_batch([(*k, v) for k, v in held.items()])


def _add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum all partials of one output tile."""
    total = None
    for batch in batches:
        for row in range(batch.num_rows):
            part = _tile(batch, row, "")
            total = part.copy() if total is None else total + part
    yield _tile_batch([(key[0].as_py(), key[1].as_py(), total)])


def _unpack(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tile = _tile(batch, row, "")
                h, w = tile.shape
                i = batch.column("bi")[row].as_py() * size + np.repeat(np.arange(h, dtype=np.int64), w)
                j = batch.column("bj")[row].as_py() * size + np.tile(np.arange(w, dtype=np.int64), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.array(j), pa.array(tile.reshape(-1))], names=["i", "j", "v"]
                )

    return run


def matmul_blocks(
    a: DataFrame,
    b: DataFrame,
    a_shape: tuple[int, int] | None = None,
    b_shape: tuple[int, int] | None = None,
    size: int = 128,
) -> DataFrame:
    """C = A B for dense matrices of any shape, as cells (i, j, v).

    Tiles meet in the cells of a three-dimensional grid, so what is shuffled is tiles rather than the
    N * d^2 cell products, and every group has the same size.
    """
    a_shape, b_shape = a_shape or shape_of(a), b_shape or shape_of(b)
    if a_shape[1] != b_shape[0]:
        raise ValueError(f"inner sizes differ: {a_shape} and {b_shape}")
    return matmul_tiles(tiles(a, a_shape, size), tiles(b, b_shape, size), size)


def matmul_tiles(a: DataFrame, b: DataFrame, size: int = 128, grid: int = GRID, slab: int = SLAB) -> DataFrame:
    """Product of two tiled matrices, as cells (i, j, v).

    The work is a grid of ``grid`` x ``grid`` output tiles by ``slab`` inner blocks: a tile of the left
    matrix goes to every column of the grid, one of the right to every row, and each cell of the grid is a
    group of its own. What a group holds is the same whatever the shapes, and their number grows with all
    three sizes, so a long inner side is as many tasks as a long outer one. Partial tiles are added up in
    their task first, then by output tile.
    """
    rows, columns = (x.agg(F.max(c)).first()[0] for x, c in ((a, "bi"), (b, "bj")))
    if rows is None or columns is None:
        return a.sparkSession.createDataFrame([], "i long, j long, v double")

    def every(top: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(top // grid)))

    def part(name: str, width: int) -> Column:
        return whole_part(F.col(name), width).cast("int")

    left = a.withColumnRenamed("bj", "inner").select("*", part("bi", grid).alias("gi"), every(columns).alias("gj"))
    right = b.withColumnRenamed("bi", "inner").select("*", part("bj", grid).alias("gj"), every(rows).alias("gi"))
    keys = ["gi", "gj", "slab"]
    left, right = (x.withColumn("slab", part("inner", slab)).groupBy(*keys) for x in (left, right))

    def multiply(one: pa.Table, other: pa.Table) -> pa.Table:
        made = list(_multiply(iter(one.to_batches()), iter(other.to_batches())))
        return pa.Table.from_batches(made, TILE_SCHEMA)

    products = left.cogroup(right).applyInArrow(multiply, TILE).mapInArrow(_combine, TILE)
    whole = products.groupBy("bi", "bj").applyInArrow(_add, TILE)
    return whole.mapInArrow(_unpack(size), "i long, j long, v double")


def _inner_sizes(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """(inner, left, right, left_parts, right_parts) of the inner indices with over ``most`` cells on a side."""
    sizes = a.groupBy("inner").agg(F.count("*").alias("left"))
    sizes = sizes.join(b.groupBy("inner").agg(F.count("*").alias("right")), "inner")
    parts = [F.ceil(F.col(x) / most).cast("int").alias(f"{x}_parts") for x in ("left", "right")]
    return sizes.where((F.col("left") > most) | (F.col("right") > most)).select("*", *parts)


def _with_parts(cells: DataFrame, heavy: DataFrame, hot: DataFrame) -> DataFrame:
    """Cells with the numbers of parts of their inner index, one for an index that is not heavy.

    Rows of the hot indices, which may each hold a large share of all, meet theirs by a broadcast and never
    move; those of the others are shuffled by index.
    """
    few = cells.join(F.broadcast(hot), "inner")
    rest = cells.join(F.broadcast(hot.select("inner")), "inner", "left_anti")
    cold = heavy.join(F.broadcast(hot.select("inner")), "inner", "left_anti")
    both = few.unionByName(rest.join(cold, "inner", "left").select(*few.columns))
    return both.fillna(1, ["left_parts", "right_parts"])


def matmul_cells(a: DataFrame, b: DataFrame, most: int = HEAVY) -> DataFrame:
    """C = A B for sparse matrices: join on the inner index, add up per cell.

    The cells of an inner index make as many products as one side has cells times the other. Where either
    side has more than ``most``, both are cut into parts of about that many, every part of one side meets
    every part of the other under a key of its own, and no task makes more than ``most`` squared of them.
    Heavy indices are counted first; without any, cells are joined as they are. At most 2000 indices, those
    with over a thousandth of a side's cells, are broadcast.
    """
    left = a.select("i", F.col("j").alias("inner"), F.col("v").alias("_a"))
    right = b.select(F.col("i").alias("inner"), "j", F.col("v").alias("_b"))
    product = F.sum(F.col("_a") * F.col("_b")).alias("v")
    heavy = stored(_inner_sizes(left, right, most), "matmul-heavy")
    if heavy.isEmpty():
        return left.join(right, "inner").groupBy("i", "j").agg(product)
    totals = [x.count() for x in (left, right)]
    hot = heavy.where((F.col("left") * 1000 > totals[0]) | (F.col("right") * 1000 > totals[1]))
    columns = ["inner", "left_parts", "right_parts"]
    heavy, hot = heavy.select(*columns), hot.select(*columns)

    def cut(cells: DataFrame, own: str, other: str, place: str, value: str) -> DataFrame:
        """Each cell, repeated ones added up, in its part of its own side, once for every part of the other."""
        cells = cells.groupBy("inner", place).agg(F.sum(value).alias(value))
        mine = F.pmod(F.xxhash64(place), F.col(f"{own}_parts")).cast("int").alias(f"_{own}")
        theirs = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"_{other}")
        return _with_parts(cells, heavy, hot).select(*cells.columns, mine, theirs)

    lefts = cut(left, "left", "right", "i", "_a")
    rights = cut(right, "right", "left", "j", "_b")
    return lefts.join(rights, ["inner", "_left", "_right"]).groupBy("i", "j").agg(product)


def transpose_table(
    df: DataFrame, keys: list[str], header: str, metrics: list[str], values: list | None = None
) -> DataFrame:
    """Turn metric columns into rows and the values of ``header`` into columns."""
    long = df.unpivot([*keys, header], metrics, "metric", "_value")
    return long.groupBy(*keys, "metric").pivot(header, values).agg(F.max("_value"))


def dataset_shape(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows and vector length (smallest and largest)."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.min(F.size(features)).alias("min_width"),
        F.max(F.size(features)).alias("max_width"),
    )


def rename_select(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the named columns, in this order, under their new names."""
    columns: list[Column] = [F.col(old).alias(new) for old, new in names.items()]
    return df.select(*columns)


def union_results(*parts: DataFrame) -> DataFrame:
    """Rows of separately built results as one table, matched by column name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
