"""Ridge weights when the d x d system is too large for one task: a blocked factorisation of a table of tiles.

The centred Gram matrix is a table of square tiles, one row each, for every fold and lambda at once; the
targets of the classes are further rows of tiles below it. Step k takes the tiles of column k: each is
divided by the diagonal tile (a symmetric factorisation without square roots, so a matrix that rounding has
left indefinite is no obstacle), and its products with the others are subtracted from what lies to the right.
The rows of the targets thus go through the forward substitution; a second loop substitutes backwards. Every
step is a join and a table in the shared folder. The driver only counts the steps: no vector comes to it and
nothing is broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.vectors import lambda_array
from ridgeworks.operators.solve import SCHEMA, Fold, weight_rows
from ridgeworks.session import discard, shared_path, stored

# rows and columns of a tile: 8 MB
TILE = 1024
# bytes of the weights of one set of classes
CLASS_BYTES = 64 * 1024 * 1024

STATE = "fold int, lambda_id int, bi int, bj int, h int, w int, tile binary"
STATE_NAMES = [x.split()[0] for x in STATE.split(", ")]


def _matrix(batch: pa.RecordBatch, row: int, name: str, h: int | str = "h", w: int | str = "w") -> np.ndarray:
    """A tile of a batch; its size is given or stands in the named columns."""
    h, w = (x if isinstance(x, int) else batch.column(x)[row].as_py() for x in (h, w))
    return np.frombuffer(batch.column(name)[row].as_buffer(), np.float64).reshape(h, w)


def _vector(batch: pa.RecordBatch, row: int, name: str) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy()


def _rows(schema: str, entries: list[tuple]) -> pa.RecordBatch:
    """A batch of rows; arrays become bytes or lists."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*[x.split() for x in schema.split(", ")], strict=True)
    columns = []
    for kind, values in zip(types, zip(*entries, strict=True) if entries else [[]] * len(types), strict=True):
        if kind == "binary":
            values = [np.ascontiguousarray(v).tobytes() for v in values]
        columns.append(pa.array(values, kinds[kind]))
    return pa.RecordBatch.from_arrays(columns, list(names))


class Layout:
    """How a matrix of ``width`` columns and its classes are cut into tiles."""

    def __init__(self, width: int, classes: list[int], tile: int):
        self.width, self.tile = width, tile
        self.blocks = -(-width // tile)
        self.class_rows = max(1, min(tile, CLASS_BYTES // (8 * width)))
        self.place = {label: i for i, label in enumerate(classes)}
        self.class_blocks = -(-len(classes) // self.class_rows)

    def size(self, block: int) -> int:
        return min(self.tile, self.width - block * self.tile)

    def classes_in(self, block: int) -> int:
        return min(self.class_rows, len(self.place) - block * self.class_rows)


def _class_pieces(moments: DataFrame, at: Layout) -> DataFrame:
    """Class sums in pieces of a tile: (segment, label, place, n, block, piece); place -1: not asked for."""
    schema = "segment int, label int, place int, n long, block int, piece array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment, label, n = (batch.column(x)[row].as_py() for x in ("segment", "key", "n"))
                vals = _vector(batch, row, "vals")
                place = at.place.get(label, -1)
                yield _rows(
                    schema,
                    [
                        (segment, label, place, n, k, vals[k * at.tile : (k + 1) * at.tile])
                        for k in range(at.blocks)
                    ],
                )

    return moments.where("kind = 'class'").mapInArrow(run, schema)


def _segment_sums(pieces: DataFrame, at: Layout) -> DataFrame:
    """(segment, block, n, total): rows of a segment and the sum of its vectors, by piece."""
    schema = "segment int, block int, n long, total array<double>"

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, block = key[0].as_py(), key[1].as_py()
        n, total = 0, np.zeros(at.size(block))
        for batch in batches:
            for row in range(batch.num_rows):
                n += batch.column("n")[row].as_py()
                total += _vector(batch, row, "piece")
        yield _rows(schema, [(segment, block, n, total)])

    return pieces.groupBy("segment", "block").applyInArrow(add, schema)


def _fold_means(sums: DataFrame, at: Layout, center: str) -> DataFrame:
    """(fold, block, n, n_all, total, mean): what centring needs of a fold, by piece."""
    schema = "fold int, block int, n long, n_all long, total array<double>, mean array<double>"

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, block = key[0].as_py(), key[1].as_py()
        n, n_all, total, every = 0, 0, np.zeros(at.size(block)), np.zeros(at.size(block))
        for batch in batches:
            for row in range(batch.num_rows):
                rows, part = batch.column("n")[row].as_py(), _vector(batch, row, "total")
                n_all, every = n_all + rows, every + part
                if batch.column("in_train")[row].as_py():
                    n, total = n + rows, total + part
        mean = {"all": every / max(n_all, 1), "train": total / max(n, 1), "none": 0 * total}[center]
        yield _rows(schema, [(fold, block, n, n_all, total, mean)])

    return sums.groupBy("fold", "block").applyInArrow(merge, schema)


def _gram_tiles(moments: DataFrame, at: Layout) -> DataFrame:
    """Lower tiles of every segment's squares: (segment, bi, bj, h, w, tile)."""
    cut = "segment int, bi int, bj int, line int, piece array<double>"
    packed = "segment int, bi int, bj int, h int, w int, tile binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment, line = batch.column("segment")[row].as_py(), batch.column("key")[row].as_py()
                vals = _vector(batch, row, "vals")
                vals = vals[: at.width - line]  # of co-moments the mean follows
                own = line // at.tile
                entries = []
                for bi in range(own, at.blocks):
                    first, end = max(bi * at.tile, line) - line, bi * at.tile + at.size(bi) - line
                    entries.append((segment, bi, own, line - own * at.tile, vals[first:end]))
                yield _rows(cut, entries)

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, bi, bj = (x.as_py() for x in key)
        tile = np.zeros((at.size(bi), at.size(bj)))
        for batch in batches:
            for row in range(batch.num_rows):
                line, piece = batch.column("line")[row].as_py(), _vector(batch, row, "piece")
                tile[len(tile) - len(piece) :, line] = piece
        if bi == bj:
            tile += np.tril(tile, -1).T
        yield _rows(packed, [(segment, bi, bj, *tile.shape, tile)])

    squares = moments.where("kind IN ('gram', 'comoment')")
    pieces = squares.mapInArrow(run, cut)
    return pieces.groupBy("segment", "bi", "bj").applyInArrow(pack, packed)


def _target_tiles(pieces: DataFrame, at: Layout) -> DataFrame:
    """Class sums of a fold's training rows as tiles: (fold, c, bj, tile, counts); a class of no rows is zero."""
    schema = "fold int, c int, bj int, tile binary, counts binary"

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, c, bj = (x.as_py() for x in key)
        tile, counts = np.zeros((at.classes_in(c), at.size(bj))), np.zeros(at.classes_in(c))
        for batch in batches:
            for row in range(batch.num_rows):
                line = batch.column("place")[row].as_py() - c * at.class_rows
                tile[line] += _vector(batch, row, "piece")
                counts[line] += batch.column("n")[row].as_py()
        yield _rows(schema, [(fold, c, bj, tile, counts)])

    held = pieces.where("place >= 0").withColumn("c", F.floor(F.col("place") / at.class_rows).cast("int"))
    return held.groupBy("fold", "c", F.col("block").alias("bj")).applyInArrow(pack, schema)


def _centred_gram(tiles: DataFrame, means: DataFrame, sums: DataFrame, at: Layout, stable: bool) -> DataFrame:
    """Centred squares of a fold's training rows, added up over its segments; zero without such rows."""
    schema = "fold int, bi int, bj int, tile binary"

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                fold, bi, bj, n = (batch.column(x)[row].as_py() for x in ("fold", "bi", "bj", "n"))
                tile = _matrix(batch, row, "tile")
                mi, mj, si, sj = (_vector(batch, row, x) for x in ("mean_i", "mean_j", "total_i", "total_j"))
                if stable:
                    tile = tile + np.outer(si / n - mi, n * (sj / n - mj))
                else:
                    tile = tile + np.outer(n * mi - si, mj) - np.outer(mi, sj)
                yield _rows(schema, [(fold, bi, bj, tile)])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, bi, bj = (x.as_py() for x in key)
        total = np.zeros((at.size(bi), at.size(bj)))
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("tile")[row].is_valid:
                    total += _matrix(batch, row, "tile", *total.shape)
        yield _rows(schema, [(fold, bi, bj, total)])

    own = sums.where("in_train").select("fold", "segment", "block", "n", "total")
    i = means.select("fold", F.col("block").alias("bi"), F.col("mean").alias("mean_i"))
    j = means.select("fold", F.col("block").alias("bj"), F.col("mean").alias("mean_j"))
    ti = own.select("fold", "segment", F.col("block").alias("bi"), "n", F.col("total").alias("total_i"))
    tj = own.select("segment", "fold", F.col("block").alias("bj"), F.col("total").alias("total_j"))
    met = tiles.join(ti, ["segment", "bi"]).join(tj, ["fold", "segment", "bj"])
    met = met.join(i, ["fold", "bi"]).join(j, ["fold", "bj"])
    # every fold has all tiles, rows to train on or not
    place = means.select("fold", F.col("block").alias("bi"), F.explode(F.sequence(F.lit(0), "block")).alias("bj"))
    empty = place.select("fold", "bi", F.col("bj").cast("int").alias("bj"), F.lit(None).cast("binary").alias("tile"))
    return met.mapInArrow(centre, schema).unionByName(empty).groupBy("fold", "bi", "bj").applyInArrow(add, schema)


def _centred_targets(tiles: DataFrame, means: DataFrame, at: Layout) -> DataFrame:
    """X^T Y of the centred training rows, as rows of tiles below the Gram matrix."""
    schema = "fold int, bi int, bj int, tile binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                fold, c, bj, n = (batch.column(x)[row].as_py() for x in ("fold", "c", "bj", "n"))
                own, counts = np.zeros((at.classes_in(c), at.size(bj))), np.zeros(at.classes_in(c))
                if batch.column("tile")[row].is_valid:
                    own = _matrix(batch, row, "tile", *own.shape)
                    counts = _matrix(batch, row, "counts", len(counts), 1)[:, 0]
                total, mean = _vector(batch, row, "total"), _vector(batch, row, "mean")
                targets = (2 * own - total) - np.outer(2 * counts - n, mean)
                yield _rows(schema, [(fold, at.blocks + c, bj, targets)])

    every = F.explode(F.sequence(F.lit(0), F.lit(at.class_blocks - 1))).alias("c")
    place = means.select("fold", F.col("block").alias("bj"), "n", "total", "mean", every)
    return place.join(tiles, ["fold", "c", "bj"], "left").mapInArrow(run, schema)


def _penalised(tiles: DataFrame, means: DataFrame, lambdas: list[float], reg_scale: str, at: Layout) -> DataFrame:
    """The tiles once for every lambda, which is added to the diagonal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                fold, index, bi, bj, n = (batch.column(x)[row].as_py() for x in ("fold", "lambda_id", "bi", "bj", "n_all"))
                h = at.size(bi) if bi < at.blocks else at.classes_in(bi - at.blocks)
                tile = _matrix(batch, row, "tile", h, at.size(bj))
                if bi == bj:
                    tile = tile + lambdas[index] * (n if reg_scale == "n" else 1.0) * np.eye(h)
                yield _rows(STATE, [(fold, index, bi, bj, *tile.shape, tile)])

    counts = means.where("block = 0").select("fold", "n_all")
    grid = F.explode(F.transform(lambda_array(lambdas), lambda x: x["lambda_id"])).alias("lambda_id")
    return tiles.join(counts, "fold").select("*", grid).mapInArrow(run, STATE)


def _factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tiles below a diagonal tile, and each times the inverse of that."""
    for batch in batches:
        for row in range(batch.num_rows):
            fold, index, bi, bj, h, w = (batch.column(x)[row].as_py() for x in STATE_NAMES[:-1])
            tile = _matrix(batch, row, "tile")
            part = np.linalg.solve(_matrix(batch, row, "diagonal", w, w), tile.T).T
            yield _rows(f"{STATE}, part binary", [(fold, index, bi, bj, h, w, tile, part)])


def _less(left: str, right: str, inner: str, transposed: bool):
    """tile - left @ right (or its transpose), where ``inner`` names the column of their common size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                head = [batch.column(x)[row].as_py() for x in STATE_NAMES[:-1]]
                a = _matrix(batch, row, left, "h", inner)
                b = _matrix(batch, row, right, *(("w", inner) if transposed else (inner, "w")))
                yield _rows(STATE, [(*head, _matrix(batch, row, "tile") - a @ (b.T if transposed else b))])

    return run


def _solved(state: DataFrame, at: Layout) -> DataFrame:
    """Rows of the transposed weights: (fold, lambda_id, bi, bj, h, w, tile), bi numbering the classes' sets."""
    spark, key = state.sparkSession, ["fold", "lambda_id"]
    path = shared_path(spark, "wide-factors")
    rest = state
    for k in range(at.blocks):
        column = rest.where(F.col("bj") == k)
        diagonal = column.where(F.col("bi") == k).select(*key, F.col("tile").alias("diagonal"))
        below = column.where(F.col("bi") > k).join(diagonal, key).mapInArrow(_factored, f"{STATE}, part binary")
        below.write.mode("append").parquet(path)
        factors = spark.read.schema(below.schema).parquet(path)
        if k == at.blocks - 1:
            break
        new = factors.where(F.col("bj") == k)
        left = new.select(*key, "bi", F.col("part").alias("left"), F.col("w").alias("inner"))
        right = new.where(F.col("bi") < at.blocks).select(*key, F.col("bi").alias("bj"), F.col("tile").alias("right"))
        met = rest.where(F.col("bj") > k).join(left, [*key, "bi"]).join(right, [*key, "bj"])
        rest, done = stored(met.mapInArrow(_less("left", "right", "inner", True), STATE), "wide-rest"), rest
        discard(done)
    targets = factors.where(F.col("bi") >= at.blocks).select(*STATE_NAMES[:-1], F.col("part").alias("tile"))
    finals = []
    for k in range(at.blocks - 1, 0, -1):
        own = targets.where(F.col("bj") == k)
        finals.append(own)
        right = own.select(*key, "bi", F.col("tile").alias("left"), F.col("w").alias("inner"))
        line = factors.where(F.col("bi") == k).select(*key, "bj", F.col("part").alias("right"))
        met = targets.where(F.col("bj") < k).join(right, [*key, "bi"]).join(line, [*key, "bj"])
        targets = stored(met.mapInArrow(_less("left", "right", "inner", False), STATE), "wide-targets")
    for part in finals:
        targets = targets.unionByName(part)
    return targets


def _assembled(parts: DataFrame, means: DataFrame, lambdas: list[float], classes: list[int], at: Layout) -> DataFrame:
    """Weight rows out of their pieces, with the centre of their fold."""
    schema = "fold int, centre array<double>"

    def whole(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.zeros(at.width)
        for batch in batches:
            for row in range(batch.num_rows):
                first = batch.column("block")[row].as_py() * at.tile
                piece = _vector(batch, row, "mean")
                mean[first : first + len(piece)] = piece
        yield _rows(schema, [(key[0].as_py(), mean)])

    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, index, c = key[0].as_py(), key[1].as_py(), key[2].as_py() - at.blocks
        weights, centre = np.zeros((at.classes_in(c), at.width)), None
        for batch in batches:
            for row in range(batch.num_rows):
                first = batch.column("bj")[row].as_py() * at.tile
                piece = _matrix(batch, row, "tile")
                weights[:, first : first + piece.shape[1]] = piece
                centre = _vector(batch, row, "centre")
        own = classes[c * at.class_rows : c * at.class_rows + len(weights)]
        yield weight_rows(fold, index, lambdas[index], own, weights, centre)

    centres = means.groupBy("fold").applyInArrow(whole, schema)
    return parts.join(centres, "fold").groupBy("fold", "lambda_id", "bi").applyInArrow(join, SCHEMA)


def _tied(weights: DataFrame, present: DataFrame, folds: list[Fold], classes: list[int]) -> DataFrame:
    """Classes without training rows of a fold get one result, to the last bit: that of the first of them."""
    if present.count() == len(folds) * len(classes):
        return weights
    spark = weights.sparkSession
    every = spark.createDataFrame([(f.fold,) for f in folds], "fold int")
    every = every.select("fold", F.explode(F.lit(classes)).alias("label"))
    absent = every.join(present, ["fold", "label"], "left_anti")
    first = absent.groupBy("fold").agg(F.min("label").alias("first"))
    asked = every.join(absent.join(first, "fold"), ["fold", "label"], "left")
    asked = asked.select("fold", "label", F.coalesce("first", "label").alias("source"))
    taken = weights.withColumnRenamed("label", "source").join(asked, ["fold", "source"])
    return taken.select("fold", "lambda_id", "lambda", "label", "weights", "centre")


def solve_wide(
    moments: DataFrame,
    folds: list[Fold],
    lambdas: list[float],
    classes: list[int],
    center: str = "all",
    reg_scale: str = "none",
    tile: int = TILE,
) -> DataFrame:
    """Same result as ``solve_ridge`` for moments kept in a checkpoint, whatever their width.

    A task holds three tiles at a time, or the weights of one set of classes. A matrix that is singular for
    some lambda is an error, as it is there.
    """
    spark = moments.sparkSession
    heads = moments.agg(F.max(F.when(F.col("kind") == "class", F.size("vals"))), F.max(F.col("kind") == "comoment"))
    width, stable = heads.first()
    at = Layout(width, classes, tile)
    roles = [(s, f.fold, True) for f in folds for s in f.train] + [(s, f.fold, False) for f in folds for s in f.others]
    roles = spark.createDataFrame(roles, "segment int, fold int, in_train boolean")
    pieces = stored(_class_pieces(moments, at), "wide-classes")
    sums = stored(_segment_sums(pieces, at).join(roles, "segment"), "wide-sums")
    means = stored(_fold_means(sums, at, center), "wide-means")
    trained = pieces.join(roles.where("in_train"), "segment")
    gram = _centred_gram(_gram_tiles(moments, at), means, sums, at, bool(stable))
    targets = _centred_targets(_target_tiles(trained, at), means, at)
    state = stored(_penalised(gram.unionByName(targets), means, lambdas, reg_scale, at), "wide-tiles")
    weights = _assembled(_solved(state, at), means, lambdas, classes, at)
    present = trained.where("place >= 0 AND block = 0").select("fold", "label").distinct()
    return _tied(stored(weights, "wide-weights"), present, folds, classes)
