"""One-pass sums over feature vectors: counts, sums, class sums and the Gram matrix.

Every scan task adds up its own rows with BLAS and ships one partial result; the partials are
keyed by matrix row, so they are merged by many tasks. What is shuffled depends on the number of
scan tasks and the vector length, never on the number of rows or on how labels are distributed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import to_matrix

SCHEMA = "segment int, kind string, key int, n long, vals array<double>"
ARROW_SCHEMA = pa.schema(
    [
        ("segment", pa.int32()),
        ("kind", pa.string()),
        ("key", pa.int32()),
        ("n", pa.int64()),
        ("vals", pa.list_(pa.float64())),
    ]
)
# bytes of partial Gram matrices one task may hold before it ships them
TASK_BUDGET = 512 * 1024 * 1024
BATCH_BYTES = 16 * 1024 * 1024
# up to here class sums are fastest as one product with a membership matrix
FEW_CLASSES = 64


class Partial:
    """Running sums of one segment inside one task.

    The squares are held as column panels. What exceeds the budget of the task is not held: rows are
    gathered up to that budget, and the products of their other panels are shipped at once, so that one
    scan serves vectors of any length. With ``stable`` squares are taken about the mean of the rows added
    up, and two sets of rows are merged by the distance of their means.
    """

    def __init__(self, width: int, gram: bool, stable: bool, budget: int):
        self.stable, self.width = stable, width
        self.class_n: dict[int, int] = {}
        self.class_sum: dict[int, np.ndarray] = {}
        self.panels: list[tuple[int, int]] = []
        self.held: dict[tuple[int, int], list] = {}
        self.waiting: list[np.ndarray] = []
        self.wide = 8 * width * width > budget
        if gram:
            step = width if not self.wide else max(1, budget // 4 // (8 * width))
            self.panels = [(p, min(p + step, width)) for p in range(0, width, step)]
        self.kept = set(self.panels[:1] if self.wide else self.panels)
        self.most = budget // 2

    def add(self, x: np.ndarray, y: np.ndarray, with_sums: bool) -> None:
        if with_sums:
            labels, place, counts = np.unique(y, return_inverse=True, return_counts=True)
            if len(labels) <= FEW_CLASSES:
                sums = (place[None, :] == np.arange(len(labels))[:, None]).astype(np.float64) @ x
            else:
                starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
                sums = np.add.reduceat(x[np.argsort(place, kind="stable")], starts, axis=0)
            for label, count, total in zip(labels.tolist(), counts.tolist(), sums, strict=True):
                self.class_n[label] = self.class_n.get(label, 0) + count
                self.class_sum[label] = self.class_sum.get(label, 0.0) + total
        if self.panels:
            self.waiting.append(x)

    def full(self) -> bool:
        """Whether the rows that wait are to be multiplied: at once where all panels are held."""
        return not self.wide or sum(x.nbytes for x in self.waiting) > self.most

    def multiply(self, segment: int) -> Iterator[pa.RecordBatch]:
        """Take in the rows that wait; ship the panels that are not held."""
        if not self.waiting:
            return
        x = self.waiting[0] if len(self.waiting) == 1 else np.concatenate(self.waiting)
        self.waiting = []
        mean = x.mean(axis=0) if self.stable else None
        if self.stable:
            x = x - mean
        for panel in self.panels:
            first, last = panel
            part = [len(x), x[:, first:last].T @ x[:, first:], mean]
            if panel not in self.kept:
                yield from self._panel_rows(segment, panel, part)
            elif panel not in self.held:
                self.held[panel] = part
            else:
                held = self.held[panel]
                if self.stable:
                    n = held[0] + len(x)
                    away = mean - held[2]
                    held[1] += np.outer(away[first:last] * (held[0] * len(x) / n), away[first:])
                    held[2] = held[2] + away * (len(x) / n)
                held[0] += len(x)
                held[1] += part[1]

    def class_rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        """Ship the class sums and start them anew."""
        labels = sorted(self.class_sum)
        step = max(1, BATCH_BYTES // (8 * max((len(v) for v in self.class_sum.values()), default=1)))
        for start in range(0, len(labels), step):
            some = labels[start : start + step]
            vals = [self.class_sum[label] for label in some]
            yield batch_of(segment, "class", some, [self.class_n[k] for k in some], vals)
        self.class_n, self.class_sum = {}, {}

    def _panel_rows(self, segment: int, panel: tuple[int, int], part: list) -> Iterator[pa.RecordBatch]:
        (first, last), (n, squares, mean) = panel, part
        kind, count = ("comoment", n) if self.stable else ("gram", 0)
        step = max(1, BATCH_BYTES // (8 * squares.shape[1]))
        for start in range(first, last, step):
            keys = list(range(start, min(start + step, last)))
            upper = [squares[i - first, i - first :] for i in keys]
            if self.stable:
                upper = [np.concatenate((v, mean[i:])) for i, v in zip(keys, upper, strict=True)]
            yield batch_of(segment, kind, keys, [count] * len(keys), upper)

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        yield from self.class_rows(segment)
        yield from self.multiply(segment)
        for panel, part in self.held.items():
            yield from self._panel_rows(segment, panel, part)


def batch_of(segment, kind, keys, counts, vals) -> pa.RecordBatch:
    """Rows of the moments table; segment and kind may be one value for all rows."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in vals]))).astype(np.int32)
    arrays = [
        pa.array(segment if isinstance(segment, list) else [segment] * len(keys), pa.int32()),
        pa.array(kind if isinstance(kind, list) else [kind] * len(keys), pa.string()),
        pa.array(keys, pa.int32()),
        pa.array(counts, pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(vals))),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW_SCHEMA)


def finite_matrix(column: pa.Array) -> np.ndarray:
    x = to_matrix(column)
    if not np.isfinite(x.sum()) and not np.isfinite(x).all():
        raise ValueError("feature vector with a value that is not finite")
    return x


def _partials(gram: bool, gram_segments: set[int] | None, stable: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Partial] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = finite_matrix(batch.column("features"))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            place = batch.column("segment").to_numpy(zero_copy_only=False)
            width = x.shape[1]
            for segment in np.unique(place):
                segment = int(segment)
                wanted = gram and (gram_segments is None or segment in gram_segments)
                if segment not in held:
                    # a matrix too large for the task has a budget of its own, of that size
                    size = min(8 * width * width, TASK_BUDGET) if gram else 0
                    if held and (len(held) + 1) * size > TASK_BUDGET:
                        for done, partial in held.items():
                            yield from partial.rows(done)
                        held = {}
                    held[segment] = Partial(width, wanted, stable, TASK_BUDGET)
                inside = place == segment
                partial = held[segment]
                if inside.all():
                    partial.add(x, y, True)
                else:
                    partial.add(x[inside], y[inside], True)
                if partial.full():
                    yield from partial.multiply(segment)
            if 8 * width * sum(len(part.class_sum) for part in held.values()) > TASK_BUDGET // 2:
                for segment, partial in held.items():
                    yield from partial.class_rows(segment)
        for segment, partial in held.items():
            yield from partial.rows(segment)

    return run


def _merge(total: list, n: int, part: np.ndarray, pairwise: bool) -> None:
    """Add a partial; of co-moments the second half is the mean of its n rows."""
    if pairwise:
        half, whole = len(part) // 2, total[0] + n
        away = part[half:] - total[1][half:]
        total[1][:half] += part[:half] + away * (away[0] * (total[0] * n / whole))
        total[1][half:] += away * (n / whole)
    else:
        total[1] += part
    total[0] += n


def merge_partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up partials; all rows of a (segment, kind, key) are in this partition."""
    held: dict[tuple, list] = {}
    for batch in batches:
        keys = zip(
            batch.column("segment").to_pylist(),
            batch.column("kind").to_pylist(),
            batch.column("key").to_pylist(),
            batch.column("n").to_pylist(),
            strict=True,
        )
        vals = batch.column("vals")
        offsets = vals.offsets.to_numpy()
        flat = vals.values.to_numpy()
        for row, (segment, kind, key, n) in enumerate(keys):
            part = flat[offsets[row] : offsets[row + 1]]
            total = held.get((segment, kind, key))
            if total is None:
                held[segment, kind, key] = [n, part.copy()]
            elif len(total[1]) != len(part):
                raise ValueError("feature vectors differ in length")
            else:
                _merge(total, n, part, kind == "comoment")
    entries = list(held.items())
    step = max(1, BATCH_BYTES // (8 * max((len(e[1][1]) for e in entries), default=1)))
    for at in range(0, len(entries), step):
        some = entries[at : at + step]
        segments, kinds, keys = (list(part) for part in zip(*[e[0] for e in some], strict=True))
        yield batch_of(segments, kinds, keys, [e[1][0] for e in some], [e[1][1] for e in some])


def feature_width(df: DataFrame, features: str = "features") -> int:
    row = df.select(F.size(features)).first()
    if row is None:
        raise ValueError("no rows to learn from")
    return row[0]


def known_label(label: Column) -> Column:
    """The label as an int; null is an error."""
    return F.coalesce(label.cast("int"), F.raise_error(F.lit("null label")).cast("int"))


def class_moments(
    df: DataFrame,
    features: str = "features",
    label: str | None = "label",
    segment: Column | None = None,
    gram: bool = True,
    gram_segments: Iterable[int] | None = None,
    stable: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Sums per segment in one scan: (segment, kind, key, n, vals).

    ``kind`` "class": key is the label, n its rows, vals the sum of their vectors.
    ``kind`` "gram": key is i, vals the elements i, i+1, ... of row i of the sum of x x^T.
    ``kind`` "comoment", in place of "gram" with ``stable``: n rows, vals those elements of the sum of
    (x - mean) (x - mean)^T, and after them the elements i, i+1, ... of the mean. Partial co-moments are
    merged pairwise, so a mean that dwarfs the spread costs no digits.
    Rows with a null segment are skipped; ``partitions`` fixes the number of merging tasks. Matrices beyond
    the budget of a task are shipped in parts while the rows are read; they are never read again.
    """
    rows = df.select(
        F.col(features).alias("features"),
        known_label(F.col(label) if label else F.lit(0)).alias("label"),
        (F.lit(0) if segment is None else segment).cast("int").alias("segment"),
    ).where(F.col("segment").isNotNull())
    wanted = None if gram_segments is None else set(gram_segments)
    partials = rows.mapInArrow(_partials(gram, wanted, stable), SCHEMA)
    keys = ["segment", "kind", "key"]
    merged = partials.repartition(partitions, *keys) if partitions else partials.repartition(*keys)
    return merged.mapInArrow(merge_partials, SCHEMA)


def gram_matrix(df: DataFrame, features: str = "features") -> DataFrame:
    """Upper triangle of X^T X as cells (i, j, v)."""
    sums = class_moments(df, features, label=None).where("kind = 'gram'")
    cells = sums.select(F.col("key").alias("i"), F.posexplode("vals").alias("_step", "v"))
    return cells.select("i", (F.col("i") + F.col("_step")).alias("j"), "v")


def mean_vector(df: DataFrame, features: str = "features") -> DataFrame:
    """Mean image as (pos, mean)."""
    sums = class_moments(df, features, label=None, gram=False)
    cells = sums.select("n", F.posexplode("vals").alias("pos", "_sum"))
    return cells.select("pos", (F.col("_sum") / F.col("n")).alias("mean"))


def class_sums(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """X^T Y for the +1 / -1 targets of every class: (label, pos, v).

    The signed sum of a class is twice its own sum less the sum of all rows, so one pass serves
    all classes.
    """
    sums = class_moments(df, features, label, gram=False)
    cells = sums.select(F.col("key").alias("label"), F.posexplode("vals").alias("pos", "_sum"))
    total = F.sum("_sum").over(Window.partitionBy("pos"))  # one row per class
    return cells.select("label", "pos", (2 * F.col("_sum") - total).alias("v"))


def centre(df: DataFrame, features: str = "features", name: str = "centred") -> DataFrame:
    """Subtract the mean vector of all rows; the mean reaches the rows as one scalar value."""
    cells = mean_vector(df, features).agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("m"))
    mean = cells.select(F.col("m.mean")).scalar()
    shifted = df.withColumn("_mean", mean)
    return shifted.withColumn(name, F.zip_with(features, "_mean", lambda x, m: x - m)).drop("_mean")
