"""Ridge weights for every (fold, lambda) from merged moments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import to_list_array, to_matrix
from ridgeworks.functions.vectors import lambda_array
from ridgeworks.operators.moments import TASK_BUDGET, Partial, finite_matrix

SCHEMA = (
    "fold int, lambda_id int, lambda double, label int, weights array<double>, centre array<double>"
)
ARROW_SCHEMA = pa.schema(
    [
        ("fold", pa.int32()),
        ("lambda_id", pa.int32()),
        ("lambda", pa.float64()),
        ("label", pa.int32()),
        ("weights", pa.list_(pa.float64())),
        ("centre", pa.list_(pa.float64())),
    ]
)
# widest vector whose d x d system is solved inside one task (0.13 GB a matrix)
DENSE_LIMIT = 4096


@dataclass(frozen=True)
class Fold:
    """One fit: which segments train, which only count for the mean, which validate."""

    fold: int
    train: tuple[int, ...]
    others: tuple[int, ...] = field(default=())
    validation: tuple[int, ...] = field(default=())


def distinct_columns(matrix: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The different columns, and for each column its place among them.

    Equal columns (classes without training rows) then give equal results to the last bit, so
    that ties between them are ties.
    """
    seen: dict[bytes, int] = {}
    place, first = [], []
    for column, values in enumerate(np.ascontiguousarray(matrix.T)):
        at = seen.setdefault(values.tobytes(), len(first))
        if at == len(first):
            first.append(column)
        place.append(at)
    return np.ascontiguousarray(matrix[:, first]), place


class FoldMoments:
    """Centred Gram matrix, targets and mean of one fold, assembled from its segments' sums."""

    def __init__(self, batches: Iterator[pa.RecordBatch], classes: list[int], center: str):
        self.gram = None
        # rows and mean of every set of rows whose squares were taken about that mean
        about: list[tuple[int, np.ndarray]] = []
        train_sum: dict[int, np.ndarray] = {}
        train_n: dict[int, int] = {}
        all_sum, self.n_all = 0.0, 0
        self.lambdas: dict[int, float] = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("in_train", "kind", "key", "n")]
            vals = batch.column("vals")
            offsets, flat = vals.offsets.to_numpy(), vals.values.to_numpy()
            for row, (in_train, kind, key, n) in enumerate(zip(*columns, strict=True)):
                part = flat[offsets[row] : offsets[row + 1]]
                if kind == "class":
                    all_sum, self.n_all = all_sum + part, self.n_all + n
                    if in_train:
                        train_sum[key] = train_sum.get(key, 0.0) + part
                        train_n[key] = train_n.get(key, 0) + n
                elif in_train:
                    if kind == "comoment":
                        part, own_mean = np.split(part, 2)
                        if key == 0:
                            about.append((n, own_mean))
                    d = key + len(part)
                    if self.gram is None:
                        self.gram = np.zeros((d, d))
                    self.gram[key, key:] += part
        d, n = len(all_sum), sum(train_n.values())
        if self.gram is None:  # too few rows to train on: all weights are 0
            self.gram = np.zeros((d, d))
        total = sum(train_sum.values(), np.zeros(d))
        mean = {"all": all_sum / self.n_all, "train": total / max(n, 1), "none": np.zeros(d)}[center]
        self.mean = mean
        self.gram += np.triu(self.gram, 1).T
        if about:
            away = np.array([own_mean - mean for _, own_mean in about])
            self.gram += (away.T * [rows for rows, _ in about]) @ away
        else:
            self.gram += np.column_stack((n * mean - total, -mean)) @ np.vstack((mean, total))
        own = np.array([train_sum.get(k, np.zeros(d)) for k in classes])
        count = np.array([train_n.get(k, 0) for k in classes])
        targets = ((2 * own - total) - np.outer(2 * count - n, mean)).T  # d x classes
        self.targets, self.place = distinct_columns(targets)


def _solve_direct(m: FoldMoments, penalties: list[float]) -> Iterator[np.ndarray]:
    for penalty in penalties:
        yield np.linalg.solve(m.gram + penalty * np.eye(len(m.gram)), m.targets)


def _solve_eigh(m: FoldMoments, penalties: list[float]) -> Iterator[np.ndarray]:
    values, vectors = np.linalg.eigh(m.gram)
    values = np.maximum(values, 0.0)  # a Gram matrix has no negative ones but for rounding
    turned = vectors.T @ m.targets
    for penalty in penalties:
        yield vectors @ (turned / (values + penalty)[:, None])


def solve_ridge(
    moments: DataFrame,
    folds: list[Fold],
    lambdas: list[float],
    classes: list[int],
    center: str = "all",
    reg_scale: str = "none",
    solver: str = "direct",
) -> DataFrame:
    """Weights (fold, lambda_id, lambda, label, weights, centre).

    ``solver="direct"`` solves each lambda in a task of its own; ``"eigh"`` decomposes a fold's
    Gram matrix once and reuses it for all its lambdas. ``reg_scale="n"`` multiplies lambda by the
    number of rows of the fold. A score is ``weights . (x - centre)``.
    """
    if center not in ("all", "train", "none") or reg_scale not in ("none", "n"):
        raise ValueError(f"unknown center={center!r} or reg_scale={reg_scale!r}")
    solve = {"direct": _solve_direct, "eigh": _solve_eigh}[solver]
    spark = moments.sparkSession
    roles = [(s, f.fold, True) for f in folds for s in f.train]
    roles += [(s, f.fold, False) for f in folds for s in f.others]
    segments, owners, in_train = zip(*roles, strict=True)
    roles = spark.createDataFrame(
        pa.table(
            {
                "segment": pa.array(segments, pa.int32()),
                "fold": pa.array(owners, pa.int32()),
                "in_train": pa.array(in_train),
            }
        )
    )
    needed = (F.col("kind") == "class") | F.col("in_train")
    rows = moments.join(roles, "segment").where(needed)
    if solver == "direct":
        rows = rows.select("*", F.explode(lambda_array(lambdas)).alias("_l"))
        rows = rows.select("*", "_l.lambda_id").drop("_l")
        keys, groups = ["fold", "lambda_id"], len(folds) * len(lambdas)
    else:
        keys, groups = ["fold"], len(folds)

    def fit(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = FoldMoments(batches, classes, center)
        ids = [key[1].as_py()] if len(key) == 2 else list(range(len(lambdas)))
        factor = m.n_all if reg_scale == "n" else 1.0
        solved = solve(m, [lambdas[i] * factor for i in ids])
        for i, weights in zip(ids, solved, strict=True):
            yield weight_rows(key[0].as_py(), i, lambdas[i], classes, weights.T[m.place], m.mean)

    # an explicit number of tasks: the input is small, the solves are not
    return rows.repartition(2 * groups, *keys).groupBy(*keys).applyInArrow(fit, SCHEMA)


def fit_in_place(
    rows: DataFrame,
    lambdas: list[float],
    classes: list[int],
    center: str = "all",
    reg_scale: str = "none",
    stable: bool = False,
) -> DataFrame:
    """Weights of many folds, each fitted in one task from its own rows; same columns as ``solve_ridge``.

    ``rows`` has (fold, in_train, label, features). The rows are shuffled by fold once and read batch by
    batch; no matrix leaves its task. For folds that are many and small beside the table, shards say.
    """

    def fit(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[bool, Partial] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = finite_matrix(batch.column("features"))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            trains = batch.column("in_train").to_numpy(zero_copy_only=False)
            for own in np.unique(trains).tolist():
                inside = trains == own
                if own not in parts:
                    parts[own] = Partial(x.shape[1], own, stable, budget=8 * x.shape[1] ** 2)
                parts[own].add(x[inside], y[inside], True)
                for _ in parts[own].multiply(0):
                    raise AssertionError("all panels are held")

        def sums() -> Iterator[pa.RecordBatch]:
            for own, partial in parts.items():
                for batch in partial.rows(0):
                    yield batch.append_column("in_train", pa.array([own] * batch.num_rows))

        m = FoldMoments(sums(), classes, center)
        factor = m.n_all if reg_scale == "n" else 1.0
        solved = _solve_eigh(m, [v * factor for v in lambdas])
        for i, weights in enumerate(solved):
            yield weight_rows(key[0].as_py(), i, lambdas[i], classes, weights.T[m.place], m.mean)

    return rows.groupBy("fold").applyInArrow(fit, SCHEMA)


def weight_rows(
    fold: int, index: int, value: float, classes: list[int], weights: np.ndarray, centre: np.ndarray
) -> pa.RecordBatch:
    """One row per class with its weights and the centre of the fold."""
    k = len(classes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([fold] * k, pa.int32()),
            pa.array([index] * k, pa.int32()),
            pa.array([value] * k, pa.float64()),
            pa.array(classes, pa.int32()),
            to_list_array(weights),
            to_list_array(np.broadcast_to(centre, (k, len(centre)))),
        ],
        schema=ARROW_SCHEMA,
    )


SUMS = "lambda_id int, lambda double, label int, n long, weights array<double>"


def _sum_batch(held: dict[tuple, list]) -> pa.RecordBatch:
    keys = list(held)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()),
            pa.array([k[1] for k in keys], pa.float64()),
            pa.array([k[2] for k in keys], pa.int32()),
            pa.array([held[k][0] for k in keys], pa.int64()),
            to_list_array(np.array([held[k][1] for k in keys])),
        ],
        names=["lambda_id", "lambda", "label", "n", "weights"],
    )


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole vectors added up by (lambda, label), as many keys at a time as the task's budget holds."""
    held: dict[tuple, list] = {}
    size = 0
    for batch in batches:
        names = zip(*[batch.column(x).to_pylist() for x in ("lambda_id", "lambda", "label")], strict=True)
        for key, vector in zip(names, to_matrix(batch.column("weights")), strict=True):
            if key in held:
                held[key][0] += 1
                held[key][1] += vector
                continue
            if held and size + vector.nbytes > TASK_BUDGET:
                yield _sum_batch(held)
                held, size = {}, 0
            held[key] = [1, vector.copy()]
            size += vector.nbytes
    if held:
        yield _sum_batch(held)


def _means(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, 0.0
    for batch in batches:
        if batch.num_rows:
            n += sum(batch.column("n").to_pylist())
            total = total + to_matrix(batch.column("weights")).sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array([x.as_py()], t) for x, t in zip(key, (pa.int32(), pa.float64(), pa.int32()), strict=True)]
        + [to_list_array((total / n)[None, :])],
        names=["lambda_id", "lambda", "label", "weights"],
    )


def average_weights(weights: DataFrame) -> DataFrame:
    """Unweighted mean of the folds' weights, per (lambda, label); vectors stay whole and are added up in the
    tasks that hold them before the rest is shuffled."""
    keys = ["lambda_id", "lambda", "label"]
    sums = weights.select(*keys, "weights").mapInArrow(_partial_sums, SUMS)
    return sums.groupBy(*keys).applyInArrow(_means, "lambda_id int, lambda double, label int, weights array<double>")


def ridge_diagonal(gram: DataFrame, lambdas: list[float]) -> DataFrame:
    """G + lambda I for every lambda, in cells (lambda_id, i, j, v)."""
    rows = gram.select("i", "j", "v", F.inline(lambda_array(lambdas)))
    added = F.when(F.col("i") == F.col("j"), F.col("lambda")).otherwise(0.0)
    return rows.select("lambda_id", "lambda", "i", "j", (F.col("v") + added).alias("v"))


def lambda_class_grid(df: DataFrame, lambdas: list[float], label: str = "label") -> DataFrame:
    """Every lambda for every class that occurs: (lambda_id, lambda, label)."""
    return df.select(label).distinct().select(F.inline(lambda_array(lambdas)), label)
