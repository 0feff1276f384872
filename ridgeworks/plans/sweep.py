"""Lambda sweeps: one pass for the moments, one solve per lambda, one pass to score."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.vectors import lambda_array, log_spaced
from ridgeworks.operators.indexing import shard_bounds, shard_of
from ridgeworks.operators.moments import TASK_BUDGET, class_moments, feature_width, known_label
from ridgeworks.operators.score import Scorer
from ridgeworks.operators.solve import DENSE_LIMIT, Fold, average_weights, fit_in_place, solve_ridge
from ridgeworks.operators.splits import TRAIN_SHARE, Split, dense_row_count, hash_split, positional_split
from ridgeworks.operators.wide import solve_wide
from ridgeworks.session import checkpoint, stored

# fixed values: default row counts of a size sweep
SIZES = list(range(1000, 60000, 10000))


@dataclass(frozen=True)
class Columns:
    """Names of the input columns."""

    row_id: str = "row_id"
    label: str = "label"
    features: str = "features"


def distinct_labels(df: DataFrame, label: str = "label") -> list[int]:
    """Classes that occur, ascending; reads the label column only."""
    return sorted(row[0] for row in df.select(label).distinct().collect())


def make_split(
    df: DataFrame, kind: str, columns: Columns, train_frac: float, drop_last: bool, seed: int
) -> Split:
    if kind == "positional":
        return positional_split(df, columns.row_id, train_frac, drop_last)
    if kind == "hash":
        return hash_split(df, columns.row_id, train_frac, drop_last, seed)
    raise ValueError(f"unknown split {kind!r}")


class RidgeFit:
    """Moments of every fold's rows, taken once; weights, predictions and accuracies follow."""

    def __init__(
        self,
        df: DataFrame,
        folds: list[Fold],
        segment: Column,
        lambdas: list[float] | None = None,
        center: str = "all",
        reg_scale: str = "none",
        classes: list[int] | None = None,
        solver: str = "auto",
        columns: Columns = Columns(),
        validation: Column | None = None,
        stable: bool = False,
        clustered: bool = False,
        shard: Column | None = None,
        trains: Column | None = None,
    ):
        """``validation`` narrows the rows that are scored, so that the scan can skip the others.

        ``stable`` takes squares about the mean of the rows at hand and merges them pairwise: for vectors
        whose mean is large beside their spread. ``clustered`` says that the files hold the rows in row_id
        order already. ``shard`` is the fold of a row and ``trains`` whether it trains, where no two folds
        share rows: if the matrices of all folds exceed what a task can hold, every fold is then fitted
        where its rows are.
        """
        self.df, self.folds, self.segment, self.columns = df, folds, segment, columns
        self.lambdas = log_spaced() if lambdas is None else [float(v) for v in lambdas]
        self.width = feature_width(df, columns.features)
        self.center, self.reg_scale = center, reg_scale
        self.validation = validation
        if solver == "auto":
            # one fold spreads its lambdas over tasks, several folds are parallel already
            solver = "direct" if len(folds) == 1 else "eigh"
            solver = solver if self.width <= DENSE_LIMIT else "wide"
        self.solver = solver
        training = {s for f in folds for s in f.train}
        rows = df
        many = len(training) > 1 and len(training) * self.width**2 * 8 > TASK_BUDGET and not clustered
        self.stable, self.moments, self.own_rows = stable, None, None
        if many and shard is not None and solver != "wide":
            self.own_rows = df.select(
                shard.cast("int").alias("fold"),
                trains.alias("in_train"),
                known_label(F.col(columns.label)).alias("label"),
                F.col(columns.features).alias("features"),
            )
            self.classes = sorted(distinct_labels(df, columns.label) if classes is None else classes)
            return
        if many:
            # more Gram matrices than a task can hold: give each task neighbouring rows
            rows = df.repartitionByRange(4 * len(training), columns.row_id)
        self.moments = checkpoint(
            class_moments(
                rows,
                columns.features,
                columns.label,
                segment,
                gram_segments=training,
                stable=stable,
                # a merging task holds 32 MB
                partitions=max(8, self.width**2 // 2**23) if solver == "wide" else None,
            )
        )
        if classes is None:
            classes = distinct_labels(self.moments.where("kind = 'class'"), "key")
        self.classes = sorted(classes)

    def weights(self) -> DataFrame:
        """(fold, lambda_id, lambda, label, weights, centre)."""
        if self.own_rows is not None:
            options = self.center, self.reg_scale, self.stable
            return fit_in_place(self.own_rows, self.lambdas, self.classes, *options)
        solve = solve_wide if self.solver == "wide" else solve_ridge
        more = {} if self.solver == "wide" else {"solver": self.solver}
        return solve(
            self.moments,
            self.folds,
            self.lambdas,
            self.classes,
            self.center,
            self.reg_scale,
            **more,
        )

    def scorer(self, average: bool = False) -> Scorer:
        weights, centres = self.weights(), None
        if average:
            weights = stored(weights, "fold-weights")
            first = weights.where((F.col("lambda_id") == 0) & (F.col("label") == self.classes[0]))
            centres = first.select("fold", "centre")
            weights = stored(average_weights(weights), "mean-weights")
        rows = self.df if self.validation is None else self.df.where(self.validation)
        return Scorer(
            rows,
            weights,
            list(range(len(self.lambdas))),
            self.classes,
            self.width,
            folds=self.folds,
            segment=self.segment,
            centres=centres,
            features=self.columns.features,
            label=self.columns.label,
            row_id=self.columns.row_id,
        )

    def accuracies(self, average: bool = False) -> DataFrame:
        """(fold, lambda_id, lambda, hits, rows, accuracy); null accuracy without validation rows."""
        hits = self.scorer(average).hits()
        spark = self.df.sparkSession
        grid = spark.createDataFrame(pa.table({"fold": pa.array([f.fold for f in self.folds], pa.int32())}))
        grid = grid.select("fold", F.inline(lambda_array(self.lambdas)))
        joined = grid.join(hits, ["fold", "lambda_id"], "left")
        return joined.withColumn("accuracy", F.try_divide(F.col("hits"), F.col("rows")))


def fit_single(
    df: DataFrame,
    split: str = "positional",
    train_frac: float = TRAIN_SHARE,
    drop_last: bool = False,
    seed: int = 0,
    columns: Columns = Columns(),
    **options,
) -> RidgeFit:
    """One fold over all rows."""
    parts = make_split(df, split, columns, train_frac, drop_last, seed)
    segment = F.when(parts.train, 0).when(parts.validation, 1).otherwise(2)
    fold = Fold(0, train=(0,), others=(1, 2), validation=(1,))
    return RidgeFit(df, [fold], segment, columns=columns, validation=parts.validation, **options)


def ridge_sweep(df: DataFrame, **options) -> DataFrame:
    """Validation accuracy of every lambda: (lambda_id, lambda, accuracy).

    Options: lambdas, split ("positional" or "hash"), train_frac, drop_last, seed, center ("all",
    "train", "none"), reg_scale ("none" or "n"), classes, solver, stable, columns.
    """
    return fit_single(df, **options).accuracies().select("lambda_id", "lambda", "accuracy")


def ridge_weights(df: DataFrame, **options) -> DataFrame:
    """Weights of every (lambda, class): (lambda_id, lambda, label, weights, centre)."""
    return fit_single(df, **options).weights().drop("fold")


def fit_shards(
    df: DataFrame,
    shards: int,
    train_frac: float = TRAIN_SHARE,
    drop_last: bool = False,
    columns: Columns = Columns(),
    **options,
) -> RidgeFit:
    """One fold per contiguous shard of rows, each with its own split and mean."""
    n = dense_row_count(df, columns.row_id)
    row = F.col(columns.row_id)
    small, extra = divmod(n, shards)
    shard = shard_of(row, n, shards)
    inside = row - (shard * small + F.least(shard, F.lit(extra)))
    # only two shard sizes occur
    cut = F.when(shard < extra, int(train_frac * (small + 1))).otherwise(int(train_frac * small))
    end = F.when(shard < extra, small + 1).otherwise(small) - int(drop_last)
    part = F.when(inside < cut, 0).when(inside < end, 1).otherwise(2)
    folds = [
        Fold(s, train=(3 * s,), others=(3 * s + 1, 3 * s + 2), validation=(3 * s + 1,))
        for s, (start, stop) in enumerate(shard_bounds(n, shards))
        if stop > start
    ]
    validation = (inside >= cut) & (inside < end)
    own = dict(shard=shard, trains=part == 0, validation=validation)
    return RidgeFit(df, folds, shard * 3 + part, columns=columns, **own, **options)


def shard_accuracies(df: DataFrame, shards: int, **options) -> DataFrame:
    """Accuracy of the averaged weights on every shard's own validation rows."""
    return fit_shards(df, shards, **options).accuracies(average=True).withColumnRenamed("fold", "shard")


def mean_shard_accuracy(
    accuracies: DataFrame, keys: tuple[str, ...] = ("lambda_id", "lambda")
) -> DataFrame:
    """Unweighted mean over shards, per lambda or other keys; shards without an accuracy do not count."""
    return accuracies.groupBy(*keys).agg(F.avg("accuracy").alias("accuracy"))


def ridge_sweep_sharded(df: DataFrame, shards: int, **options) -> DataFrame:
    """Fit every shard, average the weights, average the shards' accuracies."""
    return mean_shard_accuracy(shard_accuracies(df, shards, **options))


def size_sweep(
    df: DataFrame,
    sizes: list[int] | None = None,
    train_frac: float = TRAIN_SHARE,
    drop_last: bool = False,
    columns: Columns = Columns(),
    **options,
) -> DataFrame:
    """The sweep on the first N rows for every N: (n, lambda_id, lambda, accuracy).

    All sizes share one pass for the moments and one to score: rows are cut at every size's
    borders, and the sums of a size are the sums of the pieces below its border. Without sizes:
    1 000, 11 000, ... 51 000 as far as there are rows; with none of them the result is empty.

    All sizes have the same classes, those of the largest: a class that the first rows lack is one with
    targets of -1 everywhere there. ``classes`` sets them.
    """
    row = F.col(columns.row_id)
    n = dense_row_count(df, columns.row_id)
    sizes = [size for size in SIZES if size <= n] if sizes is None else sizes
    if not sizes:
        return df.sparkSession.createDataFrame([], "n long, lambda_id int, lambda double, accuracy double")
    ends = {n: (int(train_frac * n), n - int(drop_last), n) for n in sorted(set(sizes))}
    borders = sorted({b for three in ends.values() for b in three})
    places = {b: i for i, b in enumerate([0, *borders])}
    segment = F.lit(None)
    for border in reversed(borders):
        segment = F.when(row < border, places[border] - 1).otherwise(segment)
    folds = []
    for fold, (cut, end, last) in enumerate(ends.values()):
        a, b, c = places[cut], places[max(cut, end)], places[last]
        folds.append(Fold(fold, tuple(range(a)), tuple(range(a, c)), tuple(range(a, b))))
    chosen = df.where(row < max(sizes))
    validation = segment.isin(sorted({s for f in folds for s in f.validation}))
    fit = RidgeFit(chosen, folds, segment, columns=columns, validation=validation, **options)
    size = F.element_at(F.array(*[F.lit(n).cast("long") for n in ends]), F.col("fold") + 1)
    return fit.accuracies().select(size.alias("n"), "lambda_id", "lambda", "accuracy")
