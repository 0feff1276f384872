"""Score rows with weight vectors, decide classes, measure accuracy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import to_list_array, to_matrix
from ridgeworks.functions.vectors import hit
from ridgeworks.operators.solve import Fold, distinct_columns
from ridgeworks.session import checkpoint

# bytes of weights shipped to the executors at a time; larger sets are scored in several passes
BROADCAST_BUDGET = 256 * 1024 * 1024
# bytes of scores a task computes at a time
SCORE_BYTES = 32 * 1024 * 1024

PREDICTIONS = "fold int, lambda_id int, row_id long, label int, prediction int, score double"
HITS = "fold int, lambda_id int, hits long, rows long"
SCORES = "fold int, lambda_id int, row_id long, label int, scores array<double>"


@dataclass
class Block:
    """Weights of some lambdas and classes as one matrix, with one score offset per fold."""

    lambda_ids: np.ndarray  # (L,)
    labels: np.ndarray  # (K,) ascending
    weights: np.ndarray  # (d, different columns)
    place: np.ndarray  # (L * K,) column of each (lambda, class)
    offsets: dict[int, np.ndarray]  # fold -> (L * K,)

    def scores(self, x: np.ndarray, fold: int) -> np.ndarray:
        flat = (x @ self.weights)[:, self.place] - self.offsets[fold]
        return flat.reshape(len(x), len(self.lambda_ids), len(self.labels))


def _centre_scores(centres: DataFrame, weights: np.ndarray) -> dict[int, np.ndarray]:
    """fold -> score of its centre under every weight vector, taken where the centres are."""
    shared = centres.sparkSession.sparkContext.broadcast(weights.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                offsets = to_list_array(to_matrix(batch.column("centre")) @ shared.value)
                yield pa.RecordBatch.from_arrays([batch.column("fold"), offsets], ["fold", "offsets"])

    table = centres.select("fold", "centre").mapInArrow(run, "fold int, offsets array<double>").toArrow()
    if table.num_rows == 0:
        return {}
    offsets = to_matrix(table.column("offsets").combine_chunks())
    return dict(zip(table.column("fold").to_pylist(), offsets, strict=True))


def _blocks(table: pa.Table, centres: DataFrame | None) -> list[Block]:
    """Weight rows to blocks: one per fold, or a single shared one when centres come apart."""
    if table.num_rows == 0:
        return []
    columns = ["fold", "lambda_id", "label"] if centres is None else ["lambda_id", "label"]
    table = table.sort_by([(c, "ascending") for c in columns]).combine_chunks()
    weights = to_matrix(table.column("weights").combine_chunks())
    ids = table.column("lambda_id").to_numpy()
    labels = table.column("label").to_numpy()
    if centres is None:
        folds = table.column("fold").to_numpy()
        centre = to_matrix(table.column("centre").combine_chunks())
        offset = np.einsum("ij,ij->i", weights, centre)
        sets = [(folds == f, {int(f): offset[folds == f]}) for f in np.unique(folds)]
    else:
        sets = [(np.ones(len(ids), bool), _centre_scores(centres, weights))]
    blocks = []
    for own, offsets in sets:
        lambda_ids, classes = np.unique(ids[own]), np.unique(labels[own])
        if own.sum() != len(lambda_ids) * len(classes):
            raise ValueError("weights are missing for some (lambda, class)")
        different, place = distinct_columns(weights[own].T)
        blocks.append(Block(lambda_ids, classes, different, np.array(place), offsets))
    return blocks


def _passes(lambda_ids: list[int], classes: list[int], bytes_each: int, budget: int):
    """(lambda_ids, classes) per pass; classes are split only if one lambda alone is too large."""
    fits = max(1, budget // max(1, bytes_each))
    if fits >= len(classes):
        step = fits // len(classes)
        return [(lambda_ids[i : i + step], classes) for i in range(0, len(lambda_ids), step)]
    return [
        ([one], classes[k : k + fits]) for one in lambda_ids for k in range(0, len(classes), fits)
    ]


def _routes(blocks: list[Block], folds: list[Fold] | None) -> dict[int, list[tuple[int, int]]]:
    """segment -> [(block, fold)] to score its rows with."""
    routes: dict[int, list[tuple[int, int]]] = {}
    scored = {f.fold: f.validation for f in folds or []}
    for place, block in enumerate(blocks):
        for fold in block.offsets:
            for segment in scored.get(fold, ()) if folds is not None else (0,):
                routes.setdefault(segment, []).append((place, fold))
    return routes


def _scored(shared, emit):
    """Task function: matrix product per Arrow batch, then ``emit`` builds the output rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, routes = shared.value
        blocks = [Block(*fields) for fields in plain]

        def chunks():
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                x = to_matrix(batch.column("features"))
                y = batch.column("label").to_numpy(zero_copy_only=False)
                ids = batch.column("row_id").to_numpy(zero_copy_only=False)
                place = batch.column("segment").to_numpy(zero_copy_only=False)
                for segment in np.unique(place):
                    inside = place == segment
                    rows, own, keys = (x, y, ids) if inside.all() else (x[inside], y[inside], ids[inside])
                    for index, fold in routes.get(int(segment), []):
                        block = blocks[index]
                        step = max(1, SCORE_BYTES // (8 * len(block.place)))
                        for at in range(0, len(rows), step):
                            part = slice(at, at + step)
                            yield block, fold, block.scores(rows[part], fold), own[part], keys[part]

        yield from emit(chunks())

    return run


def _emit_predictions(chunks):
    for block, fold, scores, y, ids in chunks:
        best = scores.argmax(axis=2)
        for place, lambda_id in enumerate(block.lambda_ids):
            pick = best[:, place]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(y), fold, np.int32)),
                    pa.array(np.full(len(y), lambda_id, np.int32)),
                    pa.array(ids),
                    pa.array(y.astype(np.int32)),
                    pa.array(block.labels[pick].astype(np.int32)),
                    pa.array(scores[np.arange(len(y)), place, pick]),
                ],
                names=["fold", "lambda_id", "row_id", "label", "prediction", "score"],
            )


def _emit_hits(chunks):
    held: dict[tuple[int, int], list[int]] = {}
    for block, fold, scores, y, _ in chunks:
        right = (block.labels[scores.argmax(axis=2)] == y[:, None]).sum(axis=0)
        for lambda_id, hits in zip(block.lambda_ids, right, strict=True):
            total = held.setdefault((fold, int(lambda_id)), [0, 0])
            total[0] += int(hits)
            total[1] += len(y)
    keys = list(held)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([held[k][0] for k in keys], pa.int64()),
            pa.array([held[k][1] for k in keys], pa.int64()),
        ],
        names=["fold", "lambda_id", "hits", "rows"],
    )


def _emit_scores(chunks):
    for block, fold, scores, y, ids in chunks:
        for place, lambda_id in enumerate(block.lambda_ids):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(y), fold, np.int32)),
                    pa.array(np.full(len(y), lambda_id, np.int32)),
                    pa.array(ids),
                    pa.array(y.astype(np.int32)),
                    to_list_array(scores[:, place, :]),
                ],
                names=["fold", "lambda_id", "row_id", "label", "scores"],
            )


class Scorer:
    """Rows to score and weights to score them with; each method gives one lazy result.

    ``weights`` has (fold, lambda_id, label, weights, centre), or (lambda_id, label, weights) when
    ``centres`` is a table of every fold's mean (fold, centre). ``width`` and the lists bound what is read to
    the driver: weights, and one number per fold for each, come in passes of at most ``budget`` bytes, each
    broadcast once.
    """

    def __init__(
        self,
        df: DataFrame,
        weights: DataFrame,
        lambda_ids: list[int],
        classes: list[int],
        width: int,
        folds: list[Fold] | None = None,
        segment: Column | None = None,
        centres: DataFrame | None = None,
        features: str = "features",
        label: str | None = "label",
        row_id: str = "row_id",
        budget: int = BROADCAST_BUDGET,
    ):
        self.context = df.sparkSession.sparkContext
        self.df, self.row_id = df, row_id
        # predictions and scores keep the type of the row id, a file path as well as a number
        self.id_type = df.select(row_id).schema[0].dataType.simpleString()
        self.columns = [
            F.col(features).alias("features"),
            (F.col(label) if label else F.lit(-1)).cast("int").alias("label"),
            (F.lit(0) if segment is None else segment).cast("int").alias("segment"),
        ]
        self.folds, self.centres = folds, centres
        copies = 1 if centres is not None or folds is None else len(folds)
        each = copies * width * 16 + 16 * len(folds or [0])
        self.passes = _passes(list(lambda_ids), list(classes), each, budget)
        self.split_classes = any(len(c) < len(classes) for _, c in self.passes)
        self.weights = weights if len(self.passes) == 1 else checkpoint(weights)

    def _parts(self, emit, schema: str, row_id: Column) -> DataFrame:
        return reduce(DataFrame.unionAll, self._pass_parts(emit, schema, row_id))

    def _pass_parts(self, emit, schema: str, row_id: Column) -> list[DataFrame]:
        """The result of every pass."""
        rows = self.df.select(*self.columns, row_id.alias("row_id"))
        parts = []
        for lambda_ids, classes in self.passes:
            chosen = self.weights
            if len(self.passes) > 1:
                chosen = chosen.where(
                    F.col("lambda_id").between(lambda_ids[0], lambda_ids[-1])
                    & F.col("label").between(classes[0], classes[-1])
                )
            blocks = _blocks(chosen.toArrow(), self.centres)
            plain = [(b.lambda_ids, b.labels, b.weights, b.place, b.offsets) for b in blocks]
            shared = self.context.broadcast((plain, _routes(blocks, self.folds)))
            parts.append(rows.mapInArrow(_scored(shared, emit), schema))
        return parts

    def _typed(self, schema: str) -> str:
        return schema.replace("row_id long", f"row_id {self.id_type}")

    def predictions(self) -> DataFrame:
        """(fold, lambda_id, row_id, label, prediction, score); ties go to the lowest class."""
        rows = self._parts(_emit_predictions, self._typed(PREDICTIONS), F.col(self.row_id))
        if not self.split_classes:
            return rows
        best = F.max(F.struct("score", (-F.col("prediction")).alias("_class")))
        merged = rows.groupBy("fold", "lambda_id", "row_id", "label").agg(best.alias("_best"))
        return merged.select(
            "fold", "lambda_id", "row_id", "label",
            (-F.col("_best._class")).alias("prediction"), F.col("_best.score").alias("score"),
        )

    def hits(self) -> DataFrame:
        """(fold, lambda_id, hits, rows), added up inside the tasks first."""
        if self.split_classes:
            rows = self.predictions().withColumn("_hit", hit(F.col("label"), F.col("prediction")))
            totals = [F.sum("_hit").alias("hits"), F.count("*").alias("rows")]
        else:
            rows = self._parts(_emit_hits, HITS, F.lit(0))
            totals = [F.sum("hits").alias("hits"), F.sum("rows").alias("rows")]
        return rows.groupBy("fold", "lambda_id").agg(*totals)

    def scores(self) -> DataFrame:
        """(fold, lambda_id, row_id, label, scores) with scores in class order.

        Classes that do not fit one pass are scored in several and put together by row, for which row ids
        must be different.
        """
        if not self.split_classes:
            return self._parts(_emit_scores, self._typed(SCORES), F.col(self.row_id))
        parts = self._pass_parts(_emit_scores, self._typed(SCORES), F.col(self.row_id))
        numbered = [part.withColumn("_pass", F.lit(number)) for number, part in enumerate(parts)]
        ordered = F.array_sort(F.collect_list(F.struct("_pass", "scores")))
        keys = ["fold", "lambda_id", "row_id", "label"]
        whole = reduce(DataFrame.unionAll, numbered).groupBy(*keys).agg(ordered.alias("_parts"))
        once = F.size(F.array_distinct("_parts._pass")) == F.size("_parts")
        scores = F.when(once, F.flatten("_parts.scores")).otherwise(F.raise_error(F.lit("row ids are not unique")))
        return whole.select(*keys, scores.alias("scores"))


def scorer(df: DataFrame, weights: DataFrame, **columns) -> Scorer:
    """Scorer for stored weights: (label, weights) with optional fold, lambda_id and centre."""
    for name, value in (("fold", F.lit(0)), ("lambda_id", F.lit(0))):
        if name not in weights.columns:
            weights = weights.withColumn(name, value)
    if "centre" not in weights.columns:
        weights = weights.withColumn("centre", F.transform("weights", lambda w: F.lit(0.0)))
    weights = checkpoint(weights.select("fold", "lambda_id", "label", "weights", "centre"))
    width = weights.agg(F.max(F.size("weights"))).first()[0]
    lambda_ids = [r[0] for r in weights.select("lambda_id").distinct().orderBy("lambda_id").collect()]
    classes = [r[0] for r in weights.select("label").distinct().orderBy("label").collect()]
    folds = [r[0] for r in weights.select("fold").distinct().orderBy("fold").collect()]
    every = [Fold(f, (), (), (0,)) for f in folds]
    return Scorer(df, weights, lambda_ids, classes, width, folds=every, **columns)


def predict(df: DataFrame, weights: DataFrame, **columns) -> DataFrame:
    """Class of every row under stored weights."""
    return scorer(df, weights, **columns).predictions()


def linear_scores(df: DataFrame, weights: DataFrame, **columns) -> DataFrame:
    """All class scores of every row under stored weights, in class order."""
    return scorer(df, weights, **columns).scores()


def evaluate(predictions: DataFrame, *keys: str) -> DataFrame:
    """Accuracy per key (or overall): the share of rows whose prediction is their label."""
    right = F.sum(hit(F.col("label"), F.col("prediction")))
    totals = predictions.groupBy(*keys).agg(right.alias("hits"), F.count("*").alias("rows"))
    return totals.withColumn("accuracy", F.try_divide(F.col("hits"), F.col("rows")))


def scores_by_class(scores: DataFrame, row_id: str = "row_id", label: str = "label", score: str = "score"):
    """Long (row, class, score) rows to one score array per row, in ascending class order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(label).alias("k"), F.col(score).alias("s"))))
    return scores.groupBy(row_id).agg(ordered.alias("_c")).select(row_id, F.col("_c.s").alias("scores"))


def best_lambda(sweep: DataFrame, *keys: str) -> DataFrame:
    """The row with the highest accuracy, overall or per key; on a tie the first lambda of the grid."""
    if not keys:
        return sweep.orderBy(F.desc("accuracy"), F.asc("lambda_id")).limit(1)
    order = F.struct("accuracy", (-F.col("lambda_id")).alias("_first"), "lambda")
    best = sweep.groupBy(*keys).agg(F.max(order).alias("_best"))
    return best.select(
        *keys, (-F.col("_best._first")).alias("lambda_id"), "_best.lambda", "_best.accuracy"
    )
