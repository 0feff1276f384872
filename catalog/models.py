"""Weights, scores, accuracies and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import VECTORS, WHOLE_SQL, table, vectors, whole_vectors
from catalog.ridge_sql import accuracy_ctes, dual_accuracy_ctes, vector_rows, weights_ctes
from ridgeworks.functions.vectors import argmax_position
from ridgeworks.operators import score, solve, wide
from ridgeworks.operators.indexing import shard_bounds, shard_of
from ridgeworks.operators.matrix import union_results
from ridgeworks.operators.moments import class_sums
from ridgeworks.operators.splits import positional_split, row_count, split_rows
from ridgeworks.plans import sweep

SHARDS = 4
FAR = 1048576.0
ABSENT = 99
BY_VECTOR = {"features": "embedding", "row_id": "vec_id"}


def _rounded(sweep_rows, *keys):
    return sweep_rows.select(*keys, "lambda_id", F.round("accuracy", 6).alias("accuracy"))


def _class_sum_weights(rows):
    """X^T Y of the training rows as weight vectors."""
    train, validation = split_rows(rows, positional_split(rows, "vec_id"))
    cells = class_sums(train, "embedding").withColumn("pos", F.col("pos").cast("int"))
    packed = F.array_sort(F.collect_list(F.struct("pos", "v")))
    weights = cells.groupBy("label").agg(packed.alias("c")).select("label", F.col("c.v").alias("weights"))
    return weights, validation


def score_class_sums(spark, folder):
    weights, validation = _class_sum_weights(whole_vectors(spark, folder))
    result = score.evaluate(score.predict(validation, weights, **BY_VECTOR))
    return result.select("hits", "rows", F.round("accuracy", 6).alias("accuracy"))


def predict(spark, folder):
    weights, validation = _class_sum_weights(whole_vectors(spark, folder))
    rows = score.predict(validation, weights, **BY_VECTOR)
    return rows.select("row_id", "label", "prediction", F.col("score").cast("bigint").alias("score"))


def linear_score(spark, folder):
    weights, _ = _class_sum_weights(whole_vectors(spark, folder))
    rows = score.linear_scores(whole_vectors(spark, folder), weights, **BY_VECTOR)
    cells = rows.select("row_id", F.posexplode("scores").alias("class_place", "score"))
    return cells.withColumn("score", F.col("score").cast("bigint"))


def scores_by_class(spark, folder):
    """Class scores arrive as rows (row, class, score) and leave as one ordered vector per row."""
    rows = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").alias("s")
    )
    ordered = score.scores_by_class(rows, "l_orderkey", "l_linenumber", "s")
    return ordered.select("l_orderkey", F.posexplode("scores").alias("pos", "score"))


def _guesses(spark, folder):
    """Predictions of a fixed rule: the largest element."""
    guess = argmax_position(F.col("embedding"))
    return vectors(spark, folder).select("vec_id", "label", guess.alias("prediction"))


def accuracy(spark, folder):
    result = score.evaluate(_guesses(spark, folder), "label")
    return result.select("label", "hits", "rows", F.round("accuracy", 6).alias("accuracy"))


def _sharded_guesses(spark, folder):
    rows = _guesses(spark, folder)
    return rows.withColumn("shard", shard_of(F.col("vec_id"), row_count(rows), SHARDS))


def mean_shard_accuracy(spark, folder):
    parts = score.evaluate(_sharded_guesses(spark, folder), "shard")
    return sweep.mean_shard_accuracy(parts, keys=()).select(F.round("accuracy", 6).alias("accuracy"))


def gathered(spark, folder):
    """Each shard's result built apart from its own range of rows, then put together."""
    rows = _guesses(spark, folder)
    row, parts = F.col("vec_id"), []
    for shard, (start, end) in enumerate(shard_bounds(row_count(rows), SHARDS)):
        own = rows.where((row >= start) & (row < end)).withColumn("shard", F.lit(shard))
        parts.append(score.evaluate(own, "shard"))
    return union_results(*parts).select("shard", "hits", "rows")


def ridge_weights_2f(spark, folder):
    """Two features of every line item against its return flag, one lambda, no centring."""
    features = F.array("l_quantity", F.round(F.col("l_discount") * 100))
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    rows = table(spark, folder, "lineitem").select(features.alias("features"), label.alias("label"))
    fit = sweep.RidgeFit(rows, [solve.Fold(0, (0,))], F.lit(0), [1.0], center="none")
    cells = fit.weights().select("label", F.posexplode("weights").alias("pos", "w"))
    return cells.withColumn("w", F.round("w", 9))


def ridge_weights(spark, folder):
    weights = sweep.ridge_weights(vectors(spark, folder), columns=VECTORS)
    cells = weights.select("lambda_id", "label", F.posexplode("weights").alias("pos", "w"))
    return cells.withColumn("w", F.round("w", 6))


def ridge_weights_eigh(spark, folder):
    weights = sweep.ridge_weights(vectors(spark, folder), columns=VECTORS, solver="eigh")
    cells = weights.select("lambda_id", "label", F.posexplode("weights").alias("pos", "w"))
    return cells.withColumn("w", F.round("w", 6))


def _weight_cells(weights, digits=6):
    cells = weights.select("lambda_id", "label", F.posexplode("weights").alias("pos", "w"))
    return cells.withColumn("w", F.round("w", digits))


def ridge_weights_wide(spark, folder):
    """By the blocked factorisation, in four blocks of the features."""
    fit = sweep.fit_single(vectors(spark, folder), columns=VECTORS, solver="wide")
    return _weight_cells(wide.solve_wide(fit.moments, fit.folds, fit.lambdas, fit.classes, tile=16))


def ridge_weights_stable(spark, folder):
    """Features a million from zero, in one scan."""
    far = F.transform("embedding", lambda x: x.cast("double") + FAR)
    rows = vectors(spark, folder).withColumn("embedding", far)
    return _weight_cells(sweep.ridge_weights(rows, columns=VECTORS, stable=True), 4)


def ridge_weights_train(spark, folder):
    """Centred by the training rows alone."""
    return _weight_cells(sweep.ridge_weights(vectors(spark, folder), columns=VECTORS, center="train"))


def ridge_weights_absent(spark, folder):
    """With a class that no row has: its targets are -1 everywhere."""
    rows = vectors(spark, folder)
    classes = [*sweep.distinct_labels(rows), ABSENT]
    weights = sweep.ridge_weights(rows, columns=VECTORS, classes=classes)
    return _weight_cells(weights.where(F.col("label") == ABSENT))


def average_weights(spark, folder):
    fit = sweep.fit_shards(vectors(spark, folder), SHARDS, columns=VECTORS)
    means = solve.average_weights(fit.weights())
    cells = means.select("lambda_id", "label", F.posexplode("weights").alias("pos", "w"))
    return cells.withColumn("w", F.round("w", 6))


def ridge_sweep(spark, folder):
    return _rounded(sweep.ridge_sweep(vectors(spark, folder), columns=VECTORS))


def ridge_sweep_drop_last(spark, folder):
    return _rounded(sweep.ridge_sweep(vectors(spark, folder), columns=VECTORS, drop_last=True))


def ridge_sweep_n(spark, folder):
    """Random split and a penalty of n times lambda."""
    rows = sweep.ridge_sweep(
        vectors(spark, folder), columns=VECTORS, split="hash", seed=7, reg_scale="n", drop_last=True
    )
    return _rounded(rows)


def best_lambda(spark, folder):
    return _rounded(score.best_lambda(sweep.ridge_sweep(vectors(spark, folder), columns=VECTORS)))


def ridge_sweep_sharded(spark, folder):
    return _rounded(sweep.ridge_sweep_sharded(vectors(spark, folder), SHARDS, columns=VECTORS))


def ridge_sweep_sharded_drop(spark, folder):
    """Each shard's last row is left out of its validation rows."""
    rows = vectors(spark, folder)
    return _rounded(sweep.ridge_sweep_sharded(rows, SHARDS, columns=VECTORS, drop_last=True))


def size_sweep(spark, folder):
    rows = vectors(spark, folder)
    n = row_count(rows)
    sizes = [n // 5, 3 * n // 5, n]
    return _rounded(sweep.size_sweep(rows, sizes, columns=VECTORS), "n")


def best_by_size(spark, folder):
    rows = vectors(spark, folder)
    n = row_count(rows)
    return _rounded(score.best_lambda(sweep.size_sweep(rows, [n // 2, n], columns=VECTORS), "n"), "n")


def ridge_sweep_orders(spark, folder):
    """Every order: four numbers against the priority class."""
    price, day = F.col("o_totalprice") / 100000, F.col("o_orderdate")
    features = F.array(price, F.month(day) / 6, F.dayofmonth(day) / 15, price * F.month(day) / 6)
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").substr(1, 1).cast("int").alias("label"),
        features.alias("features"),
    )
    return _rounded(sweep.ridge_sweep(rows))


def images_28(spark, folder):
    """A 28 x 28 image per embedding: products of sums of its first and last elements and those between."""
    e = F.col("embedding").cast("array<double>")
    ends = F.zip_with(F.slice(e, 1, 28), F.slice(e, 37, 28), lambda a, b: a + b)
    pixels = F.flatten(F.transform(ends, lambda a: F.transform(F.slice(e, 19, 28), lambda b: a * b)))
    return vectors(spark, folder).select(F.col("vec_id").alias("row_id"), "label", pixels.alias("features"))


def ridge_sweep_images(spark, folder):
    """784 features per row."""
    return _rounded(sweep.ridge_sweep(images_28(spark, folder)))


QUERIES = {
    "score_class_sums": score_class_sums,
    "predict": predict,
    "linear_score": linear_score,
    "scores_by_class": scores_by_class,
    "accuracy": accuracy,
    "mean_shard_accuracy": mean_shard_accuracy,
    "union_results": gathered,
    "ridge_weights_2f": ridge_weights_2f,
    "ridge_weights": ridge_weights,
    "ridge_weights_eigh": ridge_weights_eigh,
    "ridge_weights_wide": ridge_weights_wide,
    "ridge_weights_stable": ridge_weights_stable,
    "ridge_weights_train": ridge_weights_train,
    "ridge_weights_absent": ridge_weights_absent,
    "average_weights": average_weights,
    "ridge_sweep": ridge_sweep,
    "ridge_sweep_drop_last": ridge_sweep_drop_last,
    "ridge_sweep_n": ridge_sweep_n,
    "best_lambda": best_lambda,
    "ridge_sweep_sharded": ridge_sweep_sharded,
    "ridge_sweep_sharded_drop": ridge_sweep_sharded_drop,
    "size_sweep": size_sweep,
    "best_by_size": best_by_size,
    "ridge_sweep_orders": ridge_sweep_orders,
    "ridge_sweep_images": ridge_sweep_images,
}

POSITIONAL = "CASE WHEN vec_id < 4 * n // 5 THEN 'train' ELSE 'validation' END"
POSITIONAL_DROP = (
    "CASE WHEN vec_id < 4 * n // 5 THEN 'train' WHEN vec_id < n - 1 THEN 'validation' ELSE 'rest' END"
)
SINGLE = vector_rows("0", POSITIONAL)
FAR_ROWS = SINGLE.replace("AS DOUBLE) AS x", f"AS DOUBLE) + {FAR} AS x")
DROPPED = vector_rows("0", POSITIONAL_DROP)
HASHED = vector_rows(
    "0",
    "CASE WHEN place <= 4 * n // 5 THEN 'train' WHEN place < n THEN 'validation' ELSE 'rest' END",
    "(SELECT *, row_number() OVER (ORDER BY md5('7:' || vec_id)) AS place FROM embeddings)",
)
SHARDED = vector_rows(
    "shard",
    "CASE WHEN inside <= 4 * size // 5 THEN 'train' ELSE 'validation' END",
    f"""(SELECT *, row_number() OVER (PARTITION BY shard ORDER BY vec_id) AS inside,
                count(*) OVER (PARTITION BY shard) AS size
         FROM (SELECT *, ntile({SHARDS}) OVER (ORDER BY vec_id) - 1 AS shard FROM embeddings))""",
)

SHARDED_DROP = SHARDED.replace(
    "ELSE 'validation' END", "WHEN inside < size THEN 'validation' ELSE 'rest' END"
)


def _sizes(sizes: str) -> str:
    return vector_rows(
        "size",
        "CASE WHEN vec_id < 4 * size // 5 THEN 'train' ELSE 'validation' END",
        f"""(SELECT e.*, size FROM embeddings e JOIN
             (SELECT unnest([{sizes}]) AS size FROM embeddings) ON vec_id < size)""",
    )


ORDER_ROWS = """
    SELECT 0 AS fold, CASE WHEN o_orderkey < 4 * n // 5 THEN 'train' ELSE 'validation' END AS part,
           o_orderkey AS row_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS label,
           generate_subscripts(f, 1) - 1 AS pos, unnest(f) AS x
    FROM (SELECT *, [o_totalprice / 100000, month(o_orderdate) / 6.0::DOUBLE, day(o_orderdate) / 15.0::DOUBLE,
                     o_totalprice / 100000 * month(o_orderdate) / 6] AS f FROM orders),
         (SELECT count(*) AS n FROM orders)"""
IMAGE_ROWS = f"""
    SELECT 0 AS fold, {POSITIONAL} AS part, vec_id AS row_id, label, r * 28 + c AS pos,
           (CAST(embedding[r + 1] AS DOUBLE) + CAST(embedding[r + 37] AS DOUBLE))
           * CAST(embedding[c + 19] AS DOUBLE) AS x
    FROM embeddings, (SELECT count(*) AS n FROM embeddings), range(0, 28) a(r), range(0, 28) b(c)"""
ACCURACY = "SELECT lambda_id, round(accuracy, 6) AS accuracy FROM acc"
WEIGHTS = "SELECT lambda_id, k AS label, CAST(pos AS INTEGER) AS pos, round(w, 6) + 0.0 AS w FROM w"
CLASS_SUMS = f"""
    WITH {WHOLE_SQL},
    n AS (SELECT count(*) AS n FROM embeddings),
    w AS (SELECT k, pos, sum(CASE WHEN label = k THEN q ELSE -q END) AS w
          FROM x, n, (SELECT DISTINCT label AS k FROM embeddings) WHERE vec_id < 4 * n // 5 GROUP BY k, pos),
    s AS (SELECT vec_id, label, k, CAST(sum(q * w) AS BIGINT) AS score
          FROM x JOIN w USING (pos) GROUP BY vec_id, label, k),
    p AS (SELECT s.*, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, k) AS place FROM s, n
          WHERE vec_id >= 4 * n // 5)"""
GUESSES = """
    WITH s AS (SELECT vec_id, label, k, embedding[k + 1] AS score FROM embeddings, range(0, 64) t(k)),
         r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, k) AS place FROM s),
         guesses AS (SELECT vec_id, label, CASE WHEN k = label THEN 1 ELSE 0 END AS hit FROM r WHERE place = 1)"""
SHARDED_GUESSES = f"""{GUESSES},
    sharded AS (SELECT *, CAST(ntile({SHARDS}) OVER (ORDER BY vec_id) - 1 AS INTEGER) AS shard FROM guesses)"""

ORACLES = {
    "score_class_sums": f"""{CLASS_SUMS}
        SELECT CAST(sum(CASE WHEN k = label THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(*) AS rows,
               round(avg(CASE WHEN k = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
        FROM p WHERE place = 1""",
    "predict": f"""{CLASS_SUMS}
        SELECT vec_id AS row_id, label, k AS prediction, score FROM p WHERE place = 1""",
    "linear_score": f"""{CLASS_SUMS}
        SELECT vec_id AS row_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY k) - 1 AS INTEGER)
               AS class_place, score FROM s""",
    "scores_by_class": """
        SELECT l_orderkey,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS pos,
               sum(l_quantity) AS score
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "accuracy": f"""{GUESSES}
        SELECT label, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS rows,
               round(CAST(sum(hit) AS DOUBLE) / count(*), 6) AS accuracy
        FROM guesses GROUP BY label""",
    "mean_shard_accuracy": f"""{SHARDED_GUESSES}
        SELECT round(avg(a), 6) AS accuracy FROM (SELECT avg(CAST(hit AS DOUBLE)) AS a FROM sharded GROUP BY shard)""",
    "union_results": f"""{SHARDED_GUESSES}
        SELECT shard, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS rows FROM sharded GROUP BY shard""",
    "ridge_weights_2f": """
        WITH t AS (SELECT l_quantity AS a, round(l_discount * 100) AS b,
                          CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM lineitem),
             g AS (SELECT sum(a * a) + 1 AS aa, sum(a * b) AS ab, sum(b * b) + 1 AS bb FROM t),
             y AS (SELECT k, sum(CASE WHEN label = k THEN a ELSE -a END) AS ya,
                          sum(CASE WHEN label = k THEN b ELSE -b END) AS yb
                   FROM t, (SELECT DISTINCT label AS k FROM t) GROUP BY k)
        SELECT k AS label, CAST(0 AS INTEGER) AS pos,
               round((ya * bb - yb * ab) / (aa * bb - ab * ab), 9) + 0.0 AS w FROM y, g
        UNION ALL
        SELECT k, CAST(1 AS INTEGER), round((aa * yb - ab * ya) / (aa * bb - ab * ab), 9) + 0.0 FROM y, g""",
    "ridge_weights": f"{weights_ctes(SINGLE)} {WEIGHTS}",
    "ridge_weights_eigh": f"{weights_ctes(SINGLE)} {WEIGHTS}",
    "ridge_weights_wide": f"{weights_ctes(SINGLE)} {WEIGHTS}",
    "ridge_weights_stable": f"{weights_ctes(FAR_ROWS)} {WEIGHTS}".replace("round(w, 6)", "round(w, 4)"),
    "ridge_weights_train": f"""{weights_ctes(SINGLE, mean="avg(x) FILTER (WHERE part = 'train')")} {WEIGHTS}""",
    "ridge_weights_absent": f"""{weights_ctes(SINGLE, labels=f"SELECT label FROM rows UNION SELECT {ABSENT}")} {WEIGHTS}
        WHERE k = {ABSENT}""",
    "average_weights": f"""{weights_ctes(SHARDED)}
        SELECT lambda_id, k AS label, CAST(pos AS INTEGER) AS pos, round(avg(w), 6) + 0.0 AS w
        FROM w GROUP BY lambda_id, k, pos""",
    "ridge_sweep": f"{weights_ctes(SINGLE)}, {accuracy_ctes()} {ACCURACY}",
    "ridge_sweep_drop_last": f"""{weights_ctes(DROPPED)}, {accuracy_ctes()} {ACCURACY}""",
    "ridge_sweep_n": f"""{weights_ctes(HASHED, penalty="lam * n")}, {accuracy_ctes()} {ACCURACY}""",
    "best_lambda": f"""{weights_ctes(SINGLE)}, {accuracy_ctes()} {ACCURACY}
        ORDER BY accuracy DESC, lambda_id LIMIT 1""",
    "ridge_sweep_sharded": f"""{weights_ctes(SHARDED).replace("w AS (", "each AS (")},
        w AS (SELECT lambda_id, pos, k, avg(w) AS w FROM each GROUP BY lambda_id, pos, k),
        {accuracy_ctes(fold_key=False)}
        SELECT lambda_id, round(avg(accuracy), 6) AS accuracy FROM acc GROUP BY lambda_id""",
    "ridge_sweep_sharded_drop": f"""{weights_ctes(SHARDED_DROP).replace("w AS (", "each AS (")},
        w AS (SELECT lambda_id, pos, k, avg(w) AS w FROM each GROUP BY lambda_id, pos, k),
        {accuracy_ctes(fold_key=False)}
        SELECT lambda_id, round(avg(accuracy), 6) AS accuracy FROM acc GROUP BY lambda_id""",
    "size_sweep": f"""{weights_ctes(_sizes("count(*) // 5, 3 * count(*) // 5, count(*)"))}, {accuracy_ctes()}
        SELECT fold AS n, lambda_id, round(accuracy, 6) AS accuracy FROM acc""",
    "best_by_size": f"""{weights_ctes(_sizes("count(*) // 2, count(*)"))}, {accuracy_ctes()},
        best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY accuracy DESC, lambda_id) AS place
                 FROM acc)
        SELECT fold AS n, lambda_id, round(accuracy, 6) AS accuracy FROM best WHERE place = 1""",
    "ridge_sweep_images": f"{dual_accuracy_ctes(IMAGE_ROWS)} {ACCURACY}",
    "ridge_sweep_orders": f"{weights_ctes(ORDER_ROWS)}, {accuracy_ctes()} {ACCURACY}",
}
