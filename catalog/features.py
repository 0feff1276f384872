"""Projections, vector functions, pixels and matrix products."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import LAMBDA_VALUES, LAMBDAS, WHOLE_SQL, table, vectors, whole_vectors
from ridgeworks.functions.pixels import downsample, select_channel
from ridgeworks.functions.vectors import (
    argmax_position,
    binarise,
    flatten_rows,
    fold_rows,
    lambda_array,
    one_vs_rest,
    quantise,
    scale_vector,
    sign_decision,
)
from ridgeworks.operators import matrix
from ridgeworks.operators.moments import centre, class_sums, feature_width, gram_matrix, mean_vector
from ridgeworks.operators.solve import lambda_class_grid, ridge_diagonal
from ridgeworks.operators.splits import row_count
from ridgeworks.plans.sweep import distinct_labels
from ridgeworks.sources.images import class_of, image_vectors


def _cells(df, name, *keys, kind="bigint"):
    return df.select(*keys, F.posexplode(name).alias("pos", "v")).withColumn("v", F.col("v").cast(kind))


def dataset_shape(spark, folder):
    return matrix.dataset_shape(vectors(spark, folder), "embedding")


def flatten_rowmajor(spark, folder):
    folded = vectors(spark, folder).withColumn("m", fold_rows(F.col("embedding"), 8))
    return _cells(folded.withColumn("f", flatten_rows(F.col("m"))), "f", "vec_id", kind="double")


def binarize(spark, folder):
    parts = F.array(F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") / 50)
    rows = table(spark, folder, "lineitem").withColumn("b", binarise(parts))
    return rows.select("l_orderkey", "l_linenumber", *[F.col("b")[i].alias(f"b{i}") for i in range(3)])


def center_features(spark, folder):
    rows = centre(vectors(spark, folder), "embedding")
    cells = rows.select("vec_id", F.posexplode("centred").alias("pos", "v"))
    return cells.withColumn("v", F.round("v", 6))


def ovr_encode(spark, folder):
    rows = vectors(spark, folder)
    classes = F.explode(F.array(*[F.lit(k) for k in distinct_labels(rows)])).alias("k")
    return rows.select("vec_id", "label", classes).select(
        "vec_id", "k", one_vs_rest(F.col("label"), F.col("k")).alias("y")
    )


def sign_decisions(spark, folder):
    score = F.col("l_tax") - F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        sign_decision(score).alias("decision"),
        sign_decision(score, zero=0).alias("sign"),
    )


def argmax_class(spark, folder):
    scores = quantise(F.col("embedding"), 8)
    return vectors(spark, folder).select("vec_id", argmax_position(scores).alias("prediction"))


def lambda_grid(spark, folder):
    sizes = vectors(spark, folder).groupBy("label").agg(F.count("*").alias("n"))
    rows = sizes.select("label", "n", F.inline(lambda_array(LAMBDAS)))
    return rows.select(
        "label",
        "lambda_id",
        F.round(F.log10("lambda"), 9).alias("log_lambda"),
        F.round(F.log10(F.col("lambda") * F.col("n")), 9).alias("log_penalty"),
    )


def lambda_class(spark, folder):
    grid = lambda_class_grid(vectors(spark, folder), LAMBDAS)
    return grid.select("lambda_id", "label", F.round(F.log10("lambda"), 9).alias("log_lambda"))


def cast_numeric(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").substr(1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.col("o_totalprice").cast("string").try_cast("double").alias("price"),
        F.col("o_custkey").cast("double").alias("customer"),
    )


def scale_by_label(spark, folder):
    y = one_vs_rest(F.col("label"), 3)
    rows = whole_vectors(spark, folder).withColumn("xy", scale_vector(F.col("embedding"), y))
    return _cells(rows, "xy", "vec_id")


def rename_reorder(spark, folder):
    names = {"s_acctbal": "balance", "s_suppkey": "id", "s_nationkey": "nation"}
    return matrix.rename_select(table(spark, folder, "supplier"), names)


def select_channels(spark, folder):
    red = select_channel(F.encode("text", "UTF-8"), F.lit(3), F.lit(2))
    rows = table(spark, folder, "documents").select("doc_id", red.alias("red"))
    total = F.aggregate("red", F.lit(0).cast("long"), lambda t, x: t + x)
    return rows.select("doc_id", F.size("red").alias("pixels"), total.alias("red_sum"))


def downsample_images(spark, folder):
    rows = vectors(spark, folder).withColumn(
        "small", downsample(F.col("embedding").cast("array<double>"), (8, 8), (4, 6))
    )
    return rows.select("vec_id", F.posexplode("small").alias("pos", "v")).withColumn("v", F.round("v", 6))


def image_pixels(spark, folder):
    """An 8 x 8 colour image per embedding, down-sampled to 4 x 6 black and white."""

    def two_digits(byte):
        return F.lpad(F.hex(byte.cast("long")), 2, "0")

    red = F.transform("embedding", lambda x: F.pmod(F.floor(x.cast("double") * 65536), F.lit(256)))
    bytes_ = F.transform("red", lambda v: F.concat(two_digits(255 - v), two_digits(F.floor(v / 2)), two_digits(v)))
    origin = F.concat(F.lit("images/class_"), F.col("label"), F.lit("/"), F.col("vec_id"), F.lit(".png"))
    images = vectors(spark, folder).withColumn("red", red).select(
        origin.alias("origin"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(3).alias("nChannels"),
        F.unhex(F.array_join(bytes_, "")).alias("data"),
    )
    images = images.withColumn("label", class_of(F.col("origin")))
    return image_vectors(images, (4, 6)).select("origin", "label", F.posexplode("features").alias("pos", "v"))


def mean_image(spark, folder):
    means = mean_vector(vectors(spark, folder), "embedding")
    return means.select("pos", F.round("mean", 9).alias("mean"))


def gram(spark, folder):
    cells = gram_matrix(whole_vectors(spark, folder), "embedding")
    return cells.withColumn("v", F.col("v").cast("bigint"))


def xty(spark, folder):
    sums = class_sums(whole_vectors(spark, folder), "embedding")
    return sums.withColumn("v", F.col("v").cast("bigint"))


def ridged(spark, folder):
    cells = gram_matrix(whole_vectors(spark, folder), "embedding")
    return ridge_diagonal(cells, LAMBDAS).select("lambda_id", "i", "j", "v")


def matmul_blocks(spark, folder):
    rows = whole_vectors(spark, folder)
    shape = row_count(rows), feature_width(rows, "embedding")
    x = matrix.row_tiles(rows, "vec_id", "embedding", shape, 128)
    product = matrix.matmul_tiles(matrix.transpose_tiles(x), x)
    return product.withColumn("v", F.col("v").cast("bigint"))


def matmul_cells(spark, folder):
    """Customers by nation times nations by region: a sparse product."""
    customers = table(spark, folder, "customer")
    a = customers.select(
        F.col("c_custkey").alias("i"), F.col("c_nationkey").alias("j"), F.lit(1).cast("bigint").alias("v")
    )
    nations = table(spark, folder, "nation")
    b = nations.select(
        F.col("n_nationkey").alias("i"), F.col("n_regionkey").alias("j"), (F.col("n_nationkey") + 1).alias("v")
    )
    return matrix.matmul_cells(a, b)


def matmul_heavy(spark, folder):
    """Orders by return flag times return flags by line number: three inner indices hold all cells."""
    flag = F.ascii("l_returnflag").cast("bigint")
    lines = table(spark, folder, "lineitem")
    a = lines.select(F.col("l_orderkey").alias("i"), flag.alias("j"), F.col("l_quantity").cast("bigint").alias("v"))
    counts = lines.groupBy(flag.alias("i"), F.col("l_linenumber").alias("j")).agg(F.count("*").alias("v"))
    return matrix.matmul_cells(a, counts)


QUERIES = {
    "dataset_shape": dataset_shape,
    "flatten_rowmajor": flatten_rowmajor,
    "binarize": binarize,
    "center_features": center_features,
    "ovr_encode": ovr_encode,
    "sign_decision": sign_decisions,
    "argmax_class": argmax_class,
    "lambda_grid": lambda_grid,
    "lambda_class_grid": lambda_class,
    "cast_numeric": cast_numeric,
    "scale_by_label": scale_by_label,
    "rename_reorder": rename_reorder,
    "select_channel": select_channels,
    "downsample": downsample_images,
    "image_pixels": image_pixels,
    "mean_image": mean_image,
    "gram_matrix": gram,
    "xty": xty,
    "ridge_diagonal": ridged,
    "matmul_blocks": matmul_blocks,
    "matmul_cells": matmul_cells,
    "matmul_heavy": matmul_heavy,
}

GRAM_SQL = """
g AS (
  SELECT a.pos AS i, b.pos AS j, CAST(sum(a.q * b.q) AS BIGINT) AS v
  FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos
)"""

ORACLES = {
    "dataset_shape": """
        SELECT count(*) AS n_rows, CAST(min(len(embedding)) AS INTEGER) AS min_width,
               CAST(max(len(embedding)) AS INTEGER) AS max_width
        FROM embeddings""",
    "flatten_rowmajor": """
        SELECT vec_id, CAST(r * 8 + c AS INTEGER) AS pos, CAST(embedding[r * 8 + c + 1] AS DOUBLE) AS v
        FROM embeddings, range(0, 8) a(r), range(0, 8) b(c)""",
    "binarize": """
        WITH t AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS a, l_tax * 10 AS b, l_quantity / 50 AS c
                   FROM lineitem)
        SELECT l_orderkey, l_linenumber,
               CASE WHEN a < 0.5 THEN 0.0::DOUBLE WHEN a > 0.5 THEN 1.0::DOUBLE ELSE a END AS b0,
               CASE WHEN b < 0.5 THEN 0.0::DOUBLE WHEN b > 0.5 THEN 1.0::DOUBLE ELSE b END AS b1,
               CASE WHEN c < 0.5 THEN 0.0::DOUBLE WHEN c > 0.5 THEN 1.0::DOUBLE ELSE c END AS b2
        FROM t""",
    "center_features": """
        WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
                          CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
             m AS (SELECT pos, avg(v) AS mean FROM x GROUP BY pos)
        SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(v - mean, 6) + 0.0 AS v FROM x JOIN m USING (pos)""",
    "ovr_encode": """
        SELECT vec_id, k, CASE WHEN label = k THEN 1 ELSE -1 END AS y
        FROM embeddings, (SELECT DISTINCT label AS k FROM embeddings)""",
    "sign_decision": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_tax - l_discount > 0 THEN 1 ELSE -1 END AS decision,
               CAST(sign(l_tax - l_discount) AS INTEGER) AS sign
        FROM lineitem""",
    "argmax_class": """
        WITH s AS (SELECT vec_id, k, floor(CAST(embedding[k + 1] AS DOUBLE) * 8) AS score
                   FROM embeddings, range(0, 64) t(k)),
             r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, k) AS place FROM s)
        SELECT vec_id, CAST(k AS INTEGER) AS prediction FROM r WHERE place = 1""",
    "lambda_grid": """
        WITH n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
        SELECT label, CAST(i AS INTEGER) AS lambda_id, round(-5 + i * 10.0::DOUBLE / 9, 9) + 0.0 AS log_lambda,
               round(log10(pow(10, -5 + i * 10.0::DOUBLE / 9) * n), 9) + 0.0 AS log_penalty
        FROM n, range(0, 10) t(i)""",
    "lambda_class_grid": """
        SELECT CAST(i AS INTEGER) AS lambda_id, label, round(-5 + i * 10.0::DOUBLE / 9, 9) + 0.0 AS log_lambda
        FROM (SELECT DISTINCT label FROM embeddings), range(0, 10) t(i)""",
    "cast_numeric": """
        SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
               TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number, o_totalprice AS price,
               CAST(o_custkey AS DOUBLE) AS customer
        FROM orders""",
    "scale_by_label": f"""
        WITH {WHOLE_SQL}
        SELECT vec_id, CAST(pos AS INTEGER) AS pos, CASE WHEN label = 3 THEN q ELSE -q END AS v FROM x""",
    "rename_reorder": """
        SELECT s_acctbal AS balance, s_suppkey AS id, s_nationkey AS nation FROM supplier""",
    "select_channel": """
        WITH h AS (SELECT doc_id, hex(encode(text)) AS h FROM documents),
             p AS (SELECT doc_id, h, len(h) // 6 AS pixels FROM h)
        SELECT doc_id, CAST(pixels AS INTEGER) AS pixels,
               CAST(coalesce(list_sum(list_transform(range(0, pixels),
                 lambda i: CAST('0x' || substr(h, i * 6 + 5, 2) AS INTEGER))), 0) AS BIGINT) AS red_sum
        FROM p""",
    "downsample": """
        WITH t AS (SELECT r * 6 + c AS pos, 7 * r / 3.0::DOUBLE AS y, 7 * c / 5.0::DOUBLE AS x
                   FROM range(0, 4) a(r), range(0, 6) b(c)),
             f AS (SELECT pos, least(floor(y), 6)::BIGINT AS y0, least(floor(x), 6)::BIGINT AS x0, y, x FROM t)
        SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(
                 (1 - (y - y0)) * (1 - (x - x0)) * embedding[y0 * 8 + x0 + 1]::DOUBLE
               + (1 - (y - y0)) * (x - x0) * embedding[y0 * 8 + x0 + 2]::DOUBLE
               + (y - y0) * (1 - (x - x0)) * embedding[(y0 + 1) * 8 + x0 + 1]::DOUBLE
               + (y - y0) * (x - x0) * embedding[(y0 + 1) * 8 + x0 + 2]::DOUBLE, 6) + 0.0 AS v
        FROM embeddings, f""",
    "image_pixels": """
        WITH p AS (SELECT vec_id, label, list_transform(embedding, lambda e:
                     CASE WHEN (CAST(floor(CAST(e AS DOUBLE) * 65536) AS BIGINT) % 256 + 256) % 256 > 127
                          THEN 1.0::DOUBLE ELSE 0 END) AS f FROM embeddings),
             t AS (SELECT r * 6 + c AS pos, 7 * r / 3.0::DOUBLE AS y, 7 * c / 5.0::DOUBLE AS x
                   FROM range(0, 4) a(r), range(0, 6) b(c)),
             g AS (SELECT pos, least(floor(y), 6)::BIGINT AS y0, least(floor(x), 6)::BIGINT AS x0, y, x FROM t),
             v AS (SELECT vec_id, label, pos,
                 (1 - (y - y0)) * (1 - (x - x0)) * f[y0 * 8 + x0 + 1]
               + (1 - (y - y0)) * (x - x0) * f[y0 * 8 + x0 + 2]
               + (y - y0) * (1 - (x - x0)) * f[(y0 + 1) * 8 + x0 + 1]
               + (y - y0) * (x - x0) * f[(y0 + 1) * 8 + x0 + 2] AS v
             FROM p, g)
        SELECT 'images/class_' || label || '/' || vec_id || '.png' AS origin, label, CAST(pos AS INTEGER) AS pos,
               CASE WHEN v > 0.5 THEN 1.0::DOUBLE ELSE 0 END AS v FROM v""",
    "mean_image": """
        WITH x AS (SELECT generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
                   FROM embeddings)
        SELECT CAST(pos AS INTEGER) AS pos, round(avg(v), 9) + 0.0 AS mean FROM x GROUP BY pos""",
    "gram_matrix": f"""
        WITH {WHOLE_SQL}, {GRAM_SQL}
        SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, v FROM g WHERE i <= j""",
    "xty": f"""
        WITH {WHOLE_SQL}
        SELECT k AS label, CAST(pos AS INTEGER) AS pos,
               CAST(sum(CASE WHEN label = k THEN q ELSE -q END) AS BIGINT) AS v
        FROM x, (SELECT DISTINCT label AS k FROM embeddings) GROUP BY k, pos""",
    "ridge_diagonal": f"""
        WITH {WHOLE_SQL}, {GRAM_SQL}, l(lambda_id, lam) AS (VALUES {LAMBDA_VALUES})
        SELECT lambda_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
               CAST(v AS DOUBLE) + CASE WHEN i = j THEN lam ELSE 0 END AS v
        FROM g, l WHERE i <= j""",
    "matmul_blocks": f"""
        WITH {WHOLE_SQL}, {GRAM_SQL}
        SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, v FROM g""",
    "matmul_cells": """
        SELECT c_custkey AS i, n_regionkey AS j, CAST(sum(1 * (n_nationkey + 1)) AS BIGINT) AS v
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_custkey, n_regionkey""",
    "matmul_heavy": """
        WITH a AS (SELECT l_orderkey, l_returnflag, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL),
             b AS (SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT l_orderkey AS i, l_linenumber AS j, CAST(sum(q * n) AS BIGINT) AS v
        FROM a JOIN b USING (l_returnflag) GROUP BY l_orderkey, l_linenumber""",
}
