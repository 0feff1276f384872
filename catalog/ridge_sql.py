"""Ridge classification in SQL: explicit centring and Gauss-Jordan elimination on lists of lists.

``rows`` must give (fold, part, row_id, label, pos, x) with part 'train', 'validation' or 'rest'.
"""

from __future__ import annotations

from catalog.common import LAMBDA_VALUES


def vector_rows(fold: str, part: str, source: str = "embeddings") -> str:
    """One row per element of the embeddings, placed by SQL expressions over vec_id and n."""
    return f"""
    SELECT fold, part, vec_id AS row_id, label, pos, x FROM (
      SELECT {fold} AS fold, {part} AS part, vec_id, label,
             generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
      FROM {source}, (SELECT count(*) AS n FROM embeddings))"""


# each step divides the first line by its first element, clears that column from the other lines,
# drops it and moves the first line to the end: what is left is the solution in the old order
ELIMINATION = """solve(fold, lambda_id, step, m) USING KEY (fold, lambda_id) AS (
      SELECT fold, lambda_id, 1, list(a ORDER BY i) FROM lines GROUP BY fold, lambda_id
      UNION ALL
      SELECT fold, lambda_id, step + 1, list_append(
        list_transform(m[2:], lambda line: list_transform(line[2:],
          lambda e, q: e - line[1] / m[1][1] * m[1][q + 1])),
        list_transform(m[1][2:], lambda e: e / m[1][1]))
      FROM solve WHERE step <= len(m))"""


def weights_ctes(
    rows: str,
    penalty: str = "lam",
    grid: str = LAMBDA_VALUES,
    mean: str = "avg(x)",
    labels: str = "SELECT DISTINCT label FROM rows",
) -> str:
    """CTEs up to w (fold, lambda_id, pos, k, w); ``labels`` selects the classes."""
    return f"""
    WITH RECURSIVE rows AS MATERIALIZED ({rows}),
    sizes AS (SELECT fold, count(DISTINCT row_id) AS n FROM rows GROUP BY fold),
    mean AS (SELECT fold, pos, {mean} AS m FROM rows GROUP BY fold, pos),
    c AS MATERIALIZED (SELECT rows.*, x - m AS z FROM rows JOIN mean USING (fold, pos)),
    classes AS (SELECT label AS k, row_number() OVER (ORDER BY label) AS place
                FROM ({labels})),
    dims AS (SELECT max(pos) + 1 AS d FROM rows),
    l(lambda_id, lam) AS (VALUES {grid}),
    g AS (SELECT a.fold, a.pos AS i, b.pos AS j, sum(a.z * b.z) AS v
          FROM c a JOIN c b ON a.fold = b.fold AND a.row_id = b.row_id
          WHERE a.part = 'train' AND b.part = 'train' GROUP BY a.fold, a.pos, b.pos),
    t AS (SELECT fold, pos AS i, place, sum(CASE WHEN label = k THEN z ELSE -z END) AS v
          FROM c, classes WHERE part = 'train' GROUP BY fold, pos, place),
    augmented AS (
      SELECT fold, lambda_id, i, j, v + CASE WHEN i = j THEN {penalty} ELSE 0 END AS v
      FROM g JOIN sizes USING (fold), l
      UNION ALL
      SELECT fold, lambda_id, i, d + place - 1, v FROM t, l, dims),
    lines AS (SELECT fold, lambda_id, i, list(v ORDER BY j) AS a FROM augmented GROUP BY fold, lambda_id, i),
    {ELIMINATION},
    w AS (
      SELECT fold, lambda_id, pos, k, m[pos + 1][place] AS w
      FROM solve, classes, (SELECT DISTINCT pos FROM rows) WHERE step > len(m))"""


def accuracy_ctes(fold_key: bool = True) -> str:
    """CTEs from w to acc (fold, lambda_id, accuracy); without fold_key the weights are shared."""
    join = "USING (fold, pos)" if fold_key else "USING (pos)"
    return f"""
    s AS (SELECT c.fold, lambda_id, row_id, label, k, sum(z * w) AS score
          FROM c JOIN w {join} WHERE part = 'validation' GROUP BY c.fold, lambda_id, row_id, label, k),
    p AS (SELECT *, row_number() OVER (PARTITION BY fold, lambda_id, row_id ORDER BY score DESC, k) AS place
          FROM s),
    acc AS (SELECT fold, lambda_id, avg(CASE WHEN k = label THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
            FROM p WHERE place = 1 GROUP BY fold, lambda_id)"""


def dual_accuracy_ctes(rows: str) -> str:
    """CTEs up to acc for more features than rows: one unknown per training row.

    The score of a row is the sum of its products with the training rows times the solution of
    (Z Z^T + lambda I) a = Y.
    """
    return f"""
    WITH RECURSIVE rows AS MATERIALIZED ({rows}),
    mean AS (SELECT fold, pos, avg(x) AS m FROM rows GROUP BY fold, pos),
    c AS MATERIALIZED (SELECT rows.*, x - m AS z FROM rows JOIN mean USING (fold, pos)),
    classes AS (SELECT label AS k, row_number() OVER (ORDER BY label) AS place
                FROM (SELECT DISTINCT label FROM rows)),
    heads AS (SELECT fold, part, row_id, label, row_number() OVER (PARTITION BY part ORDER BY row_id) - 1 AS nth
              FROM (SELECT DISTINCT fold, part, row_id, label FROM rows)),
    v AS MATERIALIZED (SELECT fold, row_id, list(z ORDER BY pos) AS z FROM c GROUP BY fold, row_id),
    products AS MATERIALIZED (
      SELECT fold, a.part, a.row_id, a.label, a.nth AS i, b.nth AS j, list_inner_product(va.z, vb.z) AS v
      FROM heads a JOIN heads b USING (fold) JOIN v va ON va.row_id = a.row_id JOIN v vb ON vb.row_id = b.row_id
      WHERE b.part = 'train'),
    l(lambda_id, lam) AS (VALUES {LAMBDA_VALUES}),
    augmented AS (
      SELECT fold, lambda_id, i, j, v + CASE WHEN i = j THEN lam ELSE 0 END AS v
      FROM products, l WHERE part = 'train'
      UNION ALL
      SELECT fold, lambda_id, nth, 1000000000 + place, CASE WHEN label = k THEN 1.0::DOUBLE ELSE -1 END
      FROM heads, l, classes WHERE part = 'train'),
    lines AS (SELECT fold, lambda_id, i, list(v ORDER BY j) AS a FROM augmented GROUP BY fold, lambda_id, i),
    {ELIMINATION},
    a AS (SELECT fold, lambda_id, nth AS j, k, m[nth + 1][place] AS a
          FROM solve JOIN heads USING (fold), classes WHERE step > len(m) AND part = 'train'),
    s AS (SELECT fold, lambda_id, row_id, label, k, sum(v * a) AS score
          FROM products JOIN a USING (fold, j) WHERE part = 'validation'
          GROUP BY fold, lambda_id, row_id, label, k),
    p AS (SELECT *, row_number() OVER (PARTITION BY fold, lambda_id, row_id ORDER BY score DESC, k) AS place
          FROM s),
    acc AS (SELECT fold, lambda_id, avg(CASE WHEN k = label THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
            FROM p WHERE place = 1 GROUP BY fold, lambda_id)"""
