"""Matrix products whose inner side decides neither the number nor the size of the tasks."""

import numpy as np
import pyarrow as pa
import pytest

from ridgeworks.functions.pixels import to_list_array
from ridgeworks.operators import matrix


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dense(cells, shape):
    found = np.zeros(shape)
    for r in cells.collect():
        found[r["i"], r["j"]] += r["v"]
    return found


@pytest.mark.parametrize("grid, slab", [(8, 16), (3, 1), (1, 2)])
def test_seven_blocks_of_features(spark, grid, slab):
    """X^T X of 896 features, and X times it: 7 inner blocks on one side, 3 on the other."""
    x = np.random.default_rng(1).integers(-3, 4, (300, 7 * 128)).astype(float)
    rows = spark.createDataFrame(pa.table({"i": pa.array(np.arange(len(x))), "x": to_list_array(x)}))
    tiled = matrix.row_tiles(rows, "i", "x", x.shape, 128)
    turned = matrix.transpose_tiles(tiled)
    for a, b, expected in ((turned, tiled, x.T @ x), (tiled, turned, x @ x.T)):
        product = matrix.matmul_tiles(a, b, grid=grid, slab=slab)
        assert (dense(product, expected.shape) == expected).all()
        keys = plan_of(product).split("FlatMapCoGroupsInArrow")[1]
        assert all(key in keys for key in ("gi#", "gj#", "slab#"))


def test_partial_tiles_beyond_the_budget(spark, monkeypatch):
    monkeypatch.setattr(matrix, "TASK_BUDGET", 1)
    x = np.random.default_rng(2).integers(-3, 4, (9, 40)).astype(float)
    cells = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(9) for j in range(40)], "i long, j long, v double")
    tiles = [matrix.tiles(m, s, 4) for m, s in ((cells, (9, 40)), (matrix.transpose(cells), (40, 9)))]
    product = matrix.matmul_tiles(*tiles, size=4, grid=2, slab=1)
    assert (dense(product, (9, 9)) == x @ x.T).all()
    nothing = tiles[0].limit(0)
    assert matrix.matmul_tiles(nothing, tiles[1]).count() == 0


@pytest.mark.parametrize("most", [7, 64, 10**6])
def test_one_dense_inner_index(spark, most):
    """Inner index 5 holds nearly all cells of both sides; some cells are repeated."""
    rng = np.random.default_rng(3)
    a = [(i, 5, int(v)) for i, v in enumerate(rng.integers(-9, 9, 300))] + [(i, i % 11, 1) for i in range(60)]
    b = [(5, j, int(v)) for j, v in enumerate(rng.integers(-9, 9, 200))] + [(i % 11, i, 2) for i in range(30)]
    a, b = a + [(0, 5, 3)] * 40, b + [(5, 1, 4)] * 30 + [(99, 0, 1)]
    left, right = (spark.createDataFrame(x, "i long, j long, v long") for x in (a, b))
    expected = np.zeros((300, 12)), np.zeros((100, 200))
    for table, cells in zip(expected, (a, b), strict=True):
        for i, j, v in cells:
            table[i, j] += v
    product = matrix.matmul_cells(left, right, most=most)
    assert (dense(product, (300, 200)) == expected[0] @ expected[1][:12]).all()
    assert ("left_parts" in plan_of(product)) == (most < 300)


def test_heavy_but_not_hot(spark):
    """Over a thousand heavy indices: those with a small share of the cells are not broadcast."""
    a = [(i, k, 1) for k in range(1200) for i in range(3)]
    b = [(k, j, 1) for k in range(1200) for j in range(2)]
    left, right = (spark.createDataFrame(x, "i long, j long, v long") for x in (a, b))
    assert (dense(matrix.matmul_cells(left, right, most=2), (3, 2)) == 1200).all()
