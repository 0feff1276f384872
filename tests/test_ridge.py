import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ridgeworks.functions.pixels import to_list_array
from ridgeworks.functions.vectors import log_spaced
from ridgeworks.operators import moments, score, solve, wide
from ridgeworks.plans import sweep
from ridgeworks.session import ensure_checkpoint_dir
from tests import brute

LAMBDAS = [0.01, 1.0, 100.0]


def frame(spark, x, y, partitions=3):
    table = pa.table(
        {
            "row_id": pa.array(np.arange(len(x))),
            "label": pa.array(np.asarray(y, dtype=np.int32)),
            "features": to_list_array(np.asarray(x, dtype=float)),
        }
    )
    return spark.createDataFrame(table).repartition(partitions)


def separable(n=120, d=6, k=3, seed=1):
    """Classes around distinct centres; class 0 holds a third of the rows and more."""
    rng = np.random.default_rng(seed)
    y = np.where(rng.random(n) < 0.4, 0, rng.integers(0, k, n))
    return 3 * np.eye(k, d)[y] + rng.normal(size=(n, d)), y


def accuracies(df):
    return [r["accuracy"] for r in df.orderBy("lambda_id").collect()]


def alternating(spark, n=10):
    x = np.array([[1, 0], [0, 1]] * (n // 2))
    return frame(spark, x, [0, 1] * (n // 2))


def weight_rows(weights):
    return {(r["lambda_id"], r["label"]): np.array(r["weights"]) for r in weights.collect()}


def test_hand_computed_weights(spark):
    rows = alternating(spark)
    w = weight_rows(sweep.ridge_weights(rows, lambdas=[1.0]))
    assert np.allclose(w[0, 0], [0.8, -0.8]) and np.allclose(w[0, 1], [-0.8, 0.8])
    w = weight_rows(sweep.ridge_weights(rows, lambdas=[1.0], reg_scale="n"))
    assert np.allclose(w[0, 0], np.array([4, -4]) / 14)
    fit = sweep.fit_single(rows, lambdas=[1.0], drop_last=True)
    assert [(r["rows"], r["accuracy"]) for r in fit.accuracies().collect()] == [(1, 1.0)]


def test_hand_computed_shards(spark):
    rows = alternating(spark)
    fit = sweep.fit_shards(rows, 2, lambdas=[1.0])
    w = weight_rows(solve.average_weights(fit.weights()))
    assert np.allclose(w[0, 0], np.array([2, -2]) / 3.08)
    assert accuracies(sweep.ridge_sweep_sharded(rows, 2, lambdas=[1.0])) == [1.0]
    assert accuracies(sweep.ridge_sweep_sharded(rows, 2, lambdas=[1.0], drop_last=True)) == [None]


@pytest.mark.parametrize("solver", ["direct", "eigh", "wide"])
@pytest.mark.parametrize("center", ["all", "train", "none"])
def test_sweep_equals_brute_force(spark, solver, center):
    x, y = separable()
    ours = sweep.ridge_sweep(frame(spark, x, y), lambdas=LAMBDAS, solver=solver, center=center)
    assert accuracies(ours) == pytest.approx(brute.sweep(x, y, LAMBDAS, center=center))


def test_sweep_learns(spark):
    x, y = separable(400)
    assert accuracies(sweep.ridge_sweep(frame(spark, x, y), lambdas=[1.0]))[0] > 0.9


@pytest.mark.parametrize("shards", [1, 3, 4])
@pytest.mark.parametrize("drop_last", [False, True])
def test_sharded_equals_brute_force(spark, shards, drop_last):
    x, y = separable(101)
    ours = sweep.ridge_sweep_sharded(frame(spark, x, y), shards, lambdas=LAMBDAS, drop_last=drop_last)
    assert accuracies(ours) == pytest.approx(brute.sharded_sweep(x, y, shards, LAMBDAS, drop_last))


def test_more_shards_than_some_have_rows(spark):
    x, y = separable(23)
    ours = sweep.ridge_sweep_sharded(frame(spark, x, y), 9, lambdas=[1.0])
    assert accuracies(ours) == pytest.approx(brute.sharded_sweep(x, y, 9, [1.0]))


def test_size_sweep_equals_separate_sweeps(spark):
    x, y = separable(100)
    classes = sorted(set(y.tolist()))
    ours = sweep.size_sweep(frame(spark, x, y), [30, 55, 90], lambdas=LAMBDAS, drop_last=True, classes=classes)
    found = {(r["n"], r["lambda_id"]): r["accuracy"] for r in ours.collect()}
    for n in (30, 55, 90):
        expected = brute.sweep(x[:n], y[:n], LAMBDAS, classes=classes, drop_last=True)
        assert [found[n, i] for i in range(3)] == pytest.approx(expected)


def test_hash_split_sweep(spark):
    import hashlib

    x, y = separable()
    place = np.argsort(np.argsort([hashlib.md5(f"5:{i}".encode()).hexdigest() for i in range(len(x))]))
    train, valid = place < 96, (place >= 96) & (place < 119)
    ours = sweep.ridge_sweep(
        frame(spark, x, y), lambdas=LAMBDAS, split="hash", seed=5, drop_last=True, reg_scale="n"
    )
    assert accuracies(ours) == pytest.approx(brute.sweep(x, y, LAMBDAS, reg_scale="n", train=train, valid=valid))


def test_absent_class_gets_minus_one_targets(spark):
    x, y = separable(60)
    w = weight_rows(sweep.ridge_weights(frame(spark, x, y), lambdas=[1.0], classes=[0, 1, 2, 9]))
    z = x[:48] - x.mean(axis=0)
    assert np.allclose(w[0, 9], np.linalg.solve(z.T @ z + np.eye(6), -z.sum(axis=0)))


@pytest.mark.parametrize("solver", ["direct", "eigh", "wide"])
def test_absent_classes_tie_exactly(spark, solver):
    x, y = separable(90, d=11)
    classes = [0, 1, 2, *range(10, 31)]
    fit = sweep.fit_single(frame(spark, x, y), lambdas=LAMBDAS, classes=classes, solver=solver)
    for row in fit.scorer().scores().collect():
        assert len(set(row["scores"][3:])) == 1
    assert accuracies(fit.accuracies()) == pytest.approx(brute.sweep(x, y, LAMBDAS, classes=classes))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(6, 40), d=st.integers(1, 5), parts=st.integers(1, 6), seed=st.integers(0, 99))
def test_moments_do_not_depend_on_partitions(spark, n, d, parts, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 256, (n, d)).astype(float), rng.integers(0, 3, n)
    cells = moments.gram_matrix(frame(spark, x, y, parts)).collect()
    gram = x.T @ x
    assert {(r["i"], r["j"]): r["v"] for r in cells} == {
        (i, j): gram[i, j] for i in range(d) for j in range(i, d)
    }


def test_normal_equations_and_large_lambda(spark):
    x, y = separable()
    rows = frame(spark, x, y)
    z = x[:96] - x.mean(axis=0)
    targets = np.where(y[:96, None] == np.arange(3), 1.0, -1.0)
    w = weight_rows(sweep.ridge_weights(rows, lambdas=[0.5, 1e9]))
    for k in range(3):
        residual = z.T @ (z @ w[0, k] - targets[:, k]) + 0.5 * w[0, k]
        assert np.abs(residual).max() < 1e-9
        assert np.allclose(w[1, k] * 1e9, z.T @ targets[:, k], rtol=1e-5)


def test_linear_regression_gives_the_same_weights(spark):
    x, y = separable()
    rows, penalty = frame(spark, x, y), 3.0
    w = weight_rows(sweep.ridge_weights(rows, lambdas=[penalty]))[0, 1]
    mean = F.array(*[F.lit(float(m)) for m in x.mean(axis=0)])
    train = rows.where("row_id < 96").select(
        array_to_vector(F.zip_with("features", mean, lambda a, b: a - b)).alias("features"),
        F.when(F.col("label") == 1, 1.0).otherwise(-1.0).alias("label"),
    )
    spread = np.where(y[:96] == 1, 1.0, -1.0).std()
    model = LinearRegression(
        solver="normal",
        elasticNetParam=0.0,
        fitIntercept=False,
        standardization=False,
        regParam=penalty * spread / 96,
    ).fit(train)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-10)


def test_solvers_agree_on_weights(spark):
    x, y = separable()
    rows = frame(spark, x, y)
    found = [
        weight_rows(sweep.ridge_weights(rows, lambdas=LAMBDAS, solver=s)) for s in ("direct", "eigh", "wide")
    ]
    for key, expected in found[0].items():
        assert np.allclose(found[1][key], expected, atol=1e-10)
        assert np.allclose(found[2][key], expected, atol=1e-8)


@pytest.mark.parametrize("solver", ["eigh", "wide"])
def test_shards_too_small_to_train(spark, solver):
    x, y = separable(6)
    fit = sweep.fit_shards(frame(spark, x, y), 4, lambdas=[1.0], solver=solver)
    w = weight_rows(solve.average_weights(fit.weights()))
    parts = []
    for a, b in zip(np.array_split(x, 4), np.array_split(y, 4), strict=True):
        split = int(0.8 * len(a))
        parts.append(brute.fit((a - a.mean(axis=0))[:split], b[:split], fit.classes, 1.0))
    expected = np.mean(parts, axis=0)
    assert np.allclose(np.array([w[0, k] for k in fit.classes]).T, expected)


def test_many_classes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(90, 4)), rng.integers(0, 40, 90)
    monkeypatch.setattr(moments, "TASK_BUDGET", 2 * 8 * 4 * 10)
    monkeypatch.setattr(moments, "BATCH_BYTES", 8 * 4 * 3)
    monkeypatch.setattr(score, "SCORE_BYTES", 1)
    monkeypatch.setattr(moments, "FEW_CLASSES", 5)
    ours = accuracies(sweep.ridge_sweep(frame(spark, x, y, 1), lambdas=LAMBDAS))
    assert ours == pytest.approx(brute.sweep(x, y, LAMBDAS))


@pytest.mark.parametrize("solver", ["direct", "eigh", "wide"])
def test_large_mean(spark, solver):
    x, y = separable()
    far = x + 1e7
    z = far[:96] - far.mean(axis=0)
    expected = brute.fit(z, y[:96], [0, 1, 2], 1.0)
    fit = sweep.fit_single(frame(spark, far, y), lambdas=[1.0], stable=True, solver=solver)
    found = weight_rows(fit.weights())
    assert np.allclose(np.array([found[0, k] for k in range(3)]).T, expected, atol=1e-7)
    assert fit.accuracies().first()["accuracy"] == pytest.approx(brute.sweep(far, y, [1.0])[0])


@pytest.mark.parametrize("tile, class_rows", [(1, 1), (2, 2), (4, 3), (5, 1), (6, 9)])
@pytest.mark.parametrize("stable", [False, True])
def test_tiles_of_any_size(spark, monkeypatch, tile, class_rows, stable):
    x, y = separable()
    monkeypatch.setattr(wide, "CLASS_BYTES", 8 * 6 * class_rows)
    fit = sweep.fit_single(frame(spark, x, y), lambdas=LAMBDAS, solver="wide", stable=stable)
    expected = weight_rows(solve.solve_ridge(fit.moments, fit.folds, LAMBDAS, fit.classes, reg_scale="n"))
    found = weight_rows(wide.solve_wide(fit.moments, fit.folds, LAMBDAS, fit.classes, reg_scale="n", tile=tile))
    assert found.keys() == expected.keys()
    assert all(np.allclose(found[key], expected[key], atol=1e-10) for key in expected)


@pytest.mark.parametrize("center", ["all", "train", "none"])
def test_folds_in_tiles(spark, center):
    """Several folds, segments that several folds share, a class that the first fold lacks."""
    x, y = separable(100)
    y[:40] %= 2
    found = []
    for solver in ("wide", "direct"):
        ours = sweep.size_sweep(frame(spark, x, y), [30, 55, 100], lambdas=LAMBDAS, solver=solver, center=center)
        found.append({(r["n"], r["lambda_id"]): r["accuracy"] for r in ours.collect()})
    assert found[0] == found[1] and len(found[0]) == 9


@pytest.mark.parametrize("limit", [39, 40])
def test_nothing_changes_at_the_dense_limit(spark, monkeypatch, limit):
    """The solver that the width chooses, on either side of the limit."""
    x, y = separable(150, d=40)
    monkeypatch.setattr(sweep, "DENSE_LIMIT", limit)
    fit = sweep.fit_single(frame(spark, x, y), lambdas=LAMBDAS)
    assert fit.solver == {39: "wide", 40: "direct"}[limit]
    expected = np.array([brute.fit((x - x.mean(axis=0))[:120], y[:120], fit.classes, v) for v in LAMBDAS])
    found = weight_rows(fit.weights())
    assert np.allclose([[found[i, k] for k in fit.classes] for i in range(3)], expected.transpose(0, 2, 1), atol=1e-9)
    assert accuracies(fit.accuracies()) == pytest.approx(brute.sweep(x, y, LAMBDAS))


def test_one_scan_of_wide_vectors(spark, monkeypatch):
    """Vectors whose matrix exceeds the budget of a task are read once, with 21 600 features as with 7."""
    x, y = separable(60, d=7)
    whole = np.round(100 * x)
    rows = frame(spark, whole, y)
    expected = sorted(map(tuple, moments.gram_matrix(rows).collect()))
    for budget in (8 * 7 * 8, 8 * 7 * 30):
        monkeypatch.setattr(moments, "TASK_BUDGET", budget)
        sums = moments.gram_matrix(rows)
        assert sums._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
        assert sorted(map(tuple, sums.collect())) == expected
        for solver in ("direct", "wide"):
            fit = sweep.fit_single(rows, lambdas=[1.0], stable=True, solver=solver)
            found = weight_rows(fit.weights())
            z = (whole - whole.mean(axis=0))[:48]
            assert np.allclose(np.array([found[0, k] for k in fit.classes]).T, brute.fit(z, y[:48], fit.classes, 1.0), atol=1e-10)
    wide_rows = spark.range(3).select(F.transform(F.sequence(F.lit(1), F.lit(21600)), lambda i: i * 1.0).alias("features"))
    plan = moments.gram_matrix(wide_rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Union" not in plan


@pytest.mark.parametrize("center", ["all", "train", "none"])
def test_pairwise_moments_keep_their_digits(spark, center):
    x, y = separable(200)
    far = x + 1e6
    stable = moments.class_moments(frame(spark, far, y, 7), label="label", stable=True)
    row = stable.where("kind = 'comoment' AND key = 0").first()
    assert row["n"] == 200 and np.allclose(row["vals"][6:], far.mean(axis=0), rtol=1e-14)
    spread = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    assert np.allclose(row["vals"][:6], spread[0], rtol=1e-8)
    ours = sweep.ridge_sweep(frame(spark, far, y, 7), lambdas=LAMBDAS, stable=True, center=center)
    if center != "none":
        assert accuracies(ours) == pytest.approx(brute.sweep(x, y, LAMBDAS, center=center))


def test_column_panels_and_early_flush(spark, monkeypatch):
    x, y = separable(60, d=7)
    whole = np.round(100 * x)
    expected = moments.gram_matrix(frame(spark, whole, y)).orderBy("i", "j").collect()
    for module in (moments, sweep):
        monkeypatch.setattr(module, "TASK_BUDGET", 8 * 7 * 2)
    assert moments.gram_matrix(frame(spark, whole, y)).orderBy("i", "j").collect() == expected
    for clustered in (False, True):
        ours = sweep.ridge_sweep_sharded(frame(spark, x, y), 4, lambdas=LAMBDAS, clustered=clustered)
        assert accuracies(ours) == pytest.approx(brute.sharded_sweep(x, y, 4, LAMBDAS))


def test_averages_are_taken_of_whole_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = rng.integers(-9, 9, (7, 2, 3, 4)).astype(float)
    index = np.indices(values.shape[:3]).reshape(3, -1)
    table = pa.table(
        {
            "fold": pa.array(index[0], pa.int32()),
            "lambda_id": pa.array(index[1], pa.int32()),
            "lambda": pa.array(index[1] + 0.5),
            "label": pa.array(index[2], pa.int32()),
            "weights": to_list_array(values.reshape(-1, 4)),
        }
    )
    for budget in (solve.TASK_BUDGET, 1):
        monkeypatch.setattr(solve, "TASK_BUDGET", budget)
        means = solve.average_weights(spark.createDataFrame(table).repartition(3))
        plan = means._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "collect_list" not in plan
        found = weight_rows(means)
        assert all(np.allclose(found[i, k], values[:, i, k].mean(axis=0)) for i in range(2) for k in range(3))


def test_ten_thousand_shards(spark, monkeypatch):
    """Every shard is fitted in a task of its own rows; centres stay a table, offsets count as broadcast."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 30_000)
    x = np.eye(2)[y] * 4 + rng.normal(size=(30_000, 2))
    monkeypatch.setattr(sweep, "TASK_BUDGET", 10_000)
    fit = sweep.fit_shards(frame(spark, x, y, 4), 10_000, lambdas=[1.0])
    plan = fit.weights()._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Generate" not in plan
    assert plan.count("Exchange") == 2  # one is that of the frame
    scorer = fit.scorer(average=True)
    assert scorer.centres.columns == ["fold", "centre"] and scorer.centres.count() == 10_000
    # two classes of 2 + 10 000 numbers each exceed this budget, so each is a pass of its own
    small = score.Scorer(fit.df, scorer.weights, [0], fit.classes, 2, folds=fit.folds, centres=scorer.centres, budget=170_000)
    assert len(scorer.passes) == 1 and len(small.passes) == 2
    rows = scorer.hits().agg(F.sum("hits"), F.sum("rows")).first()
    assert rows[1] == 10_000 and rows[0] > 6_000


@pytest.mark.parametrize("center", ["all", "train", "none"])
@pytest.mark.parametrize("stable", [False, True])
def test_shards_fitted_in_place(spark, monkeypatch, center, stable):
    x, y = separable(101)
    options = dict(lambdas=LAMBDAS, center=center, reg_scale="n", stable=stable)
    apart = weight_rows(sweep.fit_shards(frame(spark, x, y), 4, **options).weights().where("fold = 2"))
    monkeypatch.setattr(sweep, "TASK_BUDGET", 1)
    fit = sweep.fit_shards(frame(spark, x, y), 4, **options)
    assert fit.moments is None
    found = weight_rows(fit.weights().where("fold = 2"))
    assert found.keys() == apart.keys() and all(np.allclose(found[k], apart[k]) for k in apart)


@pytest.mark.parametrize("budget", [10**9, 16 * 6 * 3, 16 * 6 * 2, 1])
def test_weights_in_several_passes(spark, budget):
    x, y = separable()
    fit = sweep.fit_single(frame(spark, x, y), lambdas=LAMBDAS)
    whole = fit.scorer()
    parts = score.Scorer(
        fit.df.where(fit.validation),
        fit.weights(),
        [0, 1, 2],
        fit.classes,
        fit.width,
        folds=fit.folds,
        segment=fit.segment,
        budget=budget,
    )
    keys = ["fold", "lambda_id", "row_id"]
    ours = parts.predictions().orderBy(*keys).collect()
    theirs = whole.predictions().orderBy(*keys).collect()
    assert [r[:5] for r in ours] == [r[:5] for r in theirs]
    assert parts.hits().orderBy("lambda_id").collect() == whole.hits().orderBy("lambda_id").collect()


@pytest.mark.parametrize("run", ["sweep", "shards", "sizes"])
def test_number_of_passes_over_the_rows(spark, run):
    """Count, first row, moments, scores: whatever the number of lambdas, classes, shards or sizes."""
    x, y = separable(200)
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = frame(spark, x, y).mapInArrow(watch, "row_id long, label int, features array<double>")
    if run == "sweep":
        sweep.ridge_sweep(rows).collect()
    elif run == "shards":
        sweep.ridge_sweep_sharded(rows, 5).collect()
    else:
        sweep.size_sweep(rows, [50, 100, 150, 200]).collect()
    assert seen.value <= 4 * 200


def test_best_lambda_prefers_the_first_on_a_tie(spark):
    rows = [(0, 0.01, 0.5), (1, 0.1, 0.9), (2, 10.0, 0.9), (3, 20.0, None)]
    df = spark.createDataFrame(rows, "lambda_id int, lambda double, accuracy double")
    assert score.best_lambda(df).first()["lambda"] == 0.1


def test_best_lambda_per_key(spark):
    rows = [("a", 0, 0.1, 0.5), ("a", 1, 1.0, 0.5), ("b", 0, 0.1, 0.2), ("b", 1, 1.0, 0.3), ("c", 0, 0.1, None)]
    df = spark.createDataFrame(rows, "k string, lambda_id int, lambda double, accuracy double")
    found = {r["k"]: (r["lambda"], r["accuracy"]) for r in score.best_lambda(df, "k").collect()}
    assert found == {"a": (0.1, 0.5), "b": (1.0, 0.3), "c": (0.1, None)}


def test_default_sizes(spark):
    x, y = separable(1500, d=2)
    found = sweep.size_sweep(frame(spark, x, y), lambdas=[1.0]).collect()
    assert [r["n"] for r in found] == [1000]


def test_checkpoint_folder():
    class Context:
        folder = None

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, folder=None):
            self.sparkContext, self.folder, self.conf = Context(master), folder, self

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.folder or default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session("yarn"))
    for session in (Session("yarn", "hdfs:///shared"), Session("local[2]", "hdfs:///shared")):
        ensure_checkpoint_dir(session)
        assert session.sparkContext.folder == "hdfs:///shared"
    local = Session("local[2]")
    ensure_checkpoint_dir(local)
    assert local.sparkContext.folder


def test_bad_vectors_are_errors(spark):
    good = "row_id long, label int, features array<double>"
    for rows in (
        [(0, 0, [1.0, 2.0]), (1, 1, [1.0])],
        [(0, 0, [1.0, 2.0]), (1, 1, None)],
        [(0, 0, [1.0, 2.0]), (1, 1, [1.0, None])],
        [(0, 0, [1.0, 2.0]), (1, None, [1.0, 1.0])],
    ):
        with pytest.raises(Exception, match="null|length"):
            moments.class_moments(spark.createDataFrame(rows, good).coalesce(1)).collect()


def test_published_accuracies_of_the_test_vectors(spark):
    columns = sweep.Columns("vec_id", "label", "embedding")
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = [round(a, 6) for a in accuracies(sweep.ridge_sweep(rows, columns=columns, drop_last=True))]
    assert found == [0.131313] * 4 + [0.121212, 0.090909, 0.10101] + [0.090909] * 3
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = [round(a, 6) for a in accuracies(sweep.ridge_sweep(rows, columns=columns))]
    assert found == [0.0875] * 5 + [0.085, 0.0875, 0.085, 0.0875, 0.0875]


def test_lambda_grid():
    grid = log_spaced()
    assert np.allclose(grid, 10 ** np.linspace(-5, 5, 10), rtol=1e-14) and len(grid) == 10
    assert log_spaced(2, 3, 1) == [100.0]
