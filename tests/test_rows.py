"""Row numbers that would lose rows are errors; only validation rows are scored."""

import pytest
from pyspark.sql import functions as F

from ridgeworks.operators.score import linear_scores
from ridgeworks.operators.splits import positional_split
from ridgeworks.plans import reports, sweep
from ridgeworks.sources.images import class_of
from ridgeworks.sources.tables import parse_log


def rows(spark, ids):
    data = [(i, i % 2, [float(i % 3), float(i % 5)]) for i in ids]
    return spark.createDataFrame(data, "row_id long, label int, features array<double>")


@pytest.mark.parametrize("ids", [range(0, 50, 10), range(1, 11), [*range(9), 12]])
def test_row_numbers_with_gaps_are_errors(spark, ids):
    df = rows(spark, ids)
    for job in (positional_split, sweep.ridge_sweep, lambda x: sweep.fit_shards(x, 2), sweep.size_sweep):
        with pytest.raises(ValueError, match="without gaps"):
            job(df)


def test_no_default_size_fits(spark):
    found = sweep.size_sweep(rows(spark, range(20)))
    assert found.count() == 0 and found.columns == ["n", "lambda_id", "lambda", "accuracy"]


def test_only_validation_rows_are_scored(spark, tmp_path):
    rows(spark, range(40)).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    for fit in (sweep.fit_shards(df, 4), sweep.fit_single(df)):
        scored = df.where(fit.validation)
        assert scored.count() == 8
        plan = fit.scorer().hits()._jdf.queryExecution().executedPlan().toString()
        assert "Filter" in plan.split("MapInArrow")[-1]


def test_ids_of_any_type(spark):
    df = rows(spark, range(4)).withColumn("row_id", F.concat(F.lit("file-"), "row_id"))
    weights = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "label int, weights array<double>")
    found = {x.row_id: x.scores for x in linear_scores(df, weights).collect()}
    assert found["file-2"] == [2.0, 2.0] and len(found) == 4


def test_label_is_that_of_the_last_directory(spark):
    paths = ["/class_9/backup/class_2/x.png", "/a/subclass_3/x.png", "class_4/y.png", "/class_5/deep/y.png"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [x[0] for x in df.select(class_of(F.col("p"))).collect()] == [2, None, 4, None]


def test_blank_lines_of_any_kind(spark):
    lines = spark.createDataFrame([("\t",), (" \t ",), ("",), ("\t1/1/2014 01:00",)], "value string")
    assert [x.date for x in parse_log(lines).collect()] == ["1/1/2014"]


def test_cost_of_very_large_runs(spark):
    runs = spark.createDataFrame(
        [(10**12, 784, 10, 10, 10**11, 1.0, 1.0)],
        "n long, d long, k long, n_lambda long, v long, parallel_s double, overhead_s double",
    )
    n, d, k, v = 10**12, 784, 10, 10**11
    assert int(reports.cost_model(runs).first()["operations"]) == 20 * (n * d * d + k * d * (d + n + 2 * v))
