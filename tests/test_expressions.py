import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeworks.functions import clock, pixels, vectors
from ridgeworks.operators import matrix
from ridgeworks.plans import hourly, reports


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_binarise(spark):
    assert one(spark, vectors.binarise(F.array(*map(F.lit, [0.49, 0.5, 0.51])))) == [0.0, 0.5, 1.0]
    scaled = vectors.scale_bytes(F.array(*map(F.lit, [0, 127, 128, 255])))
    assert one(spark, vectors.binarise(scaled)) == [0.0, 0.0, 1.0, 1.0]


def test_argmax_and_sign(spark):
    nan = float("nan")
    for scores, place in [([1, 3, 3], 1), ([0, 0], 0), ([1, nan, 3, nan], 1)]:
        assert one(spark, vectors.argmax_position(F.array(*[F.lit(float(s)) for s in scores]))) == place
    for value, two_way, three_way in [(2.0, 1, 1), (0.0, -1, 0), (-3.0, -1, -1)]:
        assert one(spark, vectors.sign_decision(F.lit(value))) == two_way
        assert one(spark, vectors.sign_decision(F.lit(value), zero=0)) == three_way


def test_dot_and_flatten(spark):
    a, b = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(0.5))
    assert one(spark, vectors.dot(a, b)) == 4.0
    six = F.array(*map(F.lit, range(6)))
    assert one(spark, vectors.fold_rows(six, 3)) == [[0, 1, 2], [3, 4, 5]]
    assert one(spark, vectors.flatten_rows(vectors.fold_rows(six, 3))) == list(range(6))


def test_ramp_keeps_its_shape(spark):
    r, c = np.mgrid[0:120, 0:180]
    small = pixels.resample((r + c).astype(float)[None], 40, 60)[0]
    i, j = np.mgrid[0:40, 0:60]
    assert np.allclose(small, 119 * i / 39 + 179 * j / 59)
    assert small[0, 0] == 0 and small[-1, -1] == 119 + 179
    values = F.array(*[F.lit(float(v)) for v in range(6)])
    assert one(spark, pixels.downsample(values, (2, 3), (2, 2))) == [0.0, 2.0, 3.0, 5.0]


def test_channel_of_uneven_images(spark):
    rows = [(b"\x01\x02\x03\x04\x05\x06", 3, 2), (b"\x07\x08", 1, 0), (b"", 3, 2), (b"\x01\x02\x03\xff", 3, 0)]
    df = spark.createDataFrame(rows, "data binary, channels int, layer int").coalesce(1)
    chosen = df.select(pixels.select_channel(F.col("data"), F.col("channels"), F.col("layer")).alias("v"))
    assert [r["v"] for r in chosen.collect()] == [[3, 6], [7, 8], [], [1]]


@pytest.mark.parametrize("shape", [(3, 4, 5), (130, 70, 129), (1, 1, 1)])
def test_matrix_product_of_any_shape(spark, shape):
    m, k, n = shape
    rng = np.random.default_rng(0)
    a, b = rng.integers(-5, 5, (m, k)), rng.integers(-5, 5, (k, n))

    def table(x):
        cells = [(i, j, float(x[i, j])) for i in range(x.shape[0]) for j in range(x.shape[1])]
        return spark.createDataFrame(cells, "i long, j long, v double")

    for size in (2, 128) if m < 10 else (64,):
        cells = matrix.matmul_blocks(table(a), table(b), size=size).collect()
        product = np.zeros((m, n))
        for r in cells:
            product[r["i"], r["j"]] = r["v"]
        assert len(cells) == m * n and (product == a @ b).all()
    sparse = matrix.matmul_cells(table(a), table(b)).collect()
    assert {(r["i"], r["j"]): r["v"] for r in sparse} == {
        (i, j): (a @ b)[i, j] for i in range(m) for j in range(n)
    }


def test_matrix_sizes_must_fit(spark):
    one_cell = spark.createDataFrame([(0, 0, 1.0)], "i long, j long, v double")
    with pytest.raises(ValueError, match="inner sizes"):
        matrix.matmul_blocks(one_cell, one_cell, (1, 2), (1, 1))


def test_dates(spark):
    day_first = [("12/03/14", "2014-03-12"), ("12/03/2014", "2014-03-12"), ("1/1/2014", "2014-01-01")]
    day_first += [("31/12/99", "1999-12-31"), ("31/12/68", "2068-12-31"), ("soon", None), (None, None)]
    for text, expected in day_first:
        assert one(spark, clock.iso_date(clock.day_first_date(F.lit(text)))) == expected
    for text, expected in [("12/03/14", "2014-12-03"), ("2/29/16", "2016-02-29"), ("13/1/14", None)]:
        assert one(spark, clock.iso_date(clock.month_first_date(F.lit(text)))) == expected


def test_hours_and_sentinels(spark):
    for text, expected in [("13:00", 13), ("1:30", 1), ("ab:00", None), ("", None)]:
        assert one(spark, clock.hour_of(F.lit(text))) == expected
    for text, expected in [("NoData", None), ("-999", None), ("12.5", 12.5), (None, None)]:
        assert one(spark, clock.without_sentinel(F.lit(text))) == expected


def test_hour_skeleton(spark):
    span = spark.createDataFrame([("2015-10-01", "2015-11-30")], "a string, b string")
    rows = hourly.hour_skeleton(span, "a", "b")
    assert rows.count() == 1464 and rows.distinct().count() == 1464


# fixed values, measured timings: thread, parallel, overhead, total
THREADS = [
    (1, 77.01753544807434, 11.55333495140075, 88.5874831676483),
    (2, 39.92824554443359, 12.86628627777099, 52.8112025260925),
    (4, 20.61007261276245, 13.03828358650207, 33.6653475761413),
    (8, 19.19526314735412, 16.36505699157715, 35.5772066116333),
]
SIZES = [
    (500, 7.015),
    (1000, 9.045),
    (2000, 13.056),
    (4000, 20.912),
    (8000, 37.081),
    (16000, 69.404),
    (32000, 133.945),
]


def test_scaling_report_of_measured_runs(spark):
    runs = spark.createDataFrame(THREADS, "threads int, parallel_s double, overhead_s double, total_s double")
    runs = runs.withColumn("config", F.lit("one node"))
    report = reports.scaling_report(runs, times=("parallel_s", "total_s")).orderBy("threads").collect()
    for column, expected in {
        "speedup_parallel_s": [1, 1.9289, 3.7369, 4.0123],
        "efficiency_parallel_s": [1, 0.9644, 0.9342, 0.5015],
        "speedup_total_s": [1, 1.6774, 2.6314, 2.4900],
        "efficiency_total_s": [1, 0.8387, 0.6579, 0.3113],
    }.items():
        assert [r[column] for r in report] == pytest.approx(expected, abs=5e-5)
    wide = matrix.transpose_table(runs, ["config"], "threads", ["parallel_s", "total_s"], [1, 2, 4, 8])
    rows = {r["metric"]: [r["1"], r["2"], r["4"], r["8"]] for r in wide.collect()}
    assert rows["total_s"] == [t[3] for t in THREADS] and rows["parallel_s"] == [t[1] for t in THREADS]


def test_scaling_report_with_most_runs_in_one_configuration(spark):
    runs = [("hot", 1 + i % 3, 10.0 / (1 + i % 3) + i / 1000) for i in range(900)]
    runs += [("cold", 2, 8.0), ("cold", 4, 4.0), ("zero", 1, 0.0)]
    df = spark.createDataFrame(runs, "config string, threads int, elapsed_s double").repartition(5)
    report = reports.scaling_report(df)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    found = {(r["config"], r["threads"]): (r["speedup"], r["efficiency"]) for r in report.collect()}
    slowest = {t: max(e for c, n, e in runs if c == "hot" and n == t) for t in (1, 2, 3)}
    for t in (1, 2, 3):
        assert found["hot", t] == pytest.approx((slowest[1] / slowest[t], slowest[1] / slowest[t] / t))
    assert found["cold", 4] == (2.0, 1.0) and found["zero", 1] == (None, None)
    most = {r["config"]: r["elapsed_s"] for r in reports.max_elapsed(df, "config").collect()}
    assert most == {"hot": slowest[1], "cold": 8.0, "zero": 0.0}


def test_scaling_law_of_measured_runs(spark):
    runs = spark.createDataFrame([("serial", *row) for row in SIZES], "config string, n int, elapsed_s double")
    fit = reports.scaling_law(runs, fixed=5.0).first()
    assert fit["slope"] == pytest.approx(0.00403033, abs=1e-8)
    assert fit["intercept"] == pytest.approx(4.93313, abs=1e-5)
    assert fit["exponent"] == pytest.approx(0.999248, abs=1e-6)


def test_cost_model(spark):
    row = (8000, 784, 10, 10, 1999, 2.0, 0.5)
    runs = spark.createDataFrame(
        [row], "n int, d int, k int, n_lambda int, v int, parallel_s double, overhead_s double"
    )
    result = reports.cost_model(runs).first()
    assert result["operations"] == 100_349_177_600 and result["node_s"] == 2.5
    extra = {"gamma": F.lit(1.5), "ranks": F.lit(4), "cluster_overhead_s": F.lit(0.75)}
    ranks = runs.withColumns(extra)
    assert reports.cost_model(ranks).first()["cluster_s"] == 1.5 * 10 / 4 * 2.5 + 0.75
