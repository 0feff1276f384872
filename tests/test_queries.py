"""Every registered query: agreement with SQL, and a plan without cross products."""

import numpy as np
import pytest

import __spark_entry__ as entry
from catalog import ORACLES, QUERIES
from ridgeworks.functions.vectors import log_spaced
from tests import brute
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, small, name):
    sql = ORACLES[name]
    assert differences(spark, duck, QUERIES[name], sql, small) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_product(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_equals_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    y = np.array([r["label"] for r in rows])
    found = [r["accuracy"] for r in entry.entry(spark).orderBy("lambda_id").collect()]
    assert found == pytest.approx(brute.sweep(x, y, log_spaced()))
