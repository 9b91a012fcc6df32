"""Every query against its SQL, and the shape of every plan."""

import pytest

from tallyfield.catalog import oracle_texts, query_functions
from tests.oracle import compare, connect

SQL = oracle_texts()
QUERIES = query_functions()
# Queries that fit models; test_learning.py covers what they are made of.
SLOW = {
    "tune_linear_models",
    "tune_tree_models",
    "compare_samplings",
    "binary_classification",
    "recommendation_metrics",
    "als_compare_for_users",
    "als_recommend_unseen",
    "train_svm",
    "train_gbt",
}


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, db, name):
    df = QUERIES[name](spark, folder)
    assert compare(df, db, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_runs(spark, folder, name):
    df = QUERIES[name](spark, folder)
    # Trimming to a fixed point may leave nothing of a table this small.
    assert df.count() > 0 or name == "trim_sparse_to_fixed_point"


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry_points

    df = entry_points.entry(spark)
    assert df.columns[:2] == ["country_code", "year"]
    assert df.count() > 0
