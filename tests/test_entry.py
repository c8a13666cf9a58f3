"""The registry of queries, and a sample of them against their SQL twins."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, difference
from tests.conftest import SF

SAMPLE = [
    "panel", "clean_table", "features_all", "validate_features", "cost_curve", "metrics_row",
    "calibration", "fairness", "cost_sweep", "request_validation", "accepted_batches",
    "decision_history", "drift_shifted", "standardise", "cv_folds",
]


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_returns_the_feature_table(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and len(out.columns) == 36


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, twin, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    assert difference(mine, twin.execute(entry.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", ["features_all", "clean_audit", "request_features", "fairness"])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    text = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in physical
