"""Plan checks over every registered query: no Python on the data path."""

import pytest

import __spark_entry__ as entry_module
from facetspark.plans.catalogue import QUERIES

from .conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    df = entry_module.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, f"{name}: {node}"
    assert "LocalCheckpoint" not in plan
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct"):  # no cross joins, no all-pairs
        assert node not in plan, f"{name}: {node}"


def test_scans_prune_columns(spark):
    df = entry_module.queries()["bucket4_mean"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["segment_comparison", "tag_comparison", "share_of_group", "correlations",
                                  "score_correlations"])
def test_one_scan_per_question(spark, name):
    """Overlapping segments, shares with their group totals, and several
    correlations each read their table once (a reused exchange is not a scan)."""
    plan = _final_plan(entry_module.queries()[name](spark, SF001))
    assert plan.count("FileScan") == 1, plan


def test_union_form_shares_one_scan(spark):
    """Labelled profiles of one table are united in one masked pass; the form with a scan per segment
    (``share_scan=False``) is held against it in tests/test_ingest_account.py."""
    plan = _final_plan(entry_module.queries()["segment_union"](spark, SF001))
    assert plan.count("FileScan") == 1
