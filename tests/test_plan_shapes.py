"""Physical plans: what must, and must not, be in them."""

import os

import pytest

from labtide.catalog import QUERIES
from labtide.catalog.registry import MODULES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


# Those of the other modules run when they are called; their plans only read what was written.
PLANNED = sorted(q for q in QUERIES if MODULES[q] not in ("run_queries", "file_queries", "io_queries"))


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    text = plan(spark, name)
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = "\n".join(lines[i + 1 : i + 6])
            assert "SinglePartition" not in below, line


def test_time_bounds_reach_the_scan(spark):
    text = plan(spark, "user_events_of_day")
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_status_and_columns_reach_the_scan(spark):
    text = plan(spark, "zip_repair")
    assert "ReadSchema: struct<c_custkey:bigint>" in text


@pytest.mark.parametrize("name", ["last_event_per_report", "first_event_per_type"])
def test_one_row_per_key_is_cut_before_the_exchange(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") == 2


def test_funnel_is_hash_aggregated(spark):
    text = plan(spark, "event_funnel_by_day")
    assert "partial_min" in text and "SortAggregate" not in text
