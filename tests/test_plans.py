"""Plan-level guards: no pair explosion, filters and column pruning reach the scans."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from tidewatch.plans.catalog import REGISTRY

SMOKE = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SMOKE)) for name, fn in entry.queries().items() if name in REGISTRY}


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_year_filter_reaches_the_scan(plans):
    text = plans["element_series_year"]
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_flagship_scan_is_column_pruned(plans):
    schemas = [l for l in plans["combine_weekly"].splitlines() if l.startswith("ReadSchema") and "l_shipdate" in l]
    assert schemas
    for s in schemas:
        for unused in ("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"):
            assert unused not in s


def test_no_row_at_a_time_python_udfs(plans):
    for name, text in plans.items():
        assert "BatchEvalPython" not in text, name


@pytest.mark.parametrize("name", ["combine_weekly", "combine_nearest"])
def test_weekly_panels_aggregate_by_hash(spark, name):
    plan = REGISTRY[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
