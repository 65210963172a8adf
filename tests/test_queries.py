"""Every registered query against its SQL counterpart, and rules every plan must keep."""

import pytest

from corpusflow.plans import all_queries
from oracle import compare, connection

BASE = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connection(BASE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message, _, _ = compare(spark, con, BASE, name, QUERIES[name], ORACLES.get(name))
    assert ok, message


# Running one of these executes a stream or writes files, so its plan is only the final read.
PLANNED = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in (
    "src_md_dir", "src_recursive_files", "reset_rebuild", "write_by_date"))


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(e.entry(spark).columns) == {"dst_id", "url"}


def _plan(spark, name):
    return QUERIES[name](spark, BASE)._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(lang)" in _plan(spark, "find_filter") or "GreaterThanOrEqual(n_chars,500)" in _plan(spark, "find_filter")
    plan = _plan(spark, "scan_projected")
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan and "StringStartsWith(url,https)" in plan


def test_top_k_is_pruned_before_the_shuffle(spark):
    assert "WindowGroupLimit [queue" in _plan(spark, "queue_peek") and "Partial" in _plan(spark, "queue_peek")
    assert "TakeOrderedAndProject" in _plan(spark, "paginate")
