"""Every registered query against its DuckDB oracle (sf0.001), and plan
checks: no Python in any plan, no nested-loop or cartesian joins, filters
pushed to the scans, no window in the latest view."""

import pytest

import __spark_entry__ as E
from idweave.plans.compare import compare, duck

from conftest import SF_SMALL

from idweave.plans.oracle import oracle_sql
from idweave.plans.queries import REGISTRY as QUERIES, STORED

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_planning_runs_no_job(spark):
    """No query of the reference's operators computes anything while it is
    being built, but those over stored tables, which write them."""
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(QUERIES) - STORED):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        QUERIES[name](spark, SF_SMALL)
        # reading a Parquet footer for its schema is the one job there may be
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"plan-{name}")]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        assert all(s is None or s.name.startswith("parquet") for s in stages), (name, [s.name for s in stages if s])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["rows"][0] == r["rows"][1], r
    assert r["cols_equal"], r
    assert r["hash_equal"], r


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_nested_loops(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "BroadcastNestedLoopJoin",
                "CartesianProduct"):
        assert bad not in plan, (name, bad)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert "PERSON_ID" in df.columns


def test_latest_plan_is_aggregate_and_semi_join(spark):
    plan = _plan(QUERIES["q_latest"](spark, SF_SMALL))
    assert "Window" not in plan and "LeftSemi" in plan


def test_snapshot_filter_pushed_to_scan(spark):
    from idweave.sources.fixtures import Fixtures
    plan = Fixtures(spark, SF_SMALL).match(2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_person_history_filters_below_the_aggregates(spark):
    lines = _plan(QUERIES["q_person_history"](spark, SF_SMALL)).split("== Initial Plan ==")[0].splitlines()
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "o_custkey" in x]
    assert scans
    for i in scans:
        above = next(x for x in lines[i - 1::-1] if "Filter" in x or "Aggregate" in x)
        assert "Filter" in above and "T10" in above
