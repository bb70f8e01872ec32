"""The expected counts of FIXTURES.md §3 (sf0.001), through the registered
queries: checks the fixture derivations and the operators together,
independently of the SQL oracle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

from conftest import SF_SMALL

Q = E.queries()


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: Q[name](spark, SF_SMALL)


def test_relation_counts(run):
    got = {r.relation: r.n_rows for r in run("q_row_counts").collect()}
    assert got == {"pop_a": 150, "current_a": 139, "pop_b": 150, "coded_b": 150, "match_v1": 116, "match_v2": 149,
                   "match_v3": 144, "vendor_xwalk": 1500, "geo": 10, "blocks": 120, "id_res": 116, "id_res_b": 127}


def test_history_counts(run):
    assert run("q_initial_history").count() == 116
    assert run("q_new_records_v2").count() == 34
    assert run("q_changed_records_v3").count() == 112
    assert run("q_advance_delta_v3").count() == 112
    assert run("q_history_after_v3").count() == 369
    assert run("q_latest").count() == 150
    assert run("q_stale_after_reversion").count() == 16
    assert run("q_snapshot_members").count() == 367
    assert run("q_respondent_history").count() == 366


def test_link_and_audit_counts(run):
    assert run("q_link_non_email").count() == 540
    assert run("q_link_email_only").count() == 9
    assert run("q_pairs_clean").count() == 282
    assert run("q_missing_from_population").count() == 12
    assert run("q_missing_from_pairs").count() == 0
    assert run("q_duplicate_keys").count() == 153
    idr = run("q_id_resolution")
    assert idr.count() == 150 and idr.where(F.col("RESP_ID").isNull()).count() == 34
    assert run("q_fips_concat").where(F.col("FIPS").isNull()).count() == 25
    r = run("q_match_rate_a").collect()[0]
    assert (r.unique_ids, r.missing_from_population, r.missing_from_crosswalk) == (151, 12, 0)


def test_vendor_match_residual_and_rank(run):
    assert run("q_vendor_match").count() == 192
    assert run("q_vendor_match_previous").count() == 226
    assert run("q_everyone").count() == 300
    assert run("q_residual_population").count() == 69
    dist = {r.ATTRIBUTE_COUNT: r["count"] for r in
            run("q_attribute_count").groupBy("ATTRIBUTE_COUNT").count().collect()}
    assert [dist.get(i, 0) for i in range(5)] == [2, 12, 28, 20, 7]
    ranks = {r.DENSE_RANK: r["count"] for r in
             run("q_rank_completeness").groupBy("DENSE_RANK").count().collect()}
    assert [ranks.get(i, 0) for i in range(1, 6)] == [58, 5, 2, 3, 1]
