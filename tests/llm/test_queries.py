import pytest

import __spark_entry__ as entry
from idweave.llm.queries import ORACLE, REGISTRY
from idweave.plans.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_the_queries_and_the_pipeline_are_registered():
    found = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(found)
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(REGISTRY[name](spark, SF), duck(SF), ORACLE[name])
    assert r["rows"][0] == r["rows"][1] and r["cols_equal"] and r["hash_equal"], r
