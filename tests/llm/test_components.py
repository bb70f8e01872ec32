import random

import pytest

from idweave.llm.common import Scratch
from idweave.llm.components import components


def brute(links):
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            up[top(a)] = top(b)
    groups = {}
    for i in up:
        groups.setdefault(top(i), set()).add(i)
    return sorted(map(sorted, groups.values()))


def run(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    groups = {}
    for r in components(df, Scratch(spark, "test")).collect():
        groups.setdefault(r.component, set()).add(r.node)
    assert all(c in g for c, g in groups.items())
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("shape", ["random", "path", "star"])
def test_against_union_find(spark, shape):
    rng = random.Random(1)
    links = {"random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)],
             "path": [(i, i + 1) for i in range(600)],
             "star": [(7, i) for i in range(300)] + [(1000 + i, 2000) for i in range(50)]}[shape]
    links += [(None, 1), (3, None), (5, 5), links[0]]
    assert run(spark, links) == brute(links)


def test_no_links(spark):
    assert run(spark, []) == []


def test_a_path_shrinks_by_a_factor(spark):
    scratch = Scratch(spark, "rounds")
    components(spark.range(1000).selectExpr("id as a", "id + 1 as b"), scratch)
    assert scratch.count < 2 + 4 * 12   # four tables a round
