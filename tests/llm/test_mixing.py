import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from idweave.llm import mixing

from .conftest import DOCS


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare step by step until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over


@pytest.mark.parametrize("n", [1, 2, 7, 23])
def test_targets_are_the_fixed_point(spark, n):
    sizes = {f"s{i:02d}": (i * 7919) % 997 + 1 for i in range(n)} | {None: 40, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def rows(n=3000):
    out = []
    for i in range(n):
        source = None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 7}"
        out.append((i, " ".join(["w"] * (i * 31 % 97)), "en", source, 0))
    return out


def test_taken_words_meet_the_targets(spark):
    plan = mixing.mix_plan(spark.createDataFrame(rows(), DOCS)).cache()
    assert plan.count() == 3000
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"),
                                        F.max("source_size").alias("s")).collect():
        assert abs(r.t - r.g) < 0.03 * r.g + 200
    assert plan.where("taken > 3 * size").count() == 0
    rate = F.col("target") / F.col("source_size")
    assert plan.where((F.col("copies") < F.floor(rate)) | (F.col("copies") > F.ceil(rate))).count() == 0


def test_reruns_and_partitionings_agree(spark):
    docs = spark.createDataFrame(rows(500), DOCS)
    one = mixing.mix_plan(docs.repartition(7)).select("doc_id", "copies").collect()
    two = mixing.mix_plan(docs.orderBy(F.desc("doc_id"))).select("doc_id", "copies").collect()
    assert sorted(one) == sorted(two)


def test_emits_the_copies(spark):
    docs = spark.createDataFrame(rows(400), DOCS)
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    out = collections.Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert out == collections.Counter({k: v for k, v in plan.items() if v})


def test_defined_cases(spark):
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 1),
           (None, "a b", "en", "s", 1), (4, "", None, "t", 0), (5, "x " * 60000, "en", "s", 1)]
    got = mixing.mix_plan(spark.createDataFrame([r + (9, 8, 7, 6) for r in odd],
                                                DOCS + ", size long, _extra long, rate long, level long")).collect()
    assert len(got) == 6
    assert sorted((r.doc_id is None, r.doc_id, r["size"]) for r in got if r.doc_id) == [
        (False, 1, 0), (False, 1, 0), (False, 4, 0), (False, 5, 60000)]
    assert sum(r.taken for r in got if r.source == "t" or r.source is None) == 0
    assert (got[0]._extra, got[0].rate, got[0].level) == (8, 7, 6)
    assert mixing.mix_plan(spark.createDataFrame([], DOCS)).count() == 0


def test_against_sql(spark, tmp_path):
    docs = spark.createDataFrame(rows(900), DOCS)
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    sql = mixing.MIX_SQL.format(documents=f"read_parquet('{tmp_path}/d/*.parquet')",
                                columns="doc_id, size, target, copies")
    want = {r[0]: (r[1], r[3]) for r in duckdb.sql(sql).fetchall()}
    got = {r.doc_id: (r["size"], r.copies) for r in mixing.mix_plan(docs).collect()}
    assert got == want
