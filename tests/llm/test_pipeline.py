import collections
import re

import pytest

import corpus_pipeline
from idweave.llm import mixing

from . import test_decontaminate, test_line_dedup, test_minhash
from .conftest import DOCS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and output of every stage on the small tables."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        before, docs = docs, spark.read.parquet(str(root / name))
        out[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()], docs.columns)
    return out


def test_columns_and_rows_follow_the_input(stages):
    names = [n.split()[0] for n in DOCS.split(", ")]
    for name, (before, after, columns) in stages.items():
        if name != "mixing":
            assert columns == names
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}


def test_quality_keeps_good_documents(spark, stages):
    before, after, _ = stages["quality"]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    good = [r["doc_id"] for r in before if label.get(r["doc_id"]) == 1]
    bad = [r["doc_id"] for r in before if label.get(r["doc_id"]) == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d in bad) <= 0.2 * len(bad)
    assert all(r in before for r in after)


def test_line_dedup_by_brute_force(stages):
    before, after, _ = stages["line_dedup"]
    want = [(d, t) for (d, o, t) in test_line_dedup.brute([(r["doc_id"], r["text"]) for r in before], 2)
            if not (o and o.strip() and t is not None and not t.strip())]
    assert sorted((r["doc_id"], r["text"]) for r in after) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_duplicates_by_brute_force(stages):
    before, after, _ = stages["near_duplicates"]
    rows = test_minhash.brute([(r["doc_id"], r["text"]) for r in before])
    want = {int(re.match(r"\((\d+)", x)[1]) for x in rows if x.endswith("True)")}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_decontamination_by_brute_force(spark, stages):
    before, after, _ = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(w[k:k + 13]) for w in (test_decontaminate.words(t) for _, t in items) for k in range(len(w) - 12)}
    near = collections.defaultdict(list)
    for g in grams:  # two substitutions leave one of three parts as it was
        for part in (0, 4, 8):
            near[part, g[part:part + 4]].append(g)

    def hit(text):
        w = test_decontaminate.words(text)
        for k in range(len(w) - 12):
            for part in (0, 4, 8):
                for g in near.get((part, tuple(w[k + part:k + part + 4])), ()):
                    if sum(a == b for a, b in zip(w[k:k + 13], g)) >= 11:
                        return True
        return False

    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if not hit(r["text"]))


def test_mixing_emits_copies(spark, stages):
    before, after, _ = stages["mixing"]
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(spark.createDataFrame(
        [tuple(r.values()) for r in before], DOCS)).collect()}
    assert collections.Counter(r["doc_id"] for r in after) == collections.Counter(
        {d: n for d, n in plan.items() if n})


def test_run_gives_the_stages_result(spark, stages):
    out = corpus_pipeline.run(spark, SF).select("doc_id", "copy", "taken").collect()
    assert sorted(tuple(r) for r in out) == sorted((r["doc_id"], r["copy"], r["taken"]) for r in stages["mixing"][1])


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3),
            (3, "x " * 50000, "en", "s", 100000), (4, "line one is here\nline two is there", "en", "t", 35),
            (5, "line one is here\nline two is there", "en", "t", 35)]
    for docs in (spark.createDataFrame([r + (1, 2) for r in rows], DOCS + ", th long, size string"),
                 spark.createDataFrame([], DOCS)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count() * 3
