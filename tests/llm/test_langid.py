import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import langid

from .conftest import DOCS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    texts = sorted((rng.normal(0, 9, (n, 3)).astype(np.float32) for n in (1, 2, 4, 6, 6, 7)), key=lambda t: -len(t))
    for t, got in zip(texts, langid.viterbi(texts)):
        cost = lambda p: sum(t[i, x] for i, x in enumerate(p)) - langid.SWITCH * sum(
            a != b for a, b in zip(p, p[1:]))
        best = max(cost(p) for p in itertools.product(range(3), repeat=len(t)))
        assert cost(list(got)) == pytest.approx(best, abs=1e-3)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs, model).where("held_out").collect()
    assert len(rows) > 250
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.lang: " ".join(r.text.split()[:40]) for r in docs.where("n_chars > 800").collect()}
    (lang, score, spans), = model.label([text["fr"] + " " + text["de"]])
    assert [s[0] for s in spans] == ["fr", "de"]
    assert abs(spans[1][1] - spans[0][2]) == 0 and 0.3 < score < 0.8


def test_scripts_narrow_the_candidates(spark, frame):
    rows = [(i, t, l, "s", 0) for i, (t, l) in enumerate(
        [("это просто русский текст", "ru"), ("ce texte est en français", "fr"), ("αυτό είναι ένα κείμενο", "el")] * 40)]
    m = langid.fit(spark.createDataFrame(rows, DOCS))
    got = m.label(["да", "και", "oui", "да и non monsieur le président", "漢字", "123 ... !", "", None])
    assert [g[0] for g in got[:4]] == ["ru", "el", "fr", "fr"]
    assert got[4][0] in ("ru", "el", "fr") and [g[0] for g in got[5:]] == ["und"] * 3


def test_defined_cases(spark, model, frame):
    docs = frame([(1, None), (2, ""), (3, "12 3"), (4, "the and of " * 20000), (5, "the one"), (5, "the one"),
                  (None, "the")]).withColumn("score", F.lit("x")).withColumn("spans", F.lit(1))
    out = langid.identify(docs, model).collect()
    assert [r.lang_pred for r in sorted(out, key=lambda r: (r.doc_id is None, r.doc_id))] == [
        "und"] * 3 + ["en"] * 4
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    empty = spark.createDataFrame([], DOCS)
    assert langid.identify(empty, model).count() == 0
    assert langid.fit(empty).label(["abc"])[0][0] == "und"


def test_lang_is_no_input(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    a = langid.identify(docs, model).select("doc_id", "lang_pred", "score").collect()
    b = langid.identify(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), model).select(
        "doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)
