import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import toxicity

from .conftest import DOCS

BAD = ["hatefulness", "worthlessly", "despicable", "vermin"]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "ten", "sor", "ku"]) for _ in range(rng.randrange(1, 5)))
    texts, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(5, 200))]
        y = int(i % 5 == 0)
        for _ in range(rng.randrange(2, 5) if y else 0):
            w[rng.randrange(len(w))] = rng.choice(BAD)
        texts.append(" ".join(w))
        labels.append(y)
    return texts, np.array(labels, float)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*corpus())


def test_held_out_documents(model):
    texts, labels = corpus(300, seed=2)
    found = np.array([model.score(t) for t in texts]) >= 0.7
    assert found[labels == 1].mean() > 0.9 and found[labels == 0].mean() < 0.02


def test_unseen_misspellings_and_long_texts(model):
    filler = "balo miten sorku lo ba mimi " * 3
    for w in ("hatefulnes", "despiccable", "worthlesslyy"):
        assert w not in BAD
        assert model.score(f"{filler}{w} ku {w} {filler}") > model.score(filler * 2) + 0.3
    assert model.score("balo miten sorku " * 3000 + " hatefulness vermin despicable vermin") > 0.5


def test_grams_by_brute_force():
    text = "Ab, cde  É𐐷f g1 " * 4
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    want = sum(max(0, len(w) + 2 - n + 1) for w in words for n in toxicity.GRAMS if len(w) + 2 >= n)
    bucket, where, passages = toxicity.grams(text)
    assert len(bucket) == want and passages == -(-len(words) // toxicity.PASSAGE)
    assert where.max() == passages - 1 and where.min() == 0
    first = toxicity.grams("ab cde")[0]
    assert set(first) <= set(bucket)
    assert [len(toxicity.grams(t)[0]) for t in (None, "", "...")] == [0, 0, 0]


def test_training_by_numbers():
    """One step moves table and softmax against a numeric gradient."""
    bag = [np.array([1, 2, 2], np.int32), np.array([3], np.int32)]
    table, soft = np.full((8, 2), 0.1), np.array([[0.2, -0.1], [0.1, 0.3], [0.0, 0.0]])
    before = (table.copy(), soft.copy())
    toxicity._train(bag, np.array([1.0, 0.0]), table, soft, np.random.default_rng(0), 1,
                    [np.zeros_like(table), np.zeros_like(soft)])

    def loss(t, s):
        z = np.array([t[b].mean(0) @ s[:-1] + s[-1] for b in bag])
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        return -(np.log(p[0, 1]) + np.log(p[1, 0])) / 2

    for which, moved in ((0, table), (1, soft)):
        for at in np.ndindex(before[which].shape):
            up = [x.copy() for x in before]
            up[which][at] += 1e-5
            slope = (loss(*up) - loss(*before)) / 1e-5
            if abs(slope) > 1e-3:
                assert np.sign(moved[at] - before[which][at]) == -np.sign(slope)


def test_query_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(70000, None, "x", "y", 0), (70001, "", "x", "y", 0), (None, "idiot", "x", "y", 0),
                                 (None, "idiot", "x", "y", 0)], DOCS)
    model = toxicity.fit(docs, labels.union(spark.createDataFrame([(1, 1, None), (None, 1, 1)], labels.schema)))
    out = toxicity.score(docs.union(odd).withColumn("score", F.lit("x")), model).collect()
    assert len(out) == docs.count() + 4
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0
    assert toxicity.fit(docs, labels.where("false")).score("x") == 0.5
