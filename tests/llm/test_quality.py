import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import quality
from idweave.llm.common import ship

from .conftest import DOCS

ship(__name__)

SF = "/root/testdata/sf0.01"


class Flat:
    """Evidence that a text states itself."""

    def predict(self, x):
        return 1 / (2 + x[:, 0])


def brute(rows, model):
    """The posterior of every row by looping over sites."""
    p = [float(model.predict(np.array([quality.features(t)]))[0]) for _, t, _, _ in rows]
    hosts, paths = defaultdict(list), defaultdict(list)
    for (_, _, h, a), e in zip(rows, p):
        hosts[h].append(e)
        paths[h, a].append(e)
    n, rate = len(p), sum(p) / len(p)
    hw = quality.prior_weight(len(hosts), n, sum(len(v) ** 2 for v in hosts.values()) / n,
                              sum(len(v) * (sum(v) / len(v) - rate) ** 2 for v in hosts.values()), rate)
    within = sum(len(v) * (sum(v) / len(v) - sum(hosts[h]) / len(hosts[h])) ** 2 for (h, _), v in paths.items())
    nn = sum(sum(len(v) ** 2 for (g, _), v in paths.items() if g == h) / len(hosts[h]) for h in hosts)
    pw = quality.prior_weight(len(paths) - len(hosts) + 1, n, nn, within, rate)
    lo = lambda q: math.log(q / (1 - q))
    out = []
    for (d, _, h, a), e in zip(rows, p):
        hr = (sum(hosts[h]) - e + hw * rate) / (len(hosts[h]) - 1 + hw)
        pr = (sum(paths[h, a]) - e + pw * hr) / (len(paths[h, a]) - 1 + pw)
        out.append((d, 1 / (1 + math.exp(-(lo(e) - lo(rate) + lo(pr))))))
    return out


def test_posteriors_against_brute_force(spark):
    rows = [(i, " ".join(["w"] * (1 + (i * 7 + (i % 5) * 11) % 23)), None if i % 9 == 0 else f"s{i % 5}",
             None if i % 7 == 0 else f"l{i % 3}") for i in range(200)]
    rows += [(None, "a b", "s1", "l1"), (3, None, "lone", "x"), (3, "", "lone", "y")]
    df = spark.createDataFrame([(d, t, a, h, 0) for d, t, h, a in rows], DOCS)
    got = [(r.doc_id, r.score) for r in quality.scored(df, Flat(), F.col("source"), F.col("lang")).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(got, key=key), sorted(brute(rows, Flat()), key=key)):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1], abs=1e-9)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    model = quality.fit(docs, labels.where(fold))
    out = quality.scored(docs, model, F.col("source"), F.col("lang")).join(labels.where(~fold), "doc_id").collect()
    assert len(out) > 100
    assert sum(r.accepted == bool(r.quality) for r in out) / len(out) > 0.97
    assert sum(not r.accepted for r in out if r.quality) <= 2


def test_sparse_sites_are_shrunk(spark):
    rows = [(i, "w " * (1 + 20 * (i % 2)), "bad" if i % 2 else "good", "x") for i in range(100)]
    rows += [(200, "w " * 21, "good", "x"), (201, "w " * 21, "bad", "x"), (202, "w " * 21, "alone", "x")]
    df = spark.createDataFrame([(d, t, a, h, 0) for d, t, h, a in rows], DOCS)
    s = {r.doc_id: r.path_rate for r in quality.scored(df, Flat(), F.col("source"), F.col("lang")).collect()}
    assert s[200] > s[202] > s[201]


def test_defined_cases(spark, frame):
    docs = frame([(1, None), (2, ""), (3, "x " * 50000), (4, "good text here"), (4, "good text here"), (None, "q")])
    labels = spark.createDataFrame([(4, 1), (4, 0), (3, None), (9, 1), (None, 0)], "doc_id long, quality int")
    out = quality.classify(docs.withColumn("score", F.lit("x")).withColumn("th", F.lit(1)), labels)
    assert out.count() == 6 and out.columns.count("score") == 1
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert quality.classify(spark.createDataFrame([], DOCS), labels).count() == 0
    none = quality.classify(docs, labels.where("false")).collect()
    assert {round(r.evidence, 6) for r in none} == {0.5}


def test_split_url(spark):
    df = spark.createDataFrame([("http://A.example.com/fr/825?p=2",), ("https://b.org",), (None,)], "url string")
    host, path = quality.split_url(F.col("url"))
    assert [tuple(r) for r in df.select(host, path).collect()] == [
        ("a.example.com", "/fr"), ("b.org", ""), (None, None)]
