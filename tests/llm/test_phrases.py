import collections
import random
import re

import duckdb
import numpy as np
import pytest

from idweave.llm import phrases
from idweave.llm.queries import op13_phrases

from .conftest import DOCS


def brute(rows, top=2000):
    """The contract, with Python's integers and tuples of words."""
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        often = {p: a for p, a in count.items() if len(p) > 1 and a >= 10}
        found = []
        for p, a in often.items():
            if any(100 * b >= 50 * a for q, b in often.items()
                   if len(q) > len(p) and p in {q[i:i + len(p)] for i in range(len(q) - len(p) + 1)}):
                continue
            cuts = [(1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def texts(seed, count=300):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(40)] + ["É", "New", "york", "city", "a\x00b", "x|y"]
    for _ in range(count):
        w = []
        for _ in range(rng.randrange(30)):
            w += rng.choice([[rng.choice(names)], ["new", "York", "City"], ["of", "the"], ["w1", "w2"]])
        text = "".join(x + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for x in w)
        yield text, rng.choice(["en", "en", "en", "fr", None, "und"])


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force_and_sql(spark, tmp_path, seed):
    rows = list(texts(seed)) + [(None, "en"), ("", "fr"), (None, None), ("same text here " * 12, "en"),
                                ("same text here " * 12, "en"), ("one two " * 30000, "fr"), ("a.b.c", "de")]
    docs = spark.createDataFrame([(i, t, g, "s", 0, "x", 1) for i, (t, g) in enumerate(rows)], DOCS + ", phrase string, fp int")
    docs.coalesce(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in op13_phrases(spark, str(tmp_path)).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = brute(rows)
    assert got == want and len(want) > 60
    sql = phrases.PHRASE_SQL.format(documents=f"read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(duckdb.sql(sql).fetchall()) == want


def test_ranks_cut_at_the_top(spark, frame):
    docs = frame([(i, t) for i, (t, _) in enumerate(texts(5))])
    scored = phrases.collocations(docs).cache()
    order = sorted(scored.collect(), key=lambda r: (-r.score, -r.a, r.phrase.encode()))
    got = sorted(phrases.first_of_each(scored, 7).collect(), key=lambda r: r.rank)
    assert [(r.rank, r.phrase) for r in got] == [(i + 1, r.phrase) for i, r in enumerate(order[:7])]


def test_a_crowded_pair_filter_changes_nothing(spark, frame, monkeypatch):
    rows = [(i, t) for i, (t, _) in enumerate(texts(9, 150))]
    want = sorted(map(repr, phrases.collocations(frame(rows)).drop("fp").collect()))
    monkeypatch.setattr(phrases, "FILTER_BITS", 64 * 64)
    assert sorted(map(repr, phrases.collocations(frame(rows)).drop("fp").collect())) == want


def test_scores_are_exact_beyond_64_bits(spark):
    """floor(10^6 a a / (l r)) where a double would round up."""
    a, l, r = 3_000_000_019, 3_000_000_037, 3_000_000_021
    df = spark.createDataFrame([(a, l, r)], "a long, nl long, nr long")
    over = df.selectExpr("cast(a as decimal(20,0)) * cast(a as decimal(20,0)) * cast(1000000 as decimal(7,0)) as over",
                         "cast(nl as decimal(20,0)) * cast(nr as decimal(20,0)) as under")
    assert over.selectExpr("over div under as s").first().s == 1000000 * a * a // (l * r)


def test_prefix_polynomials_give_every_gram(spark):
    words = phrases.Words(["b a b a. a b", None, "A B a"], ["en", "en", "fr"])
    for n in (1, 2, 3):
        at, prints, checks = words.grams(n)
        seen = collections.defaultdict(set)
        for p, fp, c in zip(at.tolist(), prints.tolist(), checks.tolist()):
            seen[(int(words.text[p]) == 2, *words.words[p:p + n])].add((fp, c))
        assert all(len(v) == 1 for v in seen.values())
        assert len({next(iter(v)) for v in seen.values()}) == len(seen)
        assert np.all(prints & 3 == n)
    assert [len(words.grams(n)[0]) for n in (1, 2, 3)] == [9, 6, 3]


def test_empty_table(spark):
    assert phrases.first_of_each(phrases.collocations(spark.createDataFrame([], DOCS))).count() == 0
