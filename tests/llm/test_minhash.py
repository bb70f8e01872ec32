import random
import re

import pytest
from pyspark.sql import functions as F

from idweave.llm import minhash

from .conftest import DOCS


def brute(rows):
    """Components by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(map(repr, ((d, len(s), least.get(top(i)) if s else d,
                              (least.get(top(i)) if s else d) == d) for i, ((d, _), s) in enumerate(zip(rows, sets)))))


def corpus(seed, groups=25, copies=12):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(4000))
    rows, n = [], 0
    shared = [word() for _ in range(30)]
    for g in range(groups):
        base = [word() for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 60, 200]))] + (shared if g % 3 == 0 else [])
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = word()
            rows.append((n, rng.choice([" ", "  ", "\n"]).join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


def run(df):
    return sorted(map(repr, (tuple(r) for r in minhash.near_duplicates(df).drop("th").collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, frame, seed):
    rows = corpus(seed)
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "Aa bb"), (9004, "aA BB"), (9005, "Éa bb"),
             (9006, "éa bb"), (None, "aa bb"), (None, "only null here"), (9003, "Aa bb"), (9007, "x " * 30000)]
    assert run(frame(rows)) == brute(rows)


def test_a_large_group_of_near_copies(spark, frame):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(4):
            w[rng.randrange(150)] = f"n{rng.random()}"
        rows.append((i, " ".join(w)))
    assert run(frame(rows)) == brute(rows)


def test_sharing_a_passage_is_no_link(spark, frame):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"own{i}-{k}" for k in range(30 + i % 40))) for i in range(120)]
    assert run(frame(rows)) == brute(rows)


def test_dedup_keeps_one_of_each_group(spark, frame):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text), (1, text), (1, text), (2, "other words here"), (5, ""), (5, ""), (6, None), (None, text)]
    out = minhash.dedup(frame(rows).withColumn("th", F.lit("clash")).withColumn("kept", F.lit(0)))
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, [
        (1, text), (2, "other words here"), (5, ""), (5, ""), (6, None)]))
    assert {r.th for r in out.collect()} == {"clash"}


def test_dedup_keeps_each_component_of_a_null_or_repeated_id(spark, frame):
    texts = [" ".join(f"{k}-{i}" for i in range(20)) for k in range(12)]
    rows = [(None, t) for t in texts[:6]] + [(7, t) for t in texts[6:]]
    rows += [(None, texts[0]), (None, texts[1].upper()), (7, texts[6]), (8, texts[7]), (None, texts[8]), (None, ""), (None, "")]
    out = sorted((str(r.doc_id), r.text.lower()) for r in minhash.dedup(frame(rows)).collect())
    assert out == sorted([("None", t) for t in texts[:6]] + [("7", t) for t in texts[6:]] + [("None", "")] * 2)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
