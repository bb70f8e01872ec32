import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import substring_dedup as sub

from .conftest import DOCS


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "the", f"w{rng.randrange(50)}", f"v{rng.randrange(9999)}"])
    passages = [[word() for _ in range(k)] for k in (20, 34, 35, 36, 60, 90, 200)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += [word() for _ in range(rng.randrange(0, 60))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            w += p[a:] if rng.random() < 0.5 else p
            if w and rng.random() < 0.4:
                w[rng.randrange(len(w))] = word()
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    return rows


def run(df):
    return sorted(map(repr, (tuple(r) for r in sub.removals(df).collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, frame, seed):
    rows = corpus(seed)
    rows += [rows[3], (7, rows[3][1]), (900, None), (901, ""), (None, rows[5][1]), (902, "x " * 40),
             (903, "y " * 34), (904, " ".join(map(str, range(30000)))), (905, "Ä b " * 36)]
    assert run(frame(rows)) == brute(rows)


def test_near_copies_in_a_group(spark, frame):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(160)] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    assert run(frame(rows)) == brute(rows)


def test_dedup_returns_texts(spark, frame):
    p = " ".join(f"p{i}" for i in range(50))
    rows = [(1, f"a b {p} c"), (2, f"d  e {p}"), (3, "un  changed"), (4, None)]
    out = sub.dedup(frame(rows).withColumn("th", F.lit(1)).withColumn("kept", F.lit(2)))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a b c", 2: "d e", 3: "un  changed", 4: None}
    assert out.columns[-2:] == ["th", "kept"]


def test_empty_table(spark):
    assert sub.removals(spark.createDataFrame([], DOCS)).count() == 0


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 99, 60)
    for width in (1, 2, 3, 18, 27, 60, 61):
        assert list(sub.sliding_min(x, width)) == [min(x[i:i + width]) for i in range(len(x) - width + 1)]
    assert sub.lengths() == [9, 18]
