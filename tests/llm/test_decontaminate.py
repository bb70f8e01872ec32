import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import decontaminate as dec

from .conftest import DOCS

PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [w.strip(PUNCT) or w for w in re.findall(r"[^\x20\x09-\x0D]+", t)]


def brute(rows, items):
    """All alignments of all pairs."""
    out = []
    for d, text in rows:
        w, named, windows = words(text), set(), 0
        for n, (i, t) in enumerate({(i, t) for i, t in items if t is not None}):
            v = words(t)
            if not v:
                continue
            span, need = (13, 11) if len(v) >= 13 else (len(v), len(v) - 2 * len(v) // 13)
            for p, q in itertools.product(range(len(w) - span + 1), range(len(v) - span + 1)):
                if sum(x == y for x, y in zip(w[p:p + span], v[q:q + span])) >= need:
                    named.add(i)
        out.append((d, bool(named), len(named), sorted(named)))
    return sorted(map(repr, out))


def run(spark, docs, items, **k):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(repr, (tuple(r)[:4] for r in dec.report(docs, bench).collect())))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abc") + str(rng.randrange(3000))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 3, 4, 6, 7, 8, 12, 13, 20, 40])))) for i in range(14)]
    items += [(3, items[3][1]), (90, None), (91, "")]
    rows = []
    for n in range(70):
        w = [word() for _ in range(rng.randrange(0, 30))]
        if rng.random() < 0.7:
            p = rng.choice(items[:14])[1].split()
            a = rng.randrange(len(p)) if rng.random() < 0.3 else 0
            p = p[a:a + rng.choice([10, 13, 99])]
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                p[rng.randrange(len(p))] = word()
            w += p + [word() for _ in range(rng.randrange(20))]
        rows.append((n, rng.choice([" ", "\n"]).join(x.upper() + "," if rng.random() < 0.1 else x for x in w)))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, frame, seed):
    rows, items = corpus(seed)
    rows += [(500, None), (501, ""), (None, items[5][1]), (2, items[6][1]), rows[4], (502, "x " * 30000)]
    assert run(spark, frame(rows), items) == brute(rows, items)


def all_windows(item, text):
    """Windows over all alignments, one by one."""
    span, need = (13, 11) if len(item) >= 13 else (len(item), len(item) - 2 * len(item) // 13)
    return sum(sum(item[q + k] == text[p + k] for k in range(span)) >= need
               for p in range(len(text) - span + 1) for q in range(len(item) - span + 1))


@pytest.mark.parametrize("seed", range(8))
def test_windows_count_all_alignments(seed):
    rng = random.Random(seed)
    for _ in range(60):
        few = rng.choice([1, 2, 3, 500])
        item = np.array([rng.randrange(few) for _ in range(rng.randrange(1, 30))], np.uint64)
        text = np.array([rng.randrange(few) for _ in range(rng.randrange(0, 60))], np.uint64)
        if rng.random() < 0.6 and len(text) > len(item):
            a = rng.randrange(len(text) - len(item))
            text[a:a + len(item)] = item
            text[rng.randrange(len(text))] = 7
        assert dec.windows(item, text) == all_windows(item, text)


def test_masks_see_every_pair_of_substitutions():
    item = np.arange(1, 14, dtype=np.uint64)
    for bad in itertools.combinations(range(13), 2):
        other = item.copy()
        other[list(bad)] += np.uint64(100)
        assert dec.windows(item, other) == 1
    assert dec.windows(item, np.where(np.arange(13) < 3, 99, item).astype(np.uint64)) == 0
    for length in range(1, 13):
        for bad in range(length):
            other = item[:length].copy()
            other[bad] += np.uint64(100)
            assert dec.windows(item[:length], other) == (length >= 7)


def test_repeated_words_stay_cheap():
    start = time.time()
    one = np.ones(300, np.uint64)
    assert dec.windows(one, np.ones(8000, np.uint64)) == 288 * 7988
    assert time.time() - start < 3


def test_short_and_changed_items_are_found(spark, frame):
    items = [(1, "alpha beta gamma delta"), (2, "one two three four five six seven eight"), (3, "Alpha, beta gamma delta")]
    rows = [(1, "x alpha beta, gamma delta y"), (2, "one two three NO five six seven eight"), (3, "alpha beta gamma no"),
            (4, "one two no no five six seven eight")]
    assert run(spark, frame(rows), items) == brute(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [r.contaminated for r in dec.report(frame(rows), bench).orderBy("doc_id").collect()] == [True, True, False, False]
    assert dec.report(frame(rows), bench, shortest=5).where("contaminated").count() == 1


def test_equal_items_and_copies_are_searched_once(spark, frame):
    item = " ".join(f"q{i}" for i in range(15))
    bench = spark.createDataFrame([(i, item) for i in range(200)], "item_id long, text string")
    rows = [(i, f"a {item} b") for i in range(300)] + [(900, "clean text")]
    got = dec.report(frame(rows), bench)
    assert got.where("n_items = 200 and windows = 600").count() == 300
    assert dec.overlaps(frame(rows), bench).count() == 200


def test_decontaminate_keeps_clean_rows_and_columns(spark, frame):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = frame([(1, f"a b {item} c"), (2, "clean"), (2, item), (3, None), (3, None)]).withColumn("item_id", F.lit(7))
    out = dec.decontaminate(docs, bench)
    assert out.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(
        map(repr, [(2, "clean"), (3, None), (3, None)]))
    assert dec.decontaminate(docs, bench.where("false")).count() == 5
    assert dec.report(spark.createDataFrame([], DOCS), bench).count() == 0
