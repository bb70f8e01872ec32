import random

import numpy as np
import pytest

from idweave.llm import periodic
from idweave.llm.queries import op11_periodic_runs

from .conftest import DOCS


def brute(words, least=12):
    """(start, period, length) of all runs, by comparing words q apart."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= 2 * q:
                found.setdefault((start, length), q)
            i += i == start
    return sorted((s, q, n) for (s, n), q in found.items() if n >= least)


def texts(seed, count):
    """Words from small alphabets, powers, powers of powers, and two regions
    of one root that meet out of step."""
    rng = random.Random(seed)
    for _ in range(count):
        kind, few = rng.randrange(5), rng.choice([1, 2, 2, 3, 40])
        if kind == 0:
            out = [rng.randrange(few) for _ in range(rng.randrange(120))]
        elif kind == 1:
            out = ([rng.randrange(few) for _ in range(rng.randrange(1, 30))] * 40)[:rng.randrange(1, 300)]
        elif kind == 2:
            root = [rng.randrange(2) for _ in range(rng.randrange(1, 5))]
            out = (root * 100)[:rng.randrange(20, 150)] + (root * 100)[rng.randrange(4):rng.randrange(20, 150)]
        elif kind == 3:
            out = sum(([rng.randrange(2) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 20) for _ in range(3)), [])
            out = (out + out[:rng.randrange(len(out) + 1)])[:400]
        else:
            a, b = [0], [1]
            for _ in range(8):
                a, b = (a + b, a) if rng.random() < 0.5 else (a + b, [1 - c for c in a])
            out = a[:300]
        yield [b"%d" % c for c in out]


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(seed):
    some = list(texts(seed, 40))
    for least in (2, 12):
        for words, found in zip(some, periodic.search(some, least)):
            assert [(int(s), int(q), int(n)) for s, n, q in zip(*found)] == brute(words, least), words


def test_regions_that_meet_out_of_step():
    """Every odd period has a run across the seam of (ab)^k a and a (ba)^k."""
    words = (b"a b " * 60 + b"a " + b"a b " * 60).split()
    found = periodic.search([words])[0]
    assert [(int(s), int(q), int(n)) for s, n, q in zip(*found)] == brute(words) and len(found[0]) > 30


def test_long_texts_take_n_log_n():
    rng = random.Random(3)
    for words in ([b"a"] * 200_000, [b"%d" % rng.randrange(2) for _ in range(200_000)],
                  [b"%d" % (i % 977) for i in range(200_000)]):
        start, length, period = periodic.search([words])[0]
        assert all(words[s] == words[s + q] and n >= 2 * q for s, n, q in list(zip(start, length, period))[:50])
    assert (int(start[0]), int(length[0]), int(period[0])) == (0, 200_000, 977)


def test_collapse_keeps_first_periods():
    words = b"x y a b c a b c a b c a b c z".split()
    found = periodic.search([words])[0]
    assert [tuple(map(int, f)) for f in zip(*found)] == [(2, 12, 3)]
    assert periodic.collapsed(words, found) == b"x y a b c z"


def expected(doc_id, text):
    """The contract's digests, from its words."""
    import hashlib
    import zlib
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    dropped = {i for s, q, m in found for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, q, m in found), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(found), *top, sha("".join(f"{s},{m},{q}\n" for s, q, m in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, b" ".join(w).decode()) for i, w in enumerate(texts(11, 150))]
    rows += [(200 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(200)))) for i in range(100)]
    rows += [(None, None), (None, "a b " * 20), (7, ""), (8, " \t\n"), (9, "é é " * 9), (9, "é é " * 9), (10, "x" * 5000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "clash") for i, t in rows], DOCS + ", runs string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(expected(*r)) for r in rows)
    kinds = dict(op11_periodic_runs(spark, str(tmp_path)).dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))


def test_empty_table(spark):
    assert periodic.runs(spark.createDataFrame([], DOCS)).count() == 0
    assert periodic.search([]) == [] and len(periodic.search([[]])[0][0]) == 0
    assert np.array_equal(periodic.least_of(np.array([3, 1, 2]), 2), [1, 1])
