"""Runs (maximal periodic stretches of words) by string synchronising sets.

A run is a stretch of at least ``least`` words and of two periods that no
neighbouring word extends. A text's words are numbered, and a batch of texts
is searched as one array, with a number of its own between any two texts, so
that nothing reaches across.

* Names: ``names[k][i]`` numbers the window of 2^k words at i, by doubling.
  Equal numbers are equal words; no hash decides anything.
* Periods below ``DIRECT`` are read off by comparing the array with itself.
* Scale t = 2^k, for periods from 3t to below 6t. Windows of t words with a
  period of t/3 or less lie in runs that are known by now; they are left out.
  Position i is synchronising if, of the hashes of the t + 1 windows at i to
  i + t, the least is at either end. Whether it is depends on the 2t words at
  i alone, so a run's positions recur one period later. Positions with the
  same 2t words and a distance in range propose that distance as a period;
  a kept position recurs only a few times within 6t words.
* Where a whole period of a run has no synchronising position, it lies in one
  highly periodic region, and its repetition in another one with the same
  root that begins where the first one ends. Such neighbours propose all
  distances at which their roots agree.
* Every proposal is extended both ways in steps of halving lengths, and of
  the periods of one stretch the smallest is kept.

Work and memory are n log n for n words, whatever the text repeats.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; texts are searched whole; repeated rows and ids are rows of
their own; a null id is an id like any other; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import mixed, ship, words_of

LEAST = 12
#: Periods below this are found by comparison; the first scale is a third.
DIRECT = 12
#: Bytes of text searched as one array; one longer text is an array of its own.
CHUNK_BYTES = 1 << 22
_NONE = np.uint64(2 ** 64 - 1)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def window_names(x: np.ndarray, reach: Callable[[int], int]) -> list[np.ndarray]:
    """names[k]: a number for each window of 2^k words within the first
    ``reach(2^k)`` ones."""
    names = [np.unique(x, return_inverse=True)[1].astype(np.int64)]
    size = 1
    while reach(2 * size) >= 2 * size:
        last = names[-1][:reach(2 * size) - size + 1]
        pair = last[:-size] * np.int64(len(x) + 1) + last[size:]
        names.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return names


def forward(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i and from j > i on are equal."""
    done = np.zeros(len(i), np.int64)
    for k in reversed(range(len(names))):
        a, b = i + done, j + done
        ok = b < len(names[k])
        ok[ok] = names[k][a[ok]] == names[k][b[ok]]
        done += ok.astype(np.int64) << k
    return done


def backward(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before i and before j > i are equal."""
    done = np.zeros(len(i), np.int64)
    for k in reversed(range(len(names))):
        a, b = i - done - (1 << k), j - done - (1 << k)
        ok = (a >= 0) & (b < len(names[k]))
        ok[ok] = names[k][a[ok]] == names[k][b[ok]]
        done += ok.astype(np.int64) << k
    return done


def smallest(runs: Runs) -> Runs:
    """One run per stretch, with its smallest period, by start."""
    start, length, period = runs
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def joined(*parts: Runs) -> Runs:
    return smallest(tuple(np.concatenate(column) for column in zip(*parts)))


def direct_runs(x: np.ndarray, period: int) -> Runs:
    """Stretches of two periods or more by comparing x with itself."""
    same = np.zeros(max(len(x) - period, 0) + 2, np.int8)
    same[1:-1] = x[:-period] == x[period:] if len(x) > period else same[1:-1]
    edges = np.flatnonzero(np.diff(same))
    start, stop = edges[::2], edges[1::2]
    enough = stop - start >= period
    start, stop = start[enough], stop[enough]
    return start, stop - start + period, np.full(len(start), period)


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:len(x) - step], x[step:])
        done += step
    return x


def synchronising(names: np.ndarray, runs: Runs, t: int) -> np.ndarray:
    """The synchronising positions for windows of t words, which are given
    by their numbers."""
    count = len(names) - t
    if count <= 0:
        return np.empty(0, np.int64)
    start, length, period = runs
    inside = (3 * period <= t) & (length >= t) & (start < len(names))
    cover = np.zeros(len(names) + 1, np.int64)
    np.add.at(cover, start[inside], 1)
    np.add.at(cover, np.minimum(start[inside] + length[inside] - t + 1, len(names)), -1)
    rank = np.where(np.cumsum(cover[:-1]) > 0, _NONE, mixed(names.astype(np.uint64)) >> np.uint64(1))
    low = least_of(rank, t + 1)
    return np.flatnonzero((low != _NONE) & ((rank[:count] == low) | (rank[t:] == low)))


def by_context(at: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of positions with equal context whose distance
    is from 3t to below 6t."""
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    left, gaps = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for m in range(1, len(at)):
        gap = at[m:] - at[:-m]
        near = (context[m:] == context[:-m]) & (gap < 6 * t)
        if not near.any():
            break
        near &= gap >= 3 * t
        left.append(at[:-m][near])
        gaps.append(gap[near])
    return np.concatenate(left), np.concatenate(gaps)


def by_regions(names: list[np.ndarray], runs: Runs, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) from neighbouring highly periodic regions with
    the same root."""
    start, length, period = runs
    region = np.flatnonzero((3 * period <= t) & (length >= 3 * t))
    region = region[np.lexsort((start[region], period[region]))]
    one, two = region[:-1], region[1:]
    touch = (period[one] == period[two]) & (start[two] <= start[one] + length[one])
    one, two = one[touch], two[touch]
    root = period[one]
    # the root at the start of the second region, looked for in the first one
    pair = np.repeat(np.arange(len(one)), root)
    turn = np.arange(len(pair)) - np.repeat(np.cumsum(root) - root, root)
    agree = forward(names, start[one][pair] + turn, start[two][pair]) >= root[pair]
    left, gaps = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for p, d in zip(pair[agree], turn[agree]):
        a, b, q = start[one[p]], start[two[p]], root[p]
        most = min(length[one[p]], length[two[p]], (b + length[two[p]] - a) // 2, 6 * t - 1)
        gap = np.arange(3 * t + (b - a - d - 3 * t) % q, most + 1, q)
        left.append(np.maximum(a, b - gap))
        gaps.append(gap)
    return np.concatenate(left), np.concatenate(gaps)


def find_runs(x: np.ndarray, ends: np.ndarray) -> Runs:
    """All stretches of two periods or more in texts that lie behind each
    other in x, longest first, each with a number of its own behind it, text
    d up to ends[d]; by start, smallest period each."""
    sizes = np.diff(ends, prepend=-1) - 1
    reach = lambda size: int(ends[np.count_nonzero(sizes >= size) - 1]) if len(ends) and sizes[0] >= size else 0
    runs = joined(*[direct_runs(x, q) for q in range(1, DIRECT)])
    t = DIRECT // 3
    if not reach(6 * t):
        return runs
    names = window_names(x, reach)
    while reach(6 * t):
        k, here = t.bit_length() - 1, reach(6 * t)
        at = synchronising(names[k][:here - t + 1], runs, t)
        proposals = zip(by_context(at, names[k + 1][at], t), by_regions(names, runs, t))
        i, q = (np.concatenate(p) for p in proposals)
        i, q = np.unique(np.stack([i, q]), axis=1) if len(i) else (i, q)
        back = backward(names, i, i + q)
        both = back + forward(names, i, i + q)
        real = both >= q
        runs = joined(runs, ((i - back)[real], (both + q)[real], q[real]))
        t *= 2
    return runs


def search(texts: list[list[bytes]], least: int = LEAST) -> list[Runs]:
    """The runs of each text, given as words: starts, lengths and periods, by
    start, then period."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    ids: dict[bytes, int] = {}
    flat: list[int] = []
    ends = []
    for d in order:
        flat.extend(ids.setdefault(w, len(ids)) for w in texts[d])
        ends.append(len(flat))
        flat.append(-1 - len(ends))
    ends = np.array(ends, np.int64)
    start, length, period = find_runs(np.array(flat, np.int64), ends)
    long = length >= least
    start, length, period = start[long], length[long], period[long]
    which = np.searchsorted(ends, start)
    start = start - np.concatenate([[0], ends + 1])[which]
    order_within = np.lexsort((period, start, which))
    start, length, period, which = (v[order_within] for v in (start, length, period, which))
    cuts = np.searchsorted(which, np.arange(len(texts) + 1))
    out: list[Runs] = [None] * len(texts)
    for d, a, b in zip(order, cuts, cuts[1:]):
        out[d] = start[a:b], length[a:b], period[a:b]
    return out


def collapsed(words: list[bytes], runs: Runs) -> bytes:
    """The words left when of each run the first period alone is kept."""
    start, length, period = runs
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone) if not g]) if gone.any() else b" ".join(words)


def planted_words(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The words of a text; of one id in ten, by its crc32, with a tail that
    repeats its first words."""
    h = zlib.crc32((doc_id or "").encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[:n - a]


def chunks(sizes: list[int], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of neighbours with at most ``most`` in total, or of one."""
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > most:
            yield slice(start, at)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def runs(docs: DataFrame, least: int = LEAST,
         words: Callable[[str | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row: ``runs`` an array of
    (start, length, period) by start and period, ``collapsed`` the text in
    which each run is left with its first period. ``words`` may change the
    words of a text before it is searched; it gets the id as text."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for part in chunks(pc.binary_length(texts).fill_null(0).to_pylist()):
                own = [words_of(t or "") for t in texts[part].to_pylist()]
                if words:
                    own = [words(i, w) for i, w in zip(batch.column("key")[part].to_pylist(), own)]
                found = search(own, least)
                offsets = np.cumsum([0, *(len(f[0]) for f in found)])
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([f[c] for f in found]), pa.int64()) for c in range(3)], fields=list(run))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[part], pa.array([len(w) for w in own], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                     pa.array([collapsed(w, f).decode() for w, f in zip(own, found)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), "text").mapInArrow(
        each, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


ship(__name__)
