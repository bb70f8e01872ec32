"""Benchmark decontamination by spaced-seed hashing.

A document is contaminated by an item if, on one alignment of the two, some
``SPAN`` = 13 consecutive words agree in at least ``AGREE`` = 11 places: up to
two words in thirteen may have been substituted. An item of fewer than 13
words must be there as a whole, with two substitutions in thirteen scaled to
its length: one from 7 words on, none below. Words are lower-cased (A-Z) and
stripped of ASCII punctuation at both ends.

Seeds: the 13 places are four blocks, and each of the six masks looks at
two blocks and ignores the other two. Two substitutions spoil two blocks at
most, so one of the masks sees only words that agree: no overlap that the
definition counts is missed. A shorter item has its two halves for masks if
it may have a substitution, and all its words for one if not.

1. The seeds of the test items are a Spark table (seed, item), one item per
   distinct text. A filter of ``FILTER_BITS`` bits of them, of that size
   whatever the benchmark's, goes to the tasks that read the documents.
2. Every document is hashed under all masks at all positions. Seeds that the
   filter knows are rows (seed, text), each once per text, and are joined to
   the test seeds: pairs of text and item.
3. Each pair is verified: the seeds name alignments, and along each of them
   the words are compared, by numpy, with work of at most the product of the
   two lengths even where both repeat one word.

Equal texts are one text until the end. The benchmark and the documents are
both read by tasks; the driver sees the filter alone.

Defined cases: null and empty texts and items match nothing; equal rows get
equal results, texts under one id are judged each for itself; an empty
benchmark contaminates nothing; an empty table gives an empty table; extra
columns pass through ``decontaminate``. ``shortest`` leaves out items of
fewer words: an item of one common word is in most documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, free_names, mixed, ship, window_hashes, word_hashes, words_of

SPAN = 13
AGREE = 11
SHORTEST = 1
BLOCKS = ((0, 1, 2, 3), (4, 5, 6), (7, 8, 9), (10, 11, 12))
MASKS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FILTER_BITS = 24
_FACTORS = np.random.default_rng(7).integers(1, 2 ** 63, SPAN, dtype=np.uint64) | np.uint64(1)
#: Words compared at once in a verification.
_CELLS = 1 << 21


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words as they are compared."""
    return word_hashes([w.strip(PUNCTUATION) or w for w in words_of(text or "", lower=True)])


def span_of(length: int) -> tuple[int, int]:
    """(words of a window, words that must agree) for an item."""
    return (SPAN, AGREE) if length >= SPAN else (length, length - length * (SPAN - AGREE) // SPAN)


def masked(hashes: np.ndarray) -> list[np.ndarray]:
    """Per mask the hash at every position where 13 words follow."""
    count = len(hashes) - SPAN + 1
    if count <= 0:
        return [np.empty(0, np.uint64)] * len(MASKS)
    parts = []
    for block in BLOCKS:
        part = np.zeros(count, np.uint64)
        for place in block:
            part += hashes[place:place + count] * _FACTORS[place]
        parts.append(part)
    return [mixed(parts[a] + parts[b]) for a, b in MASKS]


def pieces(length: int) -> list[tuple[int, int]]:
    """(offset, words) of the masks of a short item."""
    half = length // 2
    return [(0, half), (half, length - half)] if span_of(length)[1] < length else [(0, length)]


def seeds(hashes: np.ndarray, short: list[int]) -> list[tuple[np.ndarray, int]]:
    """(hashes at all positions, offset of the position in the window) for
    each mask: those of 13 words, and those of the ``short`` lengths."""
    out = [(s, 0) for s in masked(hashes)]
    for length in short:
        for offset, size in pieces(length):
            name = np.array([length * SPAN + offset], np.uint64) * _FACTORS[:1]
            out.append((mixed(window_hashes(hashes, size) + name), offset))
    return out


def item_seeds(hashes: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """As ``seeds``, the masks that an item itself is searched with."""
    if len(hashes) >= SPAN:
        return seeds(hashes, [])
    return [(s[o:o + 1], o) for s, o in seeds(hashes, [len(hashes)])[len(MASKS):]]


def windows(item: np.ndarray, text: np.ndarray) -> int:
    """Over all alignments, the windows of the item that agree enough."""
    span, need = span_of(len(item))
    if not span or len(text) < span:
        return 0
    short = [len(item)] if len(item) < SPAN else []
    # alignments from -(len(item) - span) to len(text) - span, shifted to 0
    lead = len(item) - span
    named = np.zeros(len(text) - span + lead + 1, bool)
    skip = 0 if not short else len(MASKS)
    for (mine, offset), (theirs, _) in zip(item_seeds(item), seeds(text, short)[skip:]):
        at, order = theirs, np.argsort(mine, kind="stable")
        low = np.searchsorted(mine[order], at, "left")
        high = np.searchsorted(mine[order], at, "right")
        places = np.flatnonzero(high > low)
        places = places[np.argsort(low[places], kind="stable")]
        # equal hashes share one range of places in the item
        cuts = np.flatnonzero(np.diff(low[places])) + 1
        for here in np.split(places, cuts) if len(places) else []:
            for k in order[low[here[0]]:high[here[0]]]:
                shift = here - (k + (offset if short else 0)) + lead
                named[shift[(shift >= 0) & (shift < len(named))]] = True
    shifts, total = np.flatnonzero(named) - lead, 0
    padded = np.concatenate([np.zeros(lead, np.uint64), text, np.zeros(lead, np.uint64)])
    real = np.zeros(len(padded), bool)
    real[lead:lead + len(text)] = True
    step = max(1, _CELLS // len(item))
    for a in range(0, len(shifts), step):
        at = (shifts[a:a + step] + lead)[:, None] + np.arange(len(item))
        same = (padded[at] == item) & real[at]
        sums = np.concatenate([np.zeros((len(at), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
        whole = np.concatenate([np.zeros((len(at), 1), np.int64), np.cumsum(real[at], axis=1)], axis=1)
        agree = (sums[:, span:] - sums[:, :-span] >= need) & (whole[:, span:] - whole[:, :-span] == span)
        total += int(agree.sum())
    return total


def _text_key() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


def test_seeds(items: DataFrame, shortest: int) -> DataFrame:
    """(seed, item, words): distinct seeds of each item (item, text), with
    its number of words if that is below 13, else 13."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                hashes = tokens(text)
                if len(hashes) >= max(shortest, 1):
                    found = np.unique(np.concatenate([s for s, _ in item_seeds(hashes)])).view(np.int64)
                    rows += [(seed, item, min(len(hashes), SPAN)) for seed in found.tolist()]
            yield pd.DataFrame(rows, columns=["seed", "item", "words"])

    return items.mapInPandas(each, "seed long, item binary, words int")


test_seeds.__test__ = False


def seed_filter(found: DataFrame) -> np.ndarray:
    """Which values of their first ``FILTER_BITS`` bits the seeds have, a bit
    each in bytes, merged by tasks into words of 64."""
    place = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in found.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        out[row["at"]] = row["bits"]
    return out.view(np.uint8)


def known_seeds(of: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The hashes of which the filter has the bit."""
    at = (of >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return of[(known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]


def document_seeds(docs: DataFrame, known: np.ndarray, short: list[int]) -> DataFrame:
    """(seed, th): the seeds of each text that the filter knows."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [np.unique(np.concatenate([known_seeds(s, known) for s, _ in seeds(tokens(t), short)]))
                    for t in batch["text"]]
            yield pd.DataFrame({"seed": np.concatenate(hits).view(np.int64),
                                "th": np.repeat(batch["th"].to_numpy(), [len(h) for h in hits])})

    return docs.where("text is not null").select(_text_key().alias("th"), "text").mapInPandas(each, "seed long, th binary")


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, hashes = None, np.empty(0, np.uint64)
    for batch in batches:
        counts = []
        for th, text, item in zip(batch["th"], batch["text"], batch["other"]):
            if th != last:
                last, hashes = th, tokens(text)
            counts.append(windows(tokens(item), hashes))
        out = pd.DataFrame({"th": batch["th"], "item": batch["item"], "windows": counts})
        yield out[out["windows"] > 0]


def overlaps(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(th, item_id, windows): contaminated texts, by the md5 of the text,
    with the items they hold and the number of windows that agree."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    named = benchmark.where("text is not null").select("item_id", _text_key().alias("item"), "text")
    items = scratch.save(named.groupBy("item").agg(F.first("text").alias("text")))
    found = scratch.save(test_seeds(items, shortest))
    known = seed_filter(found)
    short = [r.words for r in found.where(F.col("words") < SPAN).select("words").distinct().collect()]
    # copies of a text ask once
    asked = document_seeds(docs, known, sorted(short)).distinct()
    pairs = scratch.save(asked.join(found.select("seed", "item"), "seed").select("th", "item").distinct())
    texts = (docs.where("text is not null").select(_text_key().alias("th"), "text")
             .join(pairs.select("th").distinct(), "th", "left_semi").groupBy("th").agg(F.first("text").alias("text")))
    both = (pairs.join(items.withColumnRenamed("text", "other"), "item").join(texts, "th")
            .select("th", "text", "item", "other"))
    held = scratch.save(both.mapInPandas(_verified, "th binary, item binary, windows long"))
    return (named.select("item_id", "item").distinct().join(held, "item")
            .groupBy("th", "item_id").agg(F.sum("windows").alias("windows")))


def report(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, contaminated, n_items, items (sorted), windows for every row."""
    found = overlaps(docs, benchmark, shortest).groupBy("th").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.sum("windows").alias("windows"))
    # read from a table, the few texts found do not fix how the rows are dealt
    found = Scratch(docs.sparkSession, "decontaminate").save(found)
    joined = docs.select("doc_id", _text_key().alias("th")).join(found, "th", "left")
    return joined.select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"),
        F.coalesce("windows", F.lit(0)).cast("long").alias("windows"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` without the contaminated documents."""
    (th,) = free_names(docs, "_th")
    found = overlaps(docs, benchmark, shortest).select(F.col("th").alias(th)).distinct()
    found = Scratch(docs.sparkSession, "decontaminate").save(found)
    return docs.join(found, _text_key() == F.col(th), "left_anti")


ship(__name__)
