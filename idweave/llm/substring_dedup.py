"""Substring dedup by level-wise doubling of window lengths.

A window is ``WINDOW`` consecutive words; a word goes if a window over it
has the same words as a window that starts anywhere else. Windows are
judged on the texts as they came, so all places of a repeat go.

Levels (9, 18, 35 words for windows of 35): at each shorter length a window
is represented by one of the runs of that length in it, the one of the
least hash. Equal windows have equal runs, so a window whose run occurs once
in the corpus is unique and is left behind; only the windows that remain
are looked at with runs of twice the length, until no candidates survive or
the whole window is compared. About one run in 14 is ever shuffled at the
first level, and only what may be repeated afterwards.

At full length the remaining starts of a text are cut into blocks by
content. Blocks that occur more than once are settled as a whole, and one
place of each tells its windows to the rest; only windows of blocks seen
once ask one by one. Copies of a whole text are one row from the start
(with their number). Nothing is compared pairwise and no group is gathered:
counts per hash are partial aggregates, and what comes back to a text is
bounded by that text.

Hashes are 64 bits of word-level polynomials over 64-bit word hashes.

Defined cases: null and empty texts have no words, and the digest of the
empty text; equal rows (whatever their ids) are places of each other; a null
id is an id like any other; an empty table gives an empty table; extra
columns are ignored by ``removals`` and carried by ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, free_names, ship, window_hashes, word_hashes, words_of

WINDOW = 35
START = 9
_CUT = np.uint64(31)


def lengths(start: int = START, window: int = WINDOW) -> list[int]:
    """The run lengths below the window, each twice the one before."""
    out = [start]
    while out[-1] * 2 < window:
        out.append(out[-1] * 2)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    done, count = 1, len(x) - width + 1
    if count <= 0:
        return np.empty(0, x.dtype)
    while done * 2 <= width:
        x = np.minimum(x[:len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[:count], x[width - done:width - done + count])


def runs(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window the hash of its run, and all hashes of that length."""
    every = window_hashes(hashes, length)
    return sliding_min(every, WINDOW - length + 1), every


def _ask(chosen: np.ndarray, every: np.ndarray) -> np.ndarray:
    """The distinct chosen hashes; twice what starts twice in this text."""
    values = np.unique(chosen)
    all_values, n = np.unique(every, return_counts=True)
    twice = values[np.isin(values, all_values[n > 1], assume_unique=True)]
    return np.concatenate([values, twice]).view(np.int64)


def _known(values) -> np.ndarray:
    return np.asarray(values if values is not None else [], np.int64).view(np.uint64)


def _unpack(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    length = lengths()[0]
    for batch in batches:
        counts, digests, asked = [], [], []
        for text in batch["text"]:
            words = words_of(text or "")
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            asked.append(_ask(*runs(word_hashes(words), length)) if len(words) >= WINDOW else None)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "th": batch["th"], "n_words": counts,
                            "sha": digests, "ask": asked})


def _narrow(level: int):
    """Keep the starts whose run at ``lengths()[level]`` is known again; ask
    at the next length, or cut into blocks after the last."""
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = lengths()
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                hashes = word_hashes(words_of(r.text))
                chosen, _ = runs(hashes, steps[level])
                stay = np.ones(len(chosen), bool) if r.m > 1 else np.isin(chosen, _known(r.again))
                if level:
                    stay &= _unpack(r.stay, len(chosen))
                if not stay.any():
                    continue
                row = [r.class_no, r.m, r.text, np.packbits(stay).tobytes()]
                if level + 1 < len(steps):
                    longer, every = runs(hashes, steps[level + 1])
                    rows.append([*row, _ask(longer[stay], every)])
                else:
                    rows.append([*row, *_blocks(hashes, stay)])
            names = ["class_no", "m", "text", "stay"]
            yield pd.DataFrame(rows, columns=names + (["ask"] if level + 1 < len(steps) else ["at", "to", "hash"]))
    return task


def _blocks(hashes: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The remaining starts as intervals [at, to], cut where the content
    says so, with a hash of all words that their windows cover."""
    cut = (window_hashes(hashes, START)[:len(stay)] & _CUT) == 0
    begins = stay.copy()
    begins[1:] &= ~stay[:-1] | cut[1:]
    at = np.flatnonzero(begins)
    ends = stay.copy()
    ends[:-1] &= ~stay[1:] | cut[1:]
    to = np.flatnonzero(ends)
    out = np.empty(len(at), np.uint64)
    span = to - at + WINDOW
    for size in np.unique(span):
        which = span == size
        out[which] = window_hashes(hashes, int(size))[at[which]] + np.uint64(size)
    return at.astype(np.int32), to.astype(np.int32), out.view(np.int64)


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From what is known of a text's blocks: starts that are repeated, the
    window hashes to ask for and those to tell."""
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            full = window_hashes(word_hashes(words_of(r.text)), WINDOW)
            stay = _unpack(r.stay, len(full))
            done, tell = np.zeros(len(full), bool), np.zeros(len(full), bool)
            for at, to, speaks in zip(r.at, r.to, r.speaks) if r.at is not None else ():
                done[at:to + 1] = True
                tell[at:to + 1] = speaks
            open_ = stay & ~done
            values, n = np.unique(full[open_], return_counts=True)
            rows.append([r.class_no, r.text, np.packbits(done).tobytes(), np.packbits(open_).tobytes(),
                         np.concatenate([values, values[n > 1]]).view(np.int64),
                         np.unique(full[tell]).view(np.int64)])
        yield pd.DataFrame(rows, columns=["class_no", "text", "done", "open", "ask", "tell"])


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            words = words_of(r.text)
            full = window_hashes(word_hashes(words), WINDOW)
            gone = _unpack(r.done, len(full))
            gone |= _unpack(r.open, len(full)) & np.isin(full, _known(r.again))
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, np.flatnonzero(gone), 1)
            np.add.at(steps, np.flatnonzero(gone) + WINDOW, -1)
            covered = np.cumsum(steps[:-1]) > 0
            kept = b" ".join(w for w, c in zip(words, covered) if not c)
            rows.append([r.class_no, int(covered.sum()), hashlib.sha256(kept).hexdigest(),
                         kept.decode("utf-8")])
        yield pd.DataFrame(rows, columns=["class_no", "n_removed", "kept_sha256", "kept"])


def _again(state: DataFrame, scratch: Scratch) -> DataFrame:
    """(class_no, again): of the hashes that a single text asks for, those
    that occur more than once."""
    asked = state.select("class_no", "m", F.explode("ask").alias("hash"))
    known = scratch.save(asked.groupBy("hash").agg(
        F.sum(F.when(F.col("m") > 1, 2).otherwise(1)).alias("n"), F.min("m").alias("m"))
        .where("n > 1 and m = 1").select("hash"))
    return (asked.where("m = 1").select("class_no", "hash").join(known, "hash")
            .groupBy("class_no").agg(F.collect_set("hash").alias("again")))


def _repeats(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All rows (doc_id, th, n_words, sha), and the texts that lose words
    (th, n_removed, kept_sha256, kept)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("th"))
    rows = scratch.save(keyed.mapInPandas(
        _first, f"doc_id {kind}, th binary, n_words long, sha string, ask array<long>"))
    classes = scratch.save(
        rows.where(F.col("n_words") >= WINDOW).groupBy("th")
        .agg(F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("one"), F.first("ask").alias("ask"))
        .withColumn("class_no", F.monotonically_increasing_id()))
    again = _again(classes, scratch)
    live = (classes.select("class_no", "th", "m", F.col("one").alias("_one"))
            .join(again, "class_no", "left").where("m > 1 or again is not null"))
    state = (keyed.join(live.withColumnRenamed("th", "_th"),
                        (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_one")))
             .select("class_no", "m", "text", "again"))
    steps = lengths()
    kept = "class_no long, m long, text string, stay binary"
    for level in range(len(steps)):
        if level:
            previous, again = state, _again(state, scratch)
            state = (state.select("class_no", "m", "text", "stay").join(again, "class_no", "left")
                     .where("m > 1 or again is not null"))
        last = level + 1 == len(steps)
        more = ", at array<int>, to array<int>, hash array<long>" if last else ", ask array<long>"
        # a row that repeats its id and text gives the same state again
        state = state.mapInPandas(_narrow(level), kept + more)
        state = scratch.save(state.dropDuplicates(["class_no"]) if not level else state)
        if level:
            scratch.drop(previous)
    blocks = state.select("class_no", "m", F.explode(F.arrays_zip("at", "to", "hash")).alias("b")).select(
        "class_no", "m", "b.at", "b.to", "b.hash")
    place = F.struct("class_no", "at")
    known = scratch.save(blocks.groupBy("hash").agg(F.sum("m").alias("n"), F.min(place).alias("speaker"))
                         .where("n > 1").select("hash", "speaker"))
    told = (blocks.join(known, "hash").groupBy("class_no").agg(F.collect_list(
        F.struct("at", "to", (place == F.col("speaker")).alias("speaks"))).alias("b"))
        .select("class_no", "b.at", "b.to", "b.speaks"))
    settled = scratch.save(state.select("class_no", "text", "stay").join(told, "class_no", "left").mapInPandas(
        _settle, "class_no long, text string, done binary, open binary, ask array<long>, tell array<long>"))
    scratch.drop(state, known)
    asked = settled.select("class_no", F.explode("ask").alias("hash"))
    votes = asked.select("hash", F.lit(1).alias("n"), F.lit(1).alias("asks")).union(
        settled.select(F.explode("tell").alias("hash"), F.lit(2).alias("n"), F.lit(0).alias("asks")))
    found = scratch.save(votes.groupBy("hash").agg(F.sum("n").alias("n"), F.max("asks").alias("asks"))
                         .where("n > 1 and asks = 1").select("hash"))
    back = asked.join(found, "hash").groupBy("class_no").agg(F.collect_set("hash").alias("again"))
    lost = (settled.select("class_no", "text", "done", "open").join(back, "class_no", "left")
            .mapInPandas(_remove, "class_no long, n_removed long, kept_sha256 string, kept string"))
    lost = classes.select("class_no", "th").join(lost.where("n_removed > 0"), "class_no").drop("class_no")
    return rows, lost


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows, lost = _repeats(docs, Scratch(docs.sparkSession, "substring"))
    return (rows.select("doc_id", "th", "n_words", "sha").join(lost.drop("kept"), "th", "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256")))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words taken out of ``text`` (what is left is
    joined by single blanks); texts without repeats are unchanged."""
    _, lost = _repeats(docs, Scratch(docs.sparkSession, "substring"))
    th = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    own_hash, left = free_names(docs, "_th", "_kept")
    lost = lost.select(F.col("th").alias(own_hash), F.col("kept").alias(left))
    return (docs.join(lost, th == F.col(own_hash), "left")
            .withColumn("text", F.coalesce(left, "text")).select(*docs.columns))


#: ``removals`` in DuckDB's SQL, from the definition: every window's text counted.
SUBSTRING_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {documents}),
words AS (SELECT r, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
spans AS (SELECT r, p, word, string_agg(word, ' ') OVER f AS k, count(*) OVER f AS n FROM words
          WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
counted AS (SELECT r, p, word, n = 35 AND count(*) OVER (PARTITION BY md5(k), n) > 1 AS again FROM spans),
judged AS (SELECT r, p, word, bool_or(again) OVER (PARTITION BY r ORDER BY p
             ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
kept AS (SELECT r, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM judged GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


ship(__name__)
