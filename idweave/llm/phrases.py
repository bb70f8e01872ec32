"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends,
and pieces into words. Phrases of one to ``longest`` words are counted per
language within pieces, overlaps included.

1. ``fingerprints``: prefix polynomials over word hashes give the hash of
   every phrase of a batch of texts at once. Equal phrases of a batch are one
   row (fingerprint, check, occurrences, pointer): the language and the
   number of words are part of the fingerprint, the check is a second,
   shorter hash, and the pointer is a hash of a text that holds the phrase.
2. The shuffle adds these rows up, apart for fingerprints that collide with
   another check. What occurs fewer than ``least`` times goes; the least
   pointer stays. As it is the least hash, a few texts hold most phrases.
   Three words can only be frequent where both pairs in them are: they are
   read in a second pass, and a Bloom filter of the frequent pairs, of
   ``FILTER_BITS`` whatever their number, keeps most others out of the
   shuffle (none that is frequent).
3. ``materialise``: the texts pointed at are read once more, and the frequent
   phrases, and no others, are written out from them. A phrase is taken only
   where the words of the text give both its fingerprint and its check.
4. ``collocations``: a candidate's parts are looked up by their fingerprints,
   every cut is scored in exact decimals, and candidates inside a longer one
   that is frequent enough are dropped.

No text is shuffled but those pointed at, and no group is gathered: counts
are sums, and what comes back to a text is bounded by its words.

Defined cases: null and empty texts have no words; a null language is
``und``, as is the language of that name; equal rows count each; ids are not
read; an empty table gives an empty table; extra columns are ignored. Counts
are exact up to 10^12 occurrences of a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, mixed, ship, window_hashes, word_hashes
from idweave.llm.periodic import chunks
from idweave.operators import sketches

LEAST = 10
LONGEST = 3
INSIDE = 50
TOP = 2000
#: Parts into which the phrases of a language are dealt before they are ranked.
PARTS = 64
#: Bits of the check, beside the 62 of the fingerprint.
CHECK_BITS = 32
#: Bits of the filter of frequent pairs (16 MB).
FILTER_BITS = 1 << 27
#: Bytes of text whose phrases are merged at once.
CHUNK_BYTES = 1 << 20
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_STEP = np.uint64(0xA0761D6478BD642F)
_GRAMS = ("fp", "check", "n", "at")
_ENDED = (*_GRAMS, "head", "tail")


class Words:
    """The words of some texts as numbers, one after the other."""

    def __init__(self, texts: list[str | None], langs: list[str]):
        words: list[bytes] = []
        lengths: list[int] = []
        piece_of: list[int] = []
        for d, text in enumerate(texts):
            for piece in (text or "").encode("utf-8", "replace").lower().translate(_ENDS).split(b"\n"):
                found = piece.split()
                if found:
                    words += found
                    lengths.append(len(found))
                    piece_of.append(d)
        self.number, self.names = pd.factorize(np.array(words, dtype=object)) if words else (np.empty(0, np.int64), [])
        self.words = words
        self.piece = np.repeat(np.arange(len(lengths)), lengths)
        self.text = np.repeat(np.array(piece_of, np.int64), lengths)
        self.hashes = word_hashes(self.names)[self.number] if words else np.empty(0, np.uint64)
        self.salts = np.array([salt(lang) for lang in langs], np.uint64)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, fingerprint, check) of all phrases of n words."""
        size = max(len(self.words) - n + 1, 0)
        at = np.flatnonzero(self.piece[:size] == self.piece[n - 1:])
        return at, *signs(window_hashes(self.hashes, n)[at], self.salts[self.text[at]], n)


def salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def signs(grams: np.ndarray, salts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, check) of hashes of phrases of n words; the two low bits
    of a fingerprint are n."""
    print_ = mixed(grams ^ salts * _STEP)
    check = mixed(grams * _STEP + salts) >> np.uint64(64 - CHECK_BITS)
    return (print_ & ~np.uint64(3) | np.uint64(n)).view(np.int64), check.astype(np.int64)


def total_print(lang: str) -> int:
    """The fingerprint that stands for all words of a language."""
    return int(signs(np.zeros(1, np.uint64), np.array([salt(lang)], np.uint64), 0)[0][0])


def _texts(docs: DataFrame) -> DataFrame:
    """(at, lang, text): ``at`` is a hash of language and text."""
    lang = F.coalesce("lang", F.lit("und"))
    return docs.select(F.xxhash64(lang, F.coalesce("text", F.lit(""))).alias("at"), lang.alias("lang"), "text")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for part in chunks(pc.binary_length(batch.column("text")).fill_null(0).to_pylist(), CHUNK_BYTES):
            rows = batch.slice(part.start, part.stop - part.start)
            yield rows, Words(rows.column("text").to_pylist(), rows.column("lang").to_pylist())


def _merged(words: Words, n: int, pointers: np.ndarray, ends: bool) -> list[np.ndarray]:
    """One row per phrase of n words: fingerprint, check, occurrences, least
    pointer; with ``ends`` the fingerprints of its first and last n - 1 words."""
    at, prints, checks = words.grams(n)
    _, first, which, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    if (checks != checks[first][which]).any():
        _, first, which, count = np.unique(np.stack([prints, checks]), axis=1, return_index=True,
                                           return_inverse=True, return_counts=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, which, pointers[at])
    # by place of the first occurrence: neighbours share their pointers
    order = np.argsort(first)
    first = first[order]
    out = [prints[first], checks[first], count[order], least[order]]
    if not ends:
        return out
    shorter = np.zeros(len(words.words), np.int64)
    place, inner, _ = words.grams(n - 1)
    shorter[place] = inner
    return [*out, shorter[at[first]], shorter[at[first] + 1]]


def _totals(words: Words, langs: list[str]) -> list[np.ndarray]:
    """One row per language: all its words."""
    totals = {total_print(lang): 0 for lang in set(langs)}
    for lang, count in zip(langs, np.bincount(words.text, minlength=len(langs)).tolist()):
        totals[total_print(lang)] += count
    none = np.zeros(len(totals), np.int64)
    return [np.array(list(totals), np.int64), none, np.array(list(totals.values()), np.int64), none]


def fingerprints(docs: DataFrame, lengths: tuple[int, ...], ends: bool = False) -> DataFrame:
    """(fp, check, n, at), several rows per phrase of ``lengths`` words;
    length 0 counts all words of a language. With ``ends`` also ``head`` and
    ``tail``, the fingerprints of the phrase without its last and its first
    word."""
    columns = _ENDED if ends else _GRAMS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _batches(batches):
            pointers = rows.column("at").to_numpy()[words.text]
            for n in lengths:
                found = _merged(words, n, pointers, ends) if n else _totals(words, rows.column("lang").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=list(columns))

    return _texts(docs).mapInArrow(each, ", ".join(f"{c} long" for c in columns))


def _length() -> Column:
    return F.col("fp").bitwiseAND(F.lit(3)).cast("int")


def _frequent(grams: DataFrame, least: int) -> DataFrame:
    added = grams.groupBy("fp", "check").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    return added.where((F.col("n") >= least) | (_length() == 0))


def counts(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> DataFrame:
    """(fp, check, n, at) of the phrases of one word or more that occur
    ``least`` times, and of all words of each language."""
    short = scratch.save(_frequent(fingerprints(docs, (0, 1, 2)), least))
    pairs = scratch.save(sketches.key_filter(short.where(_length() == 2), ["fp"], FILTER_BITS))
    long = fingerprints(docs, (3,), ends=True)
    for part in ("head", "tail"):
        long = sketches.maybe_in(long, pairs, [part], FILTER_BITS)
    return scratch.save(short.unionByName(_frequent(long, least)))


_CUT = pa.struct([("k", pa.int32()), *((c, pa.int64()) for c in ("l", "lc", "r", "rc"))])
_FOUND = pa.schema([("fp", pa.int64()), ("check", pa.int64()), ("total", pa.int64()), ("lang", pa.string()),
                    ("phrase", pa.string()), ("cuts", pa.list_(_CUT))])


def _found(words: Words, langs: list[str], owner: np.ndarray, wanted: np.ndarray, checks: np.ndarray) -> list[dict]:
    """What ``materialise`` returns for some texts; ``wanted`` with ``checks``
    are fingerprints to find in the texts ``owner``."""
    prints = {n: words.grams(n) for n in range(1, LONGEST + 1)}
    place = {}
    for n, (at, _, _) in prints.items():
        place[n] = np.full(len(words.words), -1)
        place[n][at] = np.arange(len(at))
    sought = set(zip(owner.tolist(), wanted.tolist(), checks.tolist()))
    out = []
    for n in range(2, LONGEST + 1):
        at, fps, cs = prints[n]
        for k in np.flatnonzero(np.isin(fps, wanted)).tolist():
            p = int(at[k])
            d, key = int(words.text[p]), (int(fps[k]), int(cs[k]))
            if (d, *key) not in sought:
                continue
            sought.discard((d, *key))
            cuts = []
            for cut in range(1, n):
                l, r = place[cut][p], place[n - cut][p + cut]
                cuts.append({"k": cut, "l": prints[cut][1][l], "lc": prints[cut][2][l],
                             "r": prints[n - cut][1][r], "rc": prints[n - cut][2][r]})
            out.append({"fp": key[0], "check": key[1], "total": total_print(langs[d]), "lang": langs[d],
                        "phrase": b" ".join(words.words[p:p + n]).decode("utf-8", "replace"), "cuts": cuts})
    return out


def materialise(wanted: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The phrases of two words or more of ``wanted`` (fp, check, at): fp,
    check, lang, phrase, total (the fingerprint of all words of the language)
    and for each cut the fingerprints and checks of both parts."""
    lists = scratch.save(wanted.where(_length() > 1).groupBy("at").agg(
        F.collect_list(F.struct("fp", "check")).alias("wanted")))
    held = (_texts(docs).join(lists.select("at"), "at", "left_semi")
            .groupBy("at").agg(F.first("lang").alias("lang"), F.first("text").alias("text")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _batches(batches):
            lists = rows.column("wanted")
            owner = np.repeat(np.arange(len(rows)), pc.list_value_length(lists).to_numpy())
            prints, checks = (lists.flatten().field(c).to_numpy() for c in (0, 1))
            found = _found(words, rows.column("lang").to_pylist(), owner, prints, checks)
            yield pa.RecordBatch.from_pylist(found, schema=_FOUND)

    return held.join(lists, "at").select("lang", "text", "wanted").mapInArrow(
        each, "fp long, check long, total long, lang string, phrase string, "
              "cuts array<struct<k: int, l: long, lc: long, r: long, rc: long>>")


def _looked_up(table: DataFrame, counted: DataFrame, fp: str, check: str, name: str) -> DataFrame:
    """``table`` with the number of occurrences of (fp, check)."""
    by = counted.select(F.col("fp").alias(fp), F.col("check").alias(check), F.col("n").alias(name))
    return table.join(by, [fp, check])


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, fp) of all candidates that are not
    dropped for a longer one."""
    scratch = Scratch(docs.sparkSession, "phrases")
    counted = counts(docs, scratch, least)
    found = scratch.save(materialise(counted, docs, scratch))
    cuts = _looked_up(found, counted, "fp", "check", "a").select("fp", "check", "a", F.inline("cuts"))
    cuts = _looked_up(_looked_up(cuts, counted, "l", "lc", "nl"), counted, "r", "rc", "nr")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = (cuts.withColumn("over", exact("a") * exact("a") * F.lit(1000000).cast("decimal(7,0)"))
            .withColumn("under", exact("nl") * exact("nr")).withColumn("score", F.expr("over div under")))
    scored = cuts.groupBy("fp", "check").agg(
        F.min(F.struct("score", "k", "nl", "nr")).alias("cut"), F.first("a").alias("a"))
    part = lambda fp, check: F.struct(F.col(fp).alias("fp"), F.col(check).alias("check"))
    within = (cuts.withColumn("two", F.when(F.col("l").bitwiseAND(F.lit(3)) == 2, part("l", "lc"))
                              .when(F.col("r").bitwiseAND(F.lit(3)) == 2, part("r", "rc")))
              .where("two is not null").groupBy("two.fp", "two.check").agg(F.max("a").alias("longer")))
    kept = (scored.join(within, ["fp", "check"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))))
    named = kept.join(found.select("fp", "check", "total", "lang", "phrase"), ["fp", "check"])
    total = counted.where(_length() == 0).select(F.col("fp").alias("total"), "n")
    return named.join(total, "total").select(
        "lang", "phrase", "a", F.col("cut.nl").alias("l"), F.col("cut.nr").alias("r"), "n",
        F.col("cut.score").alias("score"), "fp")


def first_of_each(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language with their rank, ranked in
    two levels: no task holds more than PARTS * top of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.shiftright("fp", 8), F.lit(PARTS))
    near = (scored.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top))
    return (near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


#: ``first_of_each`` of ``collocations`` in DuckDB's SQL, from the definition.
PHRASE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\x0A-\x0D]')) AS piece FROM {documents}),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w, row_number() OVER () AS r FROM pieces),
words AS (SELECT lang, r, generate_subscripts(w, 1) AS p, unnest(w) AS a FROM cut),
runs AS (SELECT lang, a, lead(a, 1) OVER f AS b, lead(a, 2) OVER f AS c FROM words WINDOW f AS (PARTITION BY r ORDER BY p)),
f AS MATERIALIZED (
  SELECT lang, a AS phrase, 1 AS k, count(*) AS n FROM runs GROUP BY ALL
  UNION ALL SELECT lang, a || ' ' || b, 2, count(*) FROM runs WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, a || ' ' || b || ' ' || c, 3, count(*) FROM runs WHERE c IS NOT NULL GROUP BY ALL),
often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT lang, phrase, k, n, unnest(range(1, k)) AS cut_at, w FROM often),
parts AS MATERIALIZED (
  SELECT lang, phrase, k, n, cut_at, lang || '|' || array_to_string(w[:cut_at], ' ') AS x,
    lang || '|' || array_to_string(w[cut_at + 1:], ' ') AS y FROM cuts),
named AS MATERIALIZED (SELECT lang || '|' || phrase AS z, n FROM f),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.n AS a, c.cut_at, x.n AS l, y.n AS r,
    (1000000::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM parts c JOIN named x ON x.z = c.x JOIN named y ON y.z = c.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
longer AS (
  SELECT lang, phrase, max(n) AS n FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, n FROM often WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], n FROM often WHERE k = 3) GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
         WHERE o.n IS NULL OR 100 * o.n < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, totals.n AS n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


ship(__name__)
