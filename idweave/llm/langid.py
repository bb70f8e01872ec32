"""Language ID: script ranges, then Viterbi over per-word scores.

Training counts hashed character n-grams (of 1 to 3, word boundaries
counted as a character) per language, in Spark, over about
``DOCS_PER_LANGUAGE`` documents of each language (those of least crc32 among
the learning folds), and how much of each script a language uses.

A text's words each take the languages that use the word's script as
candidates (all of them if none does) and get a naive Bayes score for every
candidate. Viterbi over the words, with ``SWITCH`` nats for every change of
language, labels spans of mixed-language text. The texts of a batch run
through Viterbi together, one word each per step, in groups of similar
length and of bounded size; a text is never cut.

``lang_pred`` is the language of most letters (the first in code-point order
on ties) and ``score`` its share of the letters, weighed by how far its words
favour it over the next language.

Defined cases: null texts and texts without letters are ``und`` with score
0; without anything to learn from all texts are ``und``; null languages
and null ids are not learned from, a null id counts as held out; equal rows
get equal results; an empty table gives an empty table; extra columns pass
through ``identify`` (those in ``ADDED`` are replaced).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idweave.llm.common import crc32_fold, mixed, ship

GRAMS = (1, 2, 3)
BUCKET_BITS = 15
DOCS_PER_LANGUAGE = 1_500
SWITCH = 14.0
FOLDS, HELD_OUT = 3, 1
LEAST_USE = 0.005
#: Word scores per step of Viterbi's groups, and held at once by a task.
CELLS, HELD_CELLS = 1 << 21, 1 << 24
ADDED = ("held_out", "lang_pred", "score", "spans")
#: First code points of script ranges (Unicode blocks), by name.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "other"), (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1D00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"))
_FIRST = np.array([a for a, _ in SCRIPTS], np.uint32)
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])
_LETTER = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x33480)])
_ODD = np.uint64(0x9E3779B97F4A7C15)


def scan(text: str | None) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """A text's words of letters: n-gram buckets per length, the word of each
    of them, the script of each word, its letters."""
    code = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    inner = np.zeros(len(code), bool)
    known = code < len(_LETTER)
    inner[known] = _LETTER[code[known]]
    starts = inner.copy()
    starts[1:] &= ~inner[:-1]
    word = np.cumsum(starts) - 1
    letters = np.bincount(word[inner], minlength=int(starts.sum()))
    script = _SCRIPT[np.searchsorted(_FIRST, code[starts], "right") - 1]
    value = mixed(np.where(inner, code, 0).astype(np.uint64) * _ODD)
    buckets, where = [], []
    rolling, outside = value, np.concatenate([[0], np.cumsum(~inner)])
    for n in GRAMS:
        if n > 1:
            rolling = rolling[:-1] * _ODD + value[n - 1:]
        # nothing but letters between the ends, and not two boundaries
        within = outside[n:n + len(rolling)] - outside[:len(rolling)]
        middle = outside[max(1, n - 1):][:len(rolling)] - outside[1:1 + len(rolling)] if n > 1 else within
        at = np.flatnonzero((middle == 0) & (within < (1 if n == 1 else 2)))
        buckets.append(((rolling[at] + np.uint64(n)) * _ODD >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        where.append(np.where(inner[at], word[at], word[at] + 1))
    return buckets, where, script, letters


class Model:
    """Log probabilities of the n-grams and the scripts of each language."""

    def __init__(self, names: list[str], counts: np.ndarray, scripts: np.ndarray):
        """counts: (language, n-gram length, bucket); scripts: letters by
        (language, script)."""
        self.names = names
        smoothed = counts + 0.3
        self.log = np.log(smoothed / smoothed.sum(2, keepdims=True)).transpose(1, 2, 0).astype(np.float32).copy()
        uses = scripts >= np.maximum(1.0, LEAST_USE * scripts.sum(1, keepdims=True))
        self.uses = uses.T.copy()
        self.uses[~self.uses.any(1)] = True

    def word_scores(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) scores and the letters of each word."""
        buckets, where, script, letters = scan(text)
        out = np.zeros((len(letters), len(self.names)), np.float32)
        for n in range(len(GRAMS)):
            first = np.flatnonzero(np.diff(where[n], prepend=-1))
            if len(first):
                out[where[n][first]] += np.add.reduceat(self.log[n][buckets[n]], first, axis=0)
        if out.size:
            out -= out.max(1, keepdims=True)
            out[~self.uses[script]] = -60.0
        return out, letters

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list]]:
        """(language, score, spans) of every text; a span is (language, first
        word, words)."""
        scored = [self.word_scores(t) for t in texts]
        out: list = [("und", 0.0, [])] * len(texts)
        if not self.names:
            return out
        order = sorted((i for i in range(len(texts)) if len(scored[i][1])), key=lambda i: -len(scored[i][1]))
        a = 0
        while a < len(order):
            longest = len(scored[order[a]][1])
            group = order[a:a + max(1, CELLS // (longest * len(self.names)))]
            a += len(group)
            for i, path in zip(group, viterbi([scored[i][0] for i in group])):
                out[i] = self._summary(path, *scored[i])
        return out

    def _summary(self, path: np.ndarray, scores: np.ndarray, letters: np.ndarray) -> tuple[str, float, list]:
        mass = np.bincount(path, letters, len(self.names))
        best = int(mass.argmax())
        own = scores[path == best].sum(0)
        others = np.delete(own, best)
        margin = float(own[best] - others.max()) if len(others) else 50.0
        sure = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        cuts = np.flatnonzero(np.diff(path, prepend=-1))
        sizes = np.diff(np.append(cuts, len(path)))
        spans = [(self.names[path[c]], int(c), int(n)) for c, n in zip(cuts, sizes)]
        return self.names[best], float(mass[best] / mass.sum() * sure), spans


def viterbi(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The best language of every word of texts sorted by falling length."""
    lengths = np.array([len(t) for t in texts])
    many, languages = len(texts), texts[0].shape[1]
    score = np.zeros((lengths[0], many, languages), np.float32)
    for k, t in enumerate(texts):
        score[:len(t), k] = t
    switched = np.zeros(score.shape, bool)
    source = np.zeros(score.shape[:2], np.int16)
    value = score[0].copy()
    for t in range(1, lengths[0]):
        live = int(np.searchsorted(-lengths, -t, "left"))
        now = value[:live]
        source[t, :live] = now.argmax(1)
        jump = now.max(1, keepdims=True) - SWITCH
        switched[t, :live] = now < jump
        value[:live] = np.maximum(now, jump) + score[t, :live]
    path = np.zeros(score.shape[:2], np.int16)
    state = value.argmax(1).astype(np.int16)
    every = np.arange(many)
    for t in range(lengths[0] - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -t, "left"))
        path[t, :live] = state[:live]
        if t:
            moved = switched[t, every[:live], state[:live]]
            state[:live] = np.where(moved, source[t, :live], state[:live])
    return [path[:n, k] for k, n in enumerate(lengths)]


def fit(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Count n-grams over about ``per_language`` documents of each language."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                        & (crc32_fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", "text", "lang")
    there = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(there, key=lambda s: s.encode())
    if not names:
        return Model([], np.zeros((0, len(GRAMS), 1 << BUCKET_BITS)), np.zeros((0, len(_NAMES))))
    limit = F.element_at(F.create_map(*[F.lit(x) for k, n in there.items() for x in (
        k, min(1.0, per_language / n) * 2 ** 32)]), F.col("lang"))
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang not in total:
                    total[lang] = (np.zeros((len(GRAMS), size)), np.zeros(len(_NAMES)))
                buckets, _, script, letters = scan(text)
                for n, b in enumerate(buckets):
                    total[lang][0][n] += np.bincount(b, minlength=size)
                total[lang][1][:] += np.bincount(script, letters, len(_NAMES))
        for lang, (grams, scripts) in total.items():
            flat = np.concatenate([grams.ravel(), scripts])
            at = np.flatnonzero(flat)
            yield pd.DataFrame({"lang": lang, "at": at, "n": flat[at]})

    rows = (usable.where(F.crc32(F.concat(F.lit("sample"), F.col("doc_id").cast("string")).cast("binary")) < limit)
            .select("lang", "text").mapInPandas(count, "lang string, at long, n double")
            .groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas())
    flat = np.zeros((len(names), len(GRAMS) * size + len(_NAMES)))
    flat[[names.index(x) for x in rows["lang"]], rows["at"].to_numpy(int)] = rows["n"]
    return Model(names, flat[:, :len(GRAMS) * size].reshape(len(names), len(GRAMS), size),
                 flat[:, len(GRAMS) * size:])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` + held_out, lang_pred, score and spans (language, first word
    and number of words; words are runs of letters)."""
    names = [c for c in docs.columns if c not in ADDED]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # a text has at most one word per two characters
            cells = np.cumsum([(len(t or "") // 2 + 1) * max(1, len(model.names)) for t in batch["text"]])
            for _, part in batch.groupby(cells // HELD_CELLS, sort=True):
                found = model.label(list(part["text"]))
                yield part.assign(
                    lang_pred=[f[0] for f in found], score=[f[1] for f in found],
                    spans=[[{"lang": s, "first": c, "words": n} for s, c, n in f[2]] for f in found])

    added = StructType.fromDDL(
        "lang_pred string, score double, spans array<struct<lang: string, first: int, words: int>>")
    schema = StructType([*docs.select(*names).schema, *added])
    out = docs.select(*names).mapInPandas(judge, schema)
    held = F.coalesce(crc32_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out")
    return out.select(*names, held, "lang_pred", "score", "spans")


ship(__name__)
