"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is cut into passages of ``PASSAGE`` words. A passage is the bag of the
character n-grams of its words (word boundaries count as a character), each
hashed to one of ``BUCKETS`` rows of an embedding table; the rows are averaged
and go through a linear softmax over two classes. Table and softmax are
trained jointly, with Adagrad in numpy. A misspelt word shares most of its
n-grams with the word it was, so it is recognised unseen.

Labels are of whole documents, and one passage makes a document toxic.
Training therefore chooses: of a toxic document the passages that its
n-grams point to (at first by how much oftener toxic documents have them,
then by the model itself), against the most suspicious and some other
passages of clean documents. A document's score is a logistic function,
fitted on documents that were not trained on, of its highest passage
logits and its length.

At most ``MAX_LABELLED`` documents are learned from, those of least crc32 of
their id among the ones whose crc32 is not 1 modulo 3. Scores read the
whole text, one document at a time.

Defined cases: null and empty texts are one passage without n-grams; labels
that are not 0 or 1 and labels of missing documents are not learned from; a
repeated label row is learned once more; without labels of both classes the
score is the rate of the class there is (0.5 without any); a null id counts
as held out; equal rows get equal scores; an empty table gives an empty
table; ``score`` adds its columns to any others and replaces its own names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import crc32_fold, mixed, ship

GRAMS = (3, 5, 6)
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 6
PASSAGE = 8
MAX_LABELLED = 4_000
THRESHOLD = 0.7
#: A toxic document let through weighs as much as this many clean ones flagged.
MISS_COST = 3.0
FOLDS, HELD_OUT = 3, 1
TOP = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalnum() and not 0xD800 <= c < 0xE000 for c in range(1 << 16)])


_LETTER = _letters()


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket, passage) of every n-gram of a text, and its passages."""
    code = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    inner = np.ones(len(code), bool)
    low = code < (1 << 16)
    inner[low] = _LETTER[code[low]]
    starts = inner.copy()
    starts[1:] &= ~inner[:-1]
    word = np.cumsum(starts) - 1
    passages = max(1, -(-int(starts.sum()) // PASSAGE))
    value = mixed(np.where(inner, code, 0).astype(np.uint64) * _ODD)
    edges = np.concatenate([[0], np.cumsum(~inner)])
    buckets, where = [], []
    rolling = value
    for n in range(2, max(GRAMS) + 1):
        rolling = rolling[:-1] * _ODD + value[n - 1:]
        if n not in GRAMS or len(rolling) == 0:
            continue
        # the first and last character may be a boundary, not those between
        at = np.flatnonzero(edges[n - 1:n - 1 + len(rolling)] == edges[1:1 + len(rolling)])
        buckets.append((rolling[at] * _SPREAD >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        where.append(word[at + 1] // PASSAGE)
    if not buckets:
        return np.empty(0, np.int32), np.empty(0, np.int64), passages
    return np.concatenate(buckets), np.concatenate(where), passages


def by_passage(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets sorted by passage, and where each passage begins."""
    bucket, where, passages = grams(text)
    order = np.argsort(where, kind="stable")
    return bucket[order], np.searchsorted(where[order], np.arange(passages + 1))


def means(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of consecutive runs of rows, 0 for empty runs."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=float)])
    size = np.maximum(1, np.diff(bounds))
    return (total[bounds[1:]] - total[bounds[:-1]]) / size.reshape(-1, *[1] * (values.ndim - 1))


class Model:
    """The trained table folded with the softmax into one number a bucket
    (the two are linear), and the document-level logistic function."""

    def __init__(self, rate: float):
        self.rate, self.bucket, self.bias, self.final, self.scale = rate, None, 0.0, None, 1.0

    def logits(self, text: str | None) -> np.ndarray:
        """One logit a passage."""
        bucket, where, passages = grams(text)
        total = np.bincount(where, self.bucket[bucket], passages)
        return total / np.maximum(1, np.bincount(where, minlength=passages)) + self.bias

    def summary(self, text: str | None) -> np.ndarray:
        """What the document-level function sees."""
        logits = np.sort(np.clip(self.logits(text) / self.scale, -2, 2))[::-1]
        top = np.concatenate([logits[:TOP], np.full(max(0, TOP - len(logits)), -2.0)])
        strong = np.maximum(logits, 0).sum()
        return np.array([1.0, *top, np.log1p(strong), strong / len(logits), np.log(len(logits))])

    def score(self, text: str | None) -> float:
        if self.bucket is None:
            return float(self.rate)
        z = float(np.clip(self.summary(text) @ self.final, -30, 30))
        return float(1 / (1 + np.exp(-z)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
    return w


def _train(bags: list[np.ndarray], toxic: np.ndarray, table: np.ndarray, soft: np.ndarray,
           rng: np.random.Generator, epochs: int, memory: list[np.ndarray]) -> None:
    """Adagrad on the table and the softmax together."""
    weight = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum())) * len(toxic)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for a in range(0, len(order), 512):
            pick = order[a:a + 512]
            index = np.concatenate([bags[i] for i in pick])
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            mean = means(table[index], bounds)
            z = mean @ soft[:-1] + soft[-1]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), toxic[pick].astype(int)] -= 1
            p *= weight[pick][:, None]
            slope = np.vstack([mean.T @ p, p.sum(0)]) / len(pick) + 1e-5 * soft
            size = np.diff(bounds)
            each = np.repeat((p @ soft[:-1].T) / np.maximum(1, size)[:, None], size, axis=0)
            used, back = np.unique(index, return_inverse=True)
            own = np.stack([np.bincount(back, each[:, d], len(used)) for d in range(table.shape[1])], 1)
            own = own / 8 + 1e-5 * table[used]
            memory[0][used] += own ** 2
            table[used] -= 0.3 * own / np.sqrt(memory[0][used] + 1e-8)
            memory[1] += slope ** 2
            soft -= 0.1 * slope / np.sqrt(memory[1] + 1e-8)


def train(texts: list[str | None], labels: np.ndarray, rate: float | None = None, seed: int = 1) -> Model:
    """Learn from documents and their 0/1 labels; ``rate``: of toxic ones among
    all, where the documents given are a balanced choice."""
    drawn = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = Model(drawn if rate is None else rate)
    if len(set(labels.tolist())) < 2:
        return model
    rng = np.random.default_rng(seed)
    cut = [by_passage(t) for t in texts]
    fit = rng.random(len(texts)) < 0.75
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[~fit].tolist())) < 2:
        fit[:] = True
    count = np.zeros((2, BUCKETS))
    for (bucket, _), y, f in zip(cut, labels, fit):
        if f:
            count[int(y), np.unique(bucket)] += 1
    n = [max(1, ((labels == k) & fit).sum()) for k in (0, 1)]
    odds = np.log((count[1] + 0.5) / (n[1] + 1)) - np.log((count[0] + 0.5) / (n[0] + 1))
    suspicion = np.where(count[1] >= 2, np.maximum(odds, 0) * np.sqrt(count[1] / n[1]), 0.0)
    passage = [np.array([suspicion[b[i:j]].max(initial=0) for i, j in zip(k[:-1], k[1:])]) for b, k in cut]
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    soft = rng.normal(0, 0.1, (DIMENSIONS + 1, 2))
    memory = [np.zeros_like(table), np.zeros_like(soft)]
    for turn in range(3):
        bags, toxic = [], []
        for (bucket, k), value, y, f in zip(cut, passage, labels, fit):
            if not f:
                continue
            order = np.argsort(-value, kind="stable")
            if y:
                strong = order[value[order] >= (max(0.6 * value.max(), 1e-9) if not turn else 0.0)]
                chosen = strong[:24] if len(strong) else order[:1]
            else:
                chosen = np.unique(np.concatenate([order[:6], rng.integers(0, len(order), 8)]))
            for i in chosen:
                bags.append(bucket[k[i]:k[i + 1]])
                toxic.append(y)
        _train(bags, np.array(toxic, float), table, soft, rng, 4 if not turn else 2, memory)
        model.bucket = (table @ (soft[:-1, 1] - soft[:-1, 0]))
        model.bias = float(soft[-1, 1] - soft[-1, 0])
        passage = [means(model.bucket[b], k) + model.bias for b, k in cut]
    model.bucket = model.bucket.astype(np.float32)
    best = [p.max() for p, y, f in zip(passage, labels, fit) if y and f]
    model.scale = max(1.0, float(np.median(best)))
    rest = ~fit if (~fit).any() else fit
    x = np.array([model.summary(t) for t, r in zip(texts, rest) if r])
    model.final = logistic(x, labels[rest])
    model.final[0] += (np.log(model.rate / (1 - model.rate)) - np.log(drawn / (1 - drawn))
                       + np.log(MISS_COST))
    return model


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from a bounded number of labelled documents of the learning folds,
    half of them toxic as far as there are as many; of an id, one text."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & (crc32_fold(F.col("doc_id"), FOLDS) != HELD_OUT))
              .select("doc_id", F.col("toxic").alias("_y")))
    toxic, every = usable.agg(F.sum("_y"), F.count(F.lit(1))).first()
    order = [crc32_fold(F.col("doc_id"), 1 << 32), "doc_id"]
    chosen = (usable.where("_y = 1").orderBy(*order).limit(max_labelled // 2)
              .union(usable.where("_y = 0").orderBy(*order).limit(max_labelled // 2)))
    # of rows that share a chosen id, the text of least hash
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_y")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")).collect())
    rows.sort(key=lambda r: (r.doc_id, r._y, r.text or ""))
    return train([r.text for r in rows], np.array([float(r._y) for r in rows]),
                 ((toxic or 0) + 0.5) / ((every or 0) + 1.0))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` + held_out, score, predicted."""
    added = ("held_out", "score", "predicted")
    names = [c for c in docs.columns if c not in added]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=[model.score(t) for t in batch["text"]])

    schema = docs.select(*names).schema.add("score", "double")
    out = docs.select(*names).mapInPandas(judge, schema)
    return out.select(
        *names, F.coalesce(crc32_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


ship(__name__)
