"""Quality classifier by hierarchical empirical Bayes.

1. Evidence: a logistic regression over surface features of the whole text
   (``features``), fitted with Newton steps on at most ``MAX_LABELLED`` labelled
   rows, the ones of least crc32 of the id. It gives each document p, its
   probability of being good before anything is known of where it is from.
2. Sites: grouped aggregates over all documents give each host and each path
   of a host its number of documents and its sum of p. The spread of the host
   rates around the global rate, and of the path rates around their host's,
   beyond what chance makes of that many documents, sets how many documents
   of prior weight each level gets (method of moments).
3. Posterior: a host's rate is shrunk to the global rate, a path's to that of
   its host; sparse sites stay close to the level above. A document itself is
   left out of the counts of its own site. Its score is the odds of its own
   evidence times the odds of its path against the global odds.

For ``documents`` the host is the source and the path the language section
of it; ``split_url`` gives both for a table with URLs.

Defined cases: null and empty texts have the features of no words and are
scored like all others; null hosts and paths are sites of their own; rows
without a 0/1 label or without a document are not learned from; a repeated
label row is learned from again; equal rows each count in their site; if
there are no labels, or only one class, p is 0.5 or that class's smoothed
rate for all; an empty table gives an empty table; extra columns pass
through ``classify`` (those in ``ADDED`` are replaced).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, crc32_fold, free_names, ship

MAX_LABELLED = 20_000
THRESHOLD = 0.5
RIDGE = 1.0
ADDED = ("evidence", "host_rate", "path_rate", "score", "accepted")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_PLAIN = b".,;:'\"-!?()"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _PLAIN)
_TAIL = re.compile(rb"[!-/:-@\[-`{-~]{2,}(?=\s|$)")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, first part of the path) of a URL."""
    return (F.lower(F.regexp_extract(url, r"^\w+://([^/?#]+)", 1)),
            F.regexp_extract(url, r"^\w+://[^/?#]+(/[^/?#]*)?", 1))


def features(text: str | None) -> list[float]:
    """Surface measures of a text, in fixed order."""
    raw = (text or "").encode("utf-8", "replace")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    share = lambda what: (size - len(raw.translate(None, what))) / size
    most = counts.most_common(3)
    return [
        math.log1p(len(words)), sum(map(len, words)) / n, share(_UPPER), share(_DIGITS), share(_SYMBOLS),
        share(b"!"), share(b"|"), share(b".,"), len(counts) / n, (most[0][1] / n) if most else 0.0,
        sum(c for _, c in most) / n, len(_TAIL.findall(raw)) / n,
        1 - len(set(lines)) / max(1, len(lines)), math.log1p(len(words) / max(1, len(lines))),
        sum(a == b for a, b in zip(words, words[1:])) / n, float(len(words) < 5)]


N_FEATURES = len(features(""))


def spread(x: np.ndarray) -> np.ndarray:
    """Shares matter from the first hundredth on: a root stretches them."""
    return np.sqrt(np.maximum(x, 0.0))


class Model:
    """Standardised logistic regression."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        x = spread(x)
        self.mean = x.mean(0) if len(x) else np.zeros(0)
        self.scale = x.std(0) + 1e-6 if len(x) else np.ones(0)
        self.weights = None
        self.rate = (y.sum() + 0.5) / (len(y) + 1.0)
        if len(y) and 0 < y.sum() < len(y):
            z = np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])
            w = np.zeros(z.shape[1])
            for _ in range(30):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                slope = z.T @ (y - p) - RIDGE * w
                w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(len(w)), slope)
            self.weights = w

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.rate)
        z = np.clip((spread(x) - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ self.weights[1:], -12, 12)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from a bounded number of labelled rows (by crc32 of the id), one
    text of an id."""
    chosen = (labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("_y"))
              .orderBy(crc32_fold(F.col("doc_id"), 1 << 32), "doc_id", "_y").limit(max_labelled))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["_y"], "x": [features(t) for t in batch["text"]]})

    # of rows that share a chosen id, the text of least hash
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_y")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")).select("_y", "text")
            .mapInPandas(measure, "y double, x array<double>").toPandas())
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows["y"][i], list(rows["x"][i])))]
    return Model(np.array(rows["x"].tolist(), float).reshape(-1, N_FEATURES), rows["y"].to_numpy(float))


def prior_weight(groups: int, n: float, nn: float, between: float, rate: float) -> float:
    """Documents of weight that a level's rate gets as the prior of the
    groups below it. between: sum of n * (group rate - rate of the level)
    squared; nn: sum of n * n over n of the level."""
    chance = rate * (1 - rate)
    if groups < 2 or n - nn <= 0 or chance <= 0:
        return 10.0
    share = min(0.999, max(1e-4, (between - (groups - 1) * chance) / (n - nn) / chance))
    return (1 - share) / share


def logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (F.lit(1.0) - safe))


def scored(docs: DataFrame, model: Model, host: Column, path: Column,
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th) + ADDED for every row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([features(t) for t in batch["text"]], float).reshape(-1, N_FEATURES)
            yield batch.drop(columns="text").assign(evidence=model.predict(x))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = scratch.save(
        docs.select("doc_id", "text", F.xxhash64("text").alias("th"), host.cast("string").alias("host"),
                    path.cast("string").alias("path"))
        .mapInPandas(evidence, f"doc_id {kind}, th long, host string, path string, evidence double"))
    paths = scratch.save(rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("s")))
    hosts = scratch.save(paths.groupBy("host").agg(
        F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.count(F.lit(1)).alias("parts"),
        (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("nn"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss")))
    # n * (rate - level rate)^2 summed over groups is sum of s*s/n - S*S/N
    top = hosts.agg(
        F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("hn") * F.col("hn")).alias("nn"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("ss"),
        F.sum("parts").alias("parts"), F.sum("nn").alias("pn"),
        F.sum(F.col("ss") - F.col("hs") * F.col("hs") / F.col("hn")).alias("within")).first()
    n = top["n"] or 1
    rate = min(1 - 1e-6, max(1e-6, (top["s"] or 0.5) / n))
    host_weight = prior_weight(top["hosts"], n, (top["nn"] or 0) / n, (top["ss"] or 0) - n * rate * rate, rate)
    path_weight = prior_weight((top["parts"] or 0) - top["hosts"] + 1, n, top["pn"] or 0, top["within"] or 0, rate)
    sites = scratch.save(paths.join(hosts.select("host", "hn", "hs").withColumnRenamed("host", "_h"),
                                    F.col("host").eqNullSafe(F.col("_h")))
                         .select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", "s", "hn", "hs"))
    at = rows.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    own = F.col("evidence")
    host_rate = (F.col("hs") - own + host_weight * rate) / (F.col("hn") - 1 + host_weight)
    path_rate = (F.col("s") - own + path_weight * F.col("host_rate")) / (F.col("n") - 1 + path_weight)
    odds = logit(own) - logit(F.lit(rate)) + logit(F.col("path_rate"))
    return (at.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
            .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
            .withColumn("accepted", F.col("score") >= threshold)
            .select("doc_id", "th", *ADDED))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
             label: str = "quality") -> DataFrame:
    """``docs`` + ADDED."""
    model = fit(docs, labels, label)
    own_id, own_hash = free_names(docs, "_id", "_th")
    out = _one_each(scored(docs, model, host if host is not None else F.col("source"),
                           path if path is not None else F.col("lang")), own_id, own_hash)
    names = [c for c in docs.columns if c not in ADDED]
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash))
    return docs.select(*names).join(out, same).select(*names, *ADDED)


def accepted(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
             label: str = "quality") -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    own_id, own_hash = free_names(docs, "_id", "_th")
    out = _one_each(scored(docs, fit(docs, labels, label), host if host is not None else F.col("source"),
                           path if path is not None else F.col("lang")), own_id, own_hash)
    out = out.where("accepted").select(own_id, own_hash)
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash))
    return docs.join(out, same, "left_semi")


def _one_each(found: DataFrame, own_id: str, own_hash: str) -> DataFrame:
    """Rows of one id and text differ in their site at most: they get the
    least result of them."""
    return found.groupBy(F.col("doc_id").alias(own_id), F.col("th").alias(own_hash)).agg(
        *[F.min(c).alias(c) for c in ADDED])


ship(__name__)
