"""Helpers shared by the training-data operators.

* ``Scratch``: intermediate tables in the cluster's shared checkpoint
  folder. They cut lineage, survive lost executors and can be dropped once
  a later table holds what they were needed for.
* Word and n-gram hashing on numpy arrays, used inside Arrow tasks.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))


def ship(module: str) -> None:
    """Pickle the functions of ``module`` by value, so that executors need
    not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


class Scratch:
    """Tables below the shared checkpoint folder, one folder per use."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = ensure_checkpoint_dir(spark).rstrip("/")
        self.path = f"{root}/idweave-tables/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return a scan of what was written."""
        self.count += 1
        path = f"{self.path}/t{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove tables that nothing reads any more."""
        jvm = self.spark._jvm
        for table in tables:
            path = getattr(table, "_scratch_path", None)
            if path:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def free_names(table: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened by ``_`` until no column of ``table`` and no
    other of them has it: for columns that are added while the caller's own
    ones are carried along."""
    taken, out = {c.lower() for c in table.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.size(F.array_remove(parts, "")).cast("long")


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six
    characters of ``SPACE``, ``bytes.lower`` changes A-Z alone."""
    raw = text.encode("utf-8", "replace")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that any bits can be compared."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` word hashes: a polynomial by prefix
    sums, so its cost does not depend on ``n``."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    power = np.full(len(hashes), _BASE)
    power[0] = 1
    power = np.cumprod(power)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power)])
    back = np.full(count, _INVERSE)
    back[0] = 1
    return mixed((total[n:] - total[:count]) * np.cumprod(back))


def crc32_fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


ship(__name__)
