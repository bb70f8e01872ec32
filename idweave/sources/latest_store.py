"""A stored latest view, kept current by merging each advance's delta.

``history.latest`` reads the whole history. ``LatestStore`` keeps its result,
dealt to buckets by the person key, and merges a delta by writing anew only
the buckets that hold one of its persons:

* ``root/data/v=<version>/b=<bucket>``: the buckets that one merge wrote;
* ``root/state/<version>``: which version holds each bucket after it. Writing
  this table is the commit: readers take the newest state that is complete,
  and a merge that is cut off before it leaves nothing that is ever read.

A merged bucket is the latest view of its stored rows and the delta's rows,
so it does not matter whether a delta is newer than what is stored, and a
delta merged again changes nothing: its version is found in the state, and
where it is merged under another number, equal rows are one row.

Within a merge a bucket's rows are dealt to ``SPLITS`` tasks by respondent,
and the maxima per person are partial aggregates, so a hot person neither
fills one task nor one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.functions.ids import key_hash
from idweave.operators.history import HistorySpec, latest
from idweave.sources.writers import child_numbers, path_exists

SPLITS = 4


class LatestStore:
    """``buckets`` is fixed for the life of a store; a merge collects the
    numbers of the buckets that it touches, that many at most."""

    def __init__(self, spark: SparkSession, root: str, spec: HistorySpec = HistorySpec(), buckets: int = 1024):
        self.spark, self.root, self.spec, self.buckets = spark, root.rstrip("/"), spec, buckets

    def versions(self) -> list[int]:
        """The merged versions, oldest first."""
        root = f"{self.root}/state"
        return [v for v in child_numbers(self.spark, root) if path_exists(self.spark, f"{root}/{v}/_SUCCESS")]

    def holders(self, version: int | None = None) -> dict[int, int]:
        """bucket -> the version that holds it, after ``version`` (default:
        the newest)."""
        done = self.versions()
        if not done:
            return {}
        state = self.spark.read.parquet(f"{self.root}/state/{done[-1] if version is None else version}")
        return {r.b: r.v for r in state.collect()}

    def read(self, version: int | None = None) -> DataFrame | None:
        """The latest view (after ``version``); null before the first merge."""
        holders = self.holders(version)
        return self._buckets(holders, holders) if holders else None

    def _buckets(self, holders: dict[int, int], wanted) -> DataFrame | None:
        paths = [f"{self.root}/data/v={holders[b]}/b={b}" for b in wanted if b in holders]
        if not paths:
            return None
        found = self.spark.read.option("mergeSchema", True).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.drop("v", "b")

    def merge(self, delta: DataFrame, version: int) -> int:
        """Bring the view up to date with the rows of one advance."""
        if version in self.versions():
            return version
        holders, spec = self.holders(), self.spec
        bucket = F.pmod(key_hash(spec.keys), F.lit(self.buckets)).cast("int")
        whole = delta.where(spec.key_not_null(delta))
        touched = sorted(r.b for r in whole.select(bucket.alias("b")).distinct().collect())
        stored = self._buckets(holders, touched)
        rows = whole if stored is None else stored.unionByName(whole, allowMissingColumns=True).distinct()
        split = F.pmod(F.xxhash64(spec.resp), F.lit(SPLITS))
        (latest(rows, spec).withColumn("b", bucket).repartition(F.col("b"), split)
         .write.mode("overwrite").partitionBy("b").parquet(f"{self.root}/data/v={version}"))
        written = set(child_numbers(self.spark, f"{self.root}/data/v={version}"))
        after = holders | {b: version for b in touched if b in written}
        state = self.spark.createDataFrame(sorted(after.items()), "b int, v int")
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/{version}")
        return version
