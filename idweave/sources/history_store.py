"""Append-only history storage: one ``v=<n>`` partition per advance.

Every advance writes only its delta (new + changed rows, one write, so the
two never land separately); the history is the scan of all partitions.
Nothing is ever overwritten, so a reader never sees a half-replaced table
and a failed run leaves earlier versions intact. Reading "as of" version
n is a partition-pruned scan (``v <= n``).

A version counts only with its marker: ``v=<n>/_SUCCESS`` of a plain store,
``_versions/<n>`` of a table, written after the rows are in place. Rows of a
version that was cut off half-way are never read, and writing that version
again replaces them.

With ``table`` and ``buckets`` the store is a catalog table bucketed (and
sorted) by the person key: the latest view reads it without any shuffle,
and an advance (``advance_delta(..., partitions=buckets)``) shuffles only
the snapshot, never the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.sources.writers import child_numbers, create_marker, next_version, path_exists, remove

VERSION_COL = "v"


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str, table: str | None = None,
                 keys: Sequence[str] = ("B_HHID", "B_INDID"), buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.table, self.keys, self.buckets = table, tuple(keys), buckets
        if self.bucketed and not table:
            raise ValueError("a bucketed history needs a table name")

    @property
    def bucketed(self) -> bool:
        return bool(self.buckets)

    def exists(self) -> bool:
        """Whether a version is complete."""
        return bool(self.versions())

    def versions(self) -> list[int]:
        """The complete versions."""
        if self.table:
            return child_numbers(self.spark, f"{self.root}/_versions", files=True)
        return [v for v in child_numbers(self.spark, self.root) if self.has_version(v)]

    def next_version(self) -> int:
        """Next free ``v=<n>`` directory under the root (file listing, no scan)."""
        return next_version(self.spark, self.root)

    def read(self, as_of: int | None = None, with_version: bool = False) -> DataFrame:
        df = (self.spark.table(self.table) if self.table
              else self.spark.read.option("mergeSchema", True).parquet(self.root))
        complete = [v for v in self.versions() if as_of is None or v <= as_of]
        df = df.where(F.col(VERSION_COL).isin(complete))
        return df if with_version else df.drop(VERSION_COL)

    def has_version(self, version: int) -> bool:
        return path_exists(self.spark, f"{self.root}/_versions/{version}" if self.table
                           else f"{self.root}/{VERSION_COL}={version}/_SUCCESS")

    def _fitted(self, delta: DataFrame) -> DataFrame:
        """``delta`` with the stored table's columns; columns that are new in
        it are added to the table."""
        if not self.spark.catalog.tableExists(self.table):
            return delta
        stored = {f.name.upper(): f for f in self.spark.table(self.table).schema if f.name != VERSION_COL}
        given = {c.upper() for c in delta.columns}
        added = [f for f in delta.schema if f.name.upper() not in stored]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({columns})")
        return delta.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                   for name, f in stored.items() if name not in given])

    def append(self, delta: DataFrame, version: int | None = None) -> int:
        """Write ``delta`` as version ``version`` (default: next free). Columns
        may come and go between versions: a reader sees all of them, null
        where a version has none. A bucketed version is dealt by the key
        first, so it has one file per bucket at most."""
        v = self.next_version() if version is None else version
        path = f"{self.root}/{VERSION_COL}={v}"
        if self.has_version(v):
            raise FileExistsError(f"history version {v} already written")
        remove(self.spark, path)
        if self.table:
            delta = self._fitted(delta)
            if self.bucketed:
                delta = delta.repartition(self.buckets, *self.keys)
            w = (delta.withColumn(VERSION_COL, F.lit(v)).write.mode("append").format("parquet")
                 .partitionBy(VERSION_COL).option("path", self.root))
            if self.bucketed:
                w = w.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
            w.saveAsTable(self.table)
            create_marker(self.spark, f"{self.root}/_versions/{v}")
        else:
            delta.write.mode("errorifexists").parquet(path)
        return v
