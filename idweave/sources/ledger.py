"""A ledger of loaded delivery files.

The reference loads a fixed list of files, each as a new table version, and
loads all of them again when it is run again. ``Ledger`` remembers each file
by path, length and time of change, with the version it was loaded as.
``load_new`` lists a delivery folder, anti-joins the listing with the ledger,
and reads only files that are not in it; a replay reads none. A file that
was replaced is a new file. The snapshot rows of a file are written before
its ledger row, under the version that the ledger gives next, and overwrite
what an earlier run that was cut off left there, so each file is loaded once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from idweave.sources.snapshots import VERSION_COL
from idweave.sources.writers import _fs, path_exists

LISTING = "path string, length long, changed long"


class Ledger:
    """``root/files`` holds the ledger, ``root/snapshots/v=<n>`` the loads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshots"

    def entries(self) -> DataFrame:
        """(path, length, changed, v) of all loaded files."""
        path = f"{self.root}/files"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], f"{LISTING}, {VERSION_COL} int")
        return self.spark.read.parquet(path)

    def listing(self, pattern: str) -> DataFrame:
        """(path, length, changed) of the files that match a glob, from the
        file system's listing; no file is opened."""
        fs, p = _fs(self.spark, pattern)
        found = fs.globStatus(p) or []
        rows = [(st.getPath().toString(), st.getLen(), st.getModificationTime()) for st in found if st.isFile()]
        return self.spark.createDataFrame(rows, LISTING)

    def new_files(self, pattern: str) -> DataFrame:
        """Listed files that are not in the ledger."""
        return self.listing(pattern).join(self.entries().drop(VERSION_COL), ["path", "length", "changed"], "left_anti")

    def load_new(self, pattern: str, reader: Callable[[SparkSession, str], DataFrame]) -> list[int]:
        """Load each new file, in order of its path, as the next version of
        ``snapshots``; returns the versions."""
        last = self.entries().agg({VERSION_COL: "max"}).first()[0]
        version, loaded = -1 if last is None else last, []
        for row in self.new_files(pattern).orderBy("path").collect():  # names of new deliveries, not rows
            version += 1
            reader(self.spark, row.path).write.mode("overwrite").parquet(f"{self.snapshots}/{VERSION_COL}={version}")
            entry = self.spark.createDataFrame([(row.path, row.length, row.changed, version)], f"{LISTING}, {VERSION_COL} int")
            entry.coalesce(1).write.mode("append").parquet(f"{self.root}/files")
            loaded.append(version)
        return loaded

    def read(self) -> DataFrame:
        """All loads, with ``v``: the complete ones, those in the ledger."""
        return self.spark.read.option("mergeSchema", True).parquet(self.snapshots).join(
            self.entries().select(VERSION_COL), VERSION_COL, "left_semi")
