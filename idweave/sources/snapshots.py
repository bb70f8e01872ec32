"""Versioned match snapshots as an explicit ``v`` partition.

The reference keeps each matching run as a table version and reads it
with ``@vN``. Without a transaction-log format, the same is a directory
partitioned by ``v``: a read of one version is a partition-pruned scan,
and loading a new run never rewrites earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_COL = "v"


def tag_version(df: DataFrame, version: int) -> DataFrame:
    return df.withColumn(VERSION_COL, F.lit(version).cast("int"))


def union_snapshots(frames: Sequence[DataFrame], first_version: int = 0) -> DataFrame:
    """Stack snapshots (columns aligned by name, missing ones null) with
    their version number."""
    tagged = [tag_version(df, first_version + i) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def load_snapshots(spark: SparkSession, paths: Sequence[str],
                   reader: Callable[[SparkSession, str], DataFrame], first_version: int = 0) -> DataFrame:
    """Read an ordered list of delivery files as versions first..first+n-1."""
    return union_snapshots([reader(spark, p) for p in paths], first_version)


def write_snapshots(df: DataFrame, root: str, mode: str = "append") -> str:
    """Store (or add) versions under ``root/v=N``; with dynamic partition
    overwrite only the versions present in ``df`` would be replaced."""
    df.write.mode(mode).partitionBy(VERSION_COL).parquet(root)
    return root


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Version N of a snapshot table (partition-pruned scan)."""
    return spark.read.parquet(root).where(F.col(VERSION_COL) == version).drop(VERSION_COL)


def write_runs(runs: DataFrame, path: str, mode: str = "append") -> str:
    """Add rows to the run table: what a run was made for, and its version
    ``v`` of the snapshot table."""
    runs.write.mode(mode).parquet(path)
    return path


def read_run(spark: SparkSession, root: str, runs: DataFrame, **wanted) -> DataFrame:
    """The snapshot rows of the runs whose columns have the ``wanted`` values,
    with the run's columns. The version comes from the run table while the
    query runs: the few runs found are joined on the partition column, and
    dynamic pruning reads their ``v=N`` folders alone. Runs that name one
    version give its rows once for each."""
    chosen = reduce(lambda a, b: a & b, [F.col(c) == F.lit(x) for c, x in wanted.items()])
    named = runs.where(chosen)
    return spark.read.parquet(root).join(named, VERSION_COL)
