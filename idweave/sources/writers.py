"""Sinks and table lifecycle.

Plain Parquet has no transaction log, so the rules are:

* never overwrite a path that the same plan reads (Spark refuses, and a
  half-written overwrite would lose the history); write the next numbered
  snapshot directory instead and read it back;
* one logical change = one write (new and changed rows of an advance are
  published together);
* a version number is claimed by creating its marker exclusively, so two runs
  never take the same one;
* single-file CSV only on request.

Paths may be on any Hadoop file system; listing goes through the
session's Hadoop configuration, never through local ``os`` calls.
"""

from __future__ import annotations

import datetime as _dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no complete version is made of, if there is one."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def child_numbers(spark: SparkSession, root: str, files: bool = False) -> list[int]:
    """The numbers n, in order, of the child folders ``n`` or ``name=n`` of
    ``root`` (of its files, if ``files``)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    found = [st for st in fs.listStatus(p) if st.isDirectory() != files]
    tails = [st.getPath().getName().split("=")[-1] for st in found]
    return sorted(int(t) for t in tails if t.isdigit())


def next_version(spark: SparkSession, root: str) -> int:
    """Smallest integer above all child directory names of ``root``."""
    return max(child_numbers(spark, root), default=-1) + 1


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if there is one. Of several runs that try,
    one succeeds: on a local disk by the operating system's exclusive create
    (Hadoop's local file system looks first and creates then), elsewhere by
    the file system's create without overwriting."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":
            at = jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createFile(at, spark.sparkContext._gateway.new_array(
                jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def claim_version(spark: SparkSession, root: str) -> int:
    """Take the next free version number of ``root`` for this run alone. A
    claim is a marker in ``root/_claims``; a number that a dead run has
    claimed is not given out again."""
    root = root.rstrip("/")
    claimed = child_numbers(spark, f"{root}/_claims", files=True)
    version = max(next_version(spark, root), max(claimed, default=-1) + 1)
    while not create_marker(spark, f"{root}/_claims/{version}"):
        version += 1
    return version


def run_path(root: str, when: _dt.date | _dt.datetime, version: int) -> str:
    """``root/yyyy/MM/dd/<version>``."""
    return f"{root.rstrip('/')}/{when:%Y/%m/%d}/{version}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None, table: str | None = None,
                compression: str = "snappy") -> str:
    """Write ``df`` to ``path`` (optionally registering ``table`` over it).

    ``mode``: ``overwrite`` (replace; atomic per job, no separate drop),
    ``errorifexists`` (create only), ``append``."""
    w = df.write.mode(mode).format(fmt).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return path


def append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows (columns aligned by name on read)."""
    return write_table(df, path, mode="append", fmt=fmt)


def write_next(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next numbered child of ``root``, a number claimed
    for it; returns its path. Used for history snapshots and backups (never
    overwrites)."""
    path = f"{root.rstrip('/')}/{claim_version(df.sparkSession, root)}"
    return write_table(df, path, mode="errorifexists")


def write_lookup(df: DataFrame, path: str, keys: list[str], distinct: int = 1_000_000,
                 row_group: int = 8 << 20, mode: str = "errorifexists") -> str:
    """Write ``df`` for lookups of single keys: rows sorted by ``keys`` inside
    each file, so that row groups and pages cover narrow ranges, and a Parquet
    Bloom filter of each key column per row group (for ``distinct`` values),
    so that a reader with ``key = value`` skips the others unread. Nothing is
    shuffled."""
    w = df.sortWithinPartitions(*keys).write.mode(mode).option("parquet.block.size", row_group)
    for k in keys:
        w = (w.option(f"parquet.bloom.filter.enabled#{k}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{k}", distinct))
    w.parquet(path)
    return path


def backup(df: DataFrame, root: str) -> str:
    """Copy a table into the next numbered backup directory."""
    return write_next(df, root)


def export_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def report_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> str:
    """CSV report, one file per partition; ``single_file`` puts all of it in
    one file, for which one task writes everything."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)
    return path


def drop_table(spark: SparkSession, name: str, view: bool = False) -> None:
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {name}")
