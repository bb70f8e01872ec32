"""Readers for the delivery formats seen in vendor hand-offs.

* Parquet directories and globs (including Parquet files with another
  extension, e.g. ``*.psv``);
* delimited text (comma, pipe, tab) with a header, read as strings with an
  explicit schema when one is known; gzip files cannot be split, so those
  reads are repartitioned right after the scan;
* the default data source (``spark.read.load``);
* a tab-separated code book (code, label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from idweave.functions.text import clean_label


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, glob_filter: str | None = None) -> DataFrame:
    """Parquet directory or glob; ``glob_filter`` keeps only matching file
    names (``pathGlobFilter``), e.g. ``"*.psv"``."""
    r = spark.read
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    return r.parquet(path)


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   columns: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Delimited text, every column a string (no schema inference pass).

    Empty fields come back as null. ``partitions`` repartitions after the
    scan; use it for ``.gz`` inputs, which Spark reads one file per task."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if columns:
        r = r.schema(string_schema(columns))
    df = r.csv(path)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_pipe(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Pipe-delimited file, directory or glob (plain or gzip)."""
    return read_delimited(spark, path, sep="|", **kw)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """Default data source (``spark.sql.sources.default``)."""
    return spark.read.load(path)


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (code, label) text file, plus the cleaned label
    (spaces, '$' and ',' removed; '-' -> '_')."""
    df = spark.read.option("sep", "\t").schema(string_schema(["CODE", "LABEL"])).csv(path)
    return df.select(F.trim("CODE").alias("CODE"), F.trim("LABEL").alias("LABEL"),
                     clean_label(F.col("LABEL")).alias("CLEAN_LABEL"))
