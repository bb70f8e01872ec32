"""One entry point for vendor deliveries: read, then align column names.

``ingest`` covers the delivery shapes of the reference's ingestion jobs:
Parquet directories or globs (also Parquet files with another extension),
comma- or pipe-delimited text with a header (plain or gzip), and the
default data source; followed by the optional name repairs (upper-case,
repeated-token repair with overrides, explicit renames).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from idweave.operators.columns import rename_columns, repair_columns, upcase_columns
from idweave.sources import readers as R


@dataclass(frozen=True)
class SourceSpec:
    path: str
    fmt: str = "parquet"                 # parquet | csv | pipe | default
    glob_filter: str | None = None       # e.g. "*.psv"
    columns: Sequence[str] | None = None  # explicit string schema for text
    partitions: int | None = None        # repartition after an unsplittable read
    upcase: bool = False
    repair: bool = False
    overrides: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)


def read_source(spark: SparkSession, s: SourceSpec) -> DataFrame:
    if s.fmt == "parquet":
        df = R.read_parquet(spark, s.path, s.glob_filter)
    elif s.fmt in ("csv", "pipe"):
        df = R.read_delimited(spark, s.path, sep="|" if s.fmt == "pipe" else ",",
                              columns=s.columns, partitions=s.partitions)
    elif s.fmt == "default":
        df = R.read_default(spark, s.path)
    else:
        raise ValueError(f"unknown format {s.fmt!r}")
    if s.partitions and s.fmt in ("parquet", "default"):
        df = df.repartition(s.partitions)
    return df


def ingest(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a delivery and apply the name rules of ``spec`` in order:
    repeated-token repair (+ overrides), upper-casing, explicit renames."""
    df = read_source(spark, spec)
    if spec.repair or spec.overrides:
        df = repair_columns(df, spec.overrides) if spec.repair else rename_columns(df, spec.overrides)
    if spec.upcase:
        df = upcase_columns(df)
    if spec.rename:
        df = rename_columns(df, spec.rename)
    return df
