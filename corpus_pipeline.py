"""A training corpus from ``documents``: quality, line dedup, near-duplicate
removal, benchmark decontamination, mixing.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the docs of
the next. All but the last return the columns of ``documents``; the last emits
the mix: every document once per copy, with the mixing plan's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm import decontaminate, line_dedup, minhash, mixing, quality
from idweave.llm.common import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; a document of which nothing is left
    goes with them, one that came without text stays."""
    out = line_dedup.dedup_lines(docs)
    left = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays."""
    return minhash.dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The quality classifier is a trained model; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
