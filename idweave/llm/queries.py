"""Registered queries of the training-data operators: one ``opN_<name>`` each
over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm import (chat, decontaminate, html_text, langid, line_dedup, minhash, mixing, periodic, phrases, quality,
                         substring_dedup, toxicity, vectors)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, F.col("source"), F.col("lang")).drop("th")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled turns are written down as transcripts in several styles,
    and the transcripts parsed: a round trip."""
    turns = _table(spark, sf_dir, "conversations")
    model = chat.fit(turns)
    found = chat.recover(chat.lines_of(chat.transcript(turns), part="turn"), model)
    return found.select(F.col("conv").alias("conv_id"), "chunk", "at", "role",
                        F.md5(chat.render(F.col("role"), F.col("text")).cast("binary")).alias("rendered_md5"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's runs; one text in ten gets a periodic tail."""
    found = periodic.runs(_table(spark, sf_dir, "documents"), words=periodic.planted_words)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"),
                                                              (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"),
                                                   F.lit(","), r.period.cast("string"), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"),
                      period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.first_of_each(phrases.collocations(_table(spark, sf_dir, "documents")))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_vectors": op4_vectors,
    "op5_langid": op5_langid,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html": op12_html,
    "op13_phrases": op13_phrases,
}

ORACLE: dict[str, str] = {
    "op1_minhash": minhash.MINHASH_SQL.format(documents="documents"),
    "op6_substring_dedup": substring_dedup.SUBSTRING_SQL.format(documents="documents"),
    "op10_chat": f"""SELECT conv_id, floor(turn / {chat.PARTS})::BIGINT AS chunk,
        (row_number() OVER (PARTITION BY conv_id, floor(turn / {chat.PARTS}) ORDER BY turn) - 1)::BIGINT AS at,
        role, md5('<|' || role || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10)) AS rendered_md5
        FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)""",
    "op3_mixing": mixing.MIX_SQL.format(
        documents="documents",
        columns="doc_id, size, source_size, target, copies * size AS taken"),
    "op13_phrases": phrases.PHRASE_SQL.format(documents="documents"),
    "op8_line_dedup": line_dedup.LINE_SQL.format(
        documents="documents",
        columns="""o.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
            coalesce(n_removed, 0)::BIGINT AS n_removed,
            CASE WHEN o.text IS NOT NULL THEN md5(coalesce(kept, '')) END AS kept_md5"""),
}
