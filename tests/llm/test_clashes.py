"""Columns of the caller that have the names operators use inside."""

import pytest
from pyspark.sql import functions as F

from idweave.llm import decontaminate, line_dedup, minhash, mixing, quality, substring_dedup, vectors

NAMES = ["_id", "_th", "_c", "_again", "_row", "row", "_h", "_class", "_cell", "_rank", "_lines", "_firsts", "_md5",
         "_kept", "h", "m", "d0", "d1", "of", "j", "part", "th", "c", "n", "digest", "class_no"]


@pytest.fixture()
def wide(frame):
    """Documents with a column of each name that holds the name and the id."""
    def make(rows):
        df = frame(rows)
        return df.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    return make


def whole(out):
    """Every clashing column came through unchanged."""
    found = out.collect()
    assert found
    for r in found:
        assert all(r[n] == f"{n}{r.doc_id}" for n in NAMES)
    return found


TEXT = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, TEXT), (2, TEXT), (2, TEXT), (3, f"first line here\nsecond line here\n{TEXT} tail"),
        (4, "first line here\nsecond line here\nown line here"), (5, ""), (6, "some words of its own " * 3)]


def test_stages_carry_clashing_columns(spark, wide):
    docs = wide(ROWS)
    assert sorted(r.doc_id for r in whole(minhash.dedup(docs))) == [1, 4, 5, 6]
    got = {r.doc_id: r.text for r in whole(line_dedup.dedup_lines(docs))}
    assert got[4] == "own line here"
    test = spark.createDataFrame([("q", TEXT)], "item_id string, text string")
    assert sorted(r.doc_id for r in whole(decontaminate.decontaminate(docs, test))) == [4, 5, 6]
    assert len(whole(substring_dedup.dedup(docs))) == len(ROWS)
    labels = spark.createDataFrame([(1, 1), (6, 0)], "doc_id long, quality int")
    whole(quality.accepted(docs, labels))
    assert len(whole(quality.classify(docs, labels))) == len(ROWS)


def test_mixing_carries_clashing_columns(wide):
    docs = wide(ROWS)
    assert len(whole(mixing.mix_plan(docs))) == len(ROWS)
    whole(mixing.mix(docs.withColumn("copy", F.lit("own"))))


def test_vectors_carry_clashing_columns(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "y"), (3, [0.0, 1.0], "z")],
                                  "vec_id long, embedding array<float>, _id string")
    assert sorted((r.vec_id, r._id) for r in vectors.dedup(table).collect()) == [(1, "x"), (3, "z")]


def test_line_rebuild_is_linear(frame):
    """A long text is split once, not once for each line that stays."""
    lines = [f"line number {i} of a long text" for i in range(50_000)]
    one = "\n".join(lines)
    two = "\n".join(lines[:2] + [f"other line {i}" for i in range(50_000)])
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame([(1, one), (2, two)])).collect()}
    assert got[1].text == one and got[2].n_removed == 2 and got[2].n_lines == 50_002


def test_equal_rows_share_out_the_copies(spark, frame):
    """A third of the rows are equal: what they take in all is what one row
    of their length would, and no task gets them all."""
    rows = [(None, "a b c d")] * 3000 + [(i, f"x{i} y z") for i in range(6000)]
    docs = frame(rows)
    plan = mixing.mix_plan(docs).cache()
    assert plan.count() == 9000 and plan.where("doc_id is null").count() == 3000
    # one source: everything is taken once
    assert plan.where("copies <> 1").count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = mixing.mix_plan(docs).where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in parts) < 1500
