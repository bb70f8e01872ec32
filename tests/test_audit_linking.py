"""Audit and linking operators on tiny inputs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from idweave.operators import audit as AU
from idweave.operators import linking as L
from idweave.operators.joins import keyed_join
from idweave.operators.lookups import lookup_join


def test_match_rate_counts_and_empty_population(spark):
    pop = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    pairs = spark.createDataFrame([("b",), ("c",), ("z",), (None,)], "k string")
    r = AU.match_rate(pop, pairs, ["k"]).collect()[0].asDict()
    assert r == {"total_population": 3, "unique_ids": 4, "missing_from_population": 2,
                 "within_legacy": 1, "missing_from_crosswalk": 1, "matched": 2,
                 "match_rate": 2 / 3}
    empty = pop.where("false")
    r0 = AU.match_rate(empty, pairs, ["k"]).collect()[0]
    assert r0.total_population == 0 and r0.match_rate is None


def test_key_diff_is_subtract_in_both_directions(spark):
    l = spark.createDataFrame([("a", "1"), ("b", None), ("b", None), ("c", "3")], "x string, y string")
    r = spark.createDataFrame([("b", None), ("c", "3"), ("d", "4")], "x string, y string")
    assert sorted(AU.only_left(l, r).collect()) == sorted(l.subtract(r).collect())
    assert sorted(AU.only_left(r, l).collect()) == sorted(r.subtract(l).collect())
    sides = {(row.x, row.SIDE) for row in AU.key_diff(l, r).collect()}
    assert sides == {("a", "left_only"), ("d", "right_only")}


def test_duplicates(spark):
    df = spark.createDataFrame([("h", "1", "p"), ("h", "1", "q"), ("g", "1", "p"), (None, "1", "x"),
                                (None, "1", "y")], "h string, i string, p string")
    d = {(r.h, r["count"]) for r in AU.duplicate_keys(df, ["h", "i"]).collect()}
    assert d == {("h", 2), (None, 2)}
    assert AU.duplicate_rows(df, ["h", "i"]).count() == 2   # null keys never join back


def test_rank_completeness_equals_window_with_hot_null_group(spark):
    rows = [(None, i % 5) for i in range(200)] + [("g1", 3), ("g1", 1), ("g1", 3), ("g2", 0)]
    df = spark.createDataFrame(rows, "BLOCK_GROUP string, ATTRIBUTE_COUNT int")
    got = L.rank_completeness(df)
    w = Window.partitionBy("BLOCK_GROUP").orderBy(F.col("ATTRIBUTE_COUNT").desc())
    want = df.withColumn("DENSE_RANK", F.dense_rank().over(w))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_residual_uses_two_anti_joins_not_nested_loop(spark):
    every = spark.createDataFrame([("h1", "1"), ("a1", "1"), ("z", "9")], "HHID string, INDID string")
    matched = spark.createDataFrame([("h1", "1", "a1", "1")], "B_HHID string, B_INDID string, "
                                    "A_HHID string, A_INDID string")
    out = L.residual_population(every, matched)
    assert [tuple(r) for r in out.collect()] == [("z", "9")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup_join_keeps_unmatched_and_ignores_repeats(spark):
    left = spark.createDataFrame([("s1",), ("s2",), (None,)], "state string")
    dim = spark.createDataFrame([("s1", "01"), ("s1", "01"), ("s3", "03"), (None, "x")], "name string, code string")
    out = lookup_join(left, dim, ["state"], ["name"], ["code"])
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [("s1", "01"), ("s2", None), (None, None)]


def test_hot_key_is_split_over_tasks(spark, tmp_path):
    """A third of the rows have one key; the other side is an aggregate."""
    rows = spark.range(300_000, numPartitions=12).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id) end as k", "md5(cast(id as string)) as payload")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    side = rows.groupBy("k").count()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {c: spark.conf.get(c, None) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        for how in ("left", "left_semi", "left_anti", "inner"):
            out = keyed_join(rows, side, ["k"], how=how).select("k", "payload", F.spark_partition_id().alias("task"))
            # the payload is used, or it would be pruned and the key's rows weigh nothing
            tasks = out.groupBy("task").agg(F.count("*").alias("n"), F.max("payload")).collect()
            sizes = sorted(r.n for r in tasks)
            if how != "left_anti":
                assert sum(sizes) == 300_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2], (how, sizes)
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_email_only_keeps_blank_b_keys_and_non_email_drops_them(spark):
    from idweave.operators.history import HistorySpec, initial_history
    h = initial_history(spark.createDataFrame([("R1", "T1", "1", 1.0)],
                                              "RESP_ID string, B_HHID string, B_INDID string, W double"),
                        HistorySpec(), "Q1", 1)
    pairs = spark.createDataFrame([("T1", "1", "5_1", "N"), ("  ", "1", "6_1", "N"), ("  ", "1", "7_2", "Y"),
                                   ("T1", "1", "8_1", "Y"), ("T1", "1", "9_1", None)],
                                  "B_HHID string, B_INDID string, A_PAIR string, EMAIL_FLAG string")
    ne = L.link_non_email(h, pairs)
    assert [(r.A_PAIR, r.A_HHID, r.A_INDID) for r in ne.collect()] == [("5_1", "5", "1")]
    em = L.link_email_only(h, pairs, "Q3", 4)
    assert [(r.B_HHID, r.A_HHID, r.A_INDID) for r in em.collect()] == [("", "7", "2")]
    odd = L.link_email_only(h, pairs.withColumn("A_PAIR", F.lit("nokey")), "Q3", 4, weights=("W",)).collect()
    assert [(r.W, r.A_INDID, r.PERSON_ID is None) for r in odd] == [(0.0, None, False)]
