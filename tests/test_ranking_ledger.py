"""Dense rank of any score, vendor members, the load ledger, lookups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from idweave.operators import history as H, linking as L
from idweave.operators.ranking import dense_rank
from idweave.sources import readers as R
from idweave.sources.ledger import Ledger
from idweave.sources.writers import write_lookup

from plan_metrics import nodes, ran


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_against_the_window(spark, descending):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.34 else rng.choice(["a", "b", None, "c"]), rng.choice([None, -0.0, 0.0, rng.random() * 40,
             float(rng.randrange(30)), 1e300])) for _ in range(3000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, g string, s double")
    order = F.desc_nulls_last("s") if descending else F.asc_nulls_last("s")
    want = df.withColumn("DENSE_RANK", F.dense_rank().over(Window.partitionBy("g").orderBy(order)))
    assert rows(dense_rank(df, ["g"], "s", descending=descending, buckets=13)) == rows(want)
    assert dense_rank(df.limit(0), ["g"], "s").count() == 0


def test_dense_rank_gathers_no_group(spark):
    """No window of the ranking sees more than a bucket of a group."""
    df = spark.range(30_000).select("id", F.lit("hot").alias("g"), (F.col("id") * 7919 % 30_011).cast("double").alias("s"))
    ranked = dense_rank(df, ["g"], "s", buckets=30)
    assert ranked.agg(F.max("DENSE_RANK")).first()[0] == 30_000
    windows = [p for k, p in nodes(ran(ranked)) if k == "WindowExec"]
    assert windows and all("_bucket" in p.toString() for p in windows)


def norm(spark, vendor, pairs):
    return spark.createDataFrame([(r, *k) for r, k in pairs], f"RESP_ID string, {vendor}_HHID string, {vendor}_INDID string")


def test_members_expand_to_the_match(spark):
    rng = random.Random(2)
    some = lambda n: [(rng.choice(["r1", "r2", "r3", " ", None, "r4"]), (f"h{rng.randrange(9)}", str(rng.randrange(3)))) for _ in range(n)]
    a, b = norm(spark, "A", some(60) + [("only_a", ("h", "1"))]), norm(spark, "B", some(60) + [("only_b", ("h", "1"))])
    members = L.vendor_members(a, b)
    match = L.vendor_match(a, b)
    assert rows(L.expand_members(members)) == rows(match)
    one = {(r.RESP_ID, r.SIDE): (r.HHID, r.INDID) for r in members.where("IS_REPRESENTATIVE").collect()}
    assert members.where("IS_REPRESENTATIVE").count() == len(one) == 2 * match.select("RESP_ID").distinct().count()
    everyone = a.select(F.col("A_HHID").alias("HHID"), F.col("A_INDID").alias("INDID")).distinct()
    assert rows(L.residual_of_members(everyone, members)) == rows(L.residual_population(everyone, match))


def test_members_of_a_hot_respondent_are_linear(spark):
    a = norm(spark, "A", [("hot", (f"a{i}", "1")) for i in range(2000)])
    b = norm(spark, "B", [("hot", (f"b{i}", "1")) for i in range(1500)])
    members = L.vendor_members(a, b)
    made = [p.metrics().apply("numOutputRows").value() for k, p in nodes(ran(members)) if k.endswith("JoinExec")]
    assert members.count() == 3500 and max(made) <= 3500


def test_ledger_loads_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    read = []

    def reader(s, path):
        read.append(path)
        return R.read_delimited(s, path)

    def deliver(name, *keys):
        (landing / name).write_text("RESP_ID,B_HHID\n" + "".join(f"{k},h\n" for k in keys))

    ledger = Ledger(spark, str(tmp_path / "loads"))
    pattern = f"{landing}/*.csv"
    assert ledger.load_new(pattern, reader) == []
    deliver("q1.csv", "A", "B")
    deliver("q2.csv", "C")
    assert ledger.load_new(pattern, reader) == [0, 1]
    read.clear()
    assert ledger.load_new(pattern, reader) == [] and read == []
    deliver("q3.csv", "D")
    deliver("q1.csv", "A", "B", "E")    # replaced
    # a load that was cut off before its ledger row leaves rows that do not count
    spark.createDataFrame([("Z", "h")], "RESP_ID string, B_HHID string").write.parquet(f"{ledger.snapshots}/v=2")
    assert sorted(r.RESP_ID for r in ledger.read().collect()) == ["A", "B", "C"]
    assert ledger.load_new(pattern, reader) == [2, 3] and len(read) == 2
    assert sorted((r.v, r.RESP_ID) for r in ledger.read().collect()) == [
        (0, "A"), (0, "B"), (1, "C"), (2, "A"), (2, "B"), (2, "E"), (3, "D")]
    assert ledger.entries().count() == 4


def test_lookup_skips_row_groups(spark, tmp_path):
    people = spark.range(60_000, numPartitions=2).select(
        F.md5(F.col("id").cast("string")).alias("B_HHID"), (F.col("id") % 3).cast("string").alias("B_INDID"), "id")
    path = write_lookup(people, str(tmp_path / "h"), ["B_HHID", "B_INDID"], distinct=5000, row_group=64 << 10)
    plain = str(tmp_path / "plain")
    people.write.option("parquet.block.size", 64 << 10).parquet(plain)
    key = people.where("id = 777").first().B_HHID
    seen = {}
    for name, at in (("lookup", path), ("plain", plain)):
        found = H.person_history(spark.read.parquet(at), {"B_HHID": key})
        seen[name] = sum(p.metrics().apply("numOutputRows").value() for k, p in nodes(ran(found)) if k == "FileSourceScanExec")
        assert [r.id for r in found.collect()] == [777]
    assert seen["lookup"] < seen["plain"] / 3 and seen["lookup"] < 15_000


def test_residual_within_source(spark):
    match = spark.createDataFrame([("R", "7", "1", "8", "2")], "RESP_ID string, B_HHID string, B_INDID string, A_HHID string, A_INDID string")
    who = spark.createDataFrame([("A", "7", "1"), ("B", "7", "1"), ("A", "8", "2"), ("B", "8", "2"), ("C", "7", "1"),
                                 ("A", None, "1"), (None, "7", "1")], "DATA_SOURCE string, HHID string, INDID string")
    got = L.residual_within_source(who, match)
    assert rows(got) == sorted(map(repr, [r for r in who.collect() if (r[0], r[1]) not in (("B", "7"), ("A", "8"))]))
    assert L.residual_population(who, match).count() == 1


def test_stored_views_split_a_hot_key(spark, tmp_path):
    from idweave.sources.catalog import publish_stored_views, save_table
    hist = spark.createDataFrame([("A", "h", "1", 1), ("B", "h", "1", 2), ("C", None, "1", 3), ("D", "k", "2", 1)],
                                 "RESP_ID string, B_HHID string, B_INDID string, CREATED int")
    save_table(hist, "idw_views", path=str(tmp_path / "t"))
    save_table(hist.where("RESP_ID in ('C', 'D')"), "idw_views_snap", path=str(tmp_path / "s"))
    publish_stored_views(spark, "idw_views", "idw_views", {"v1": "idw_views_snap"})
    assert sorted(r.RESP_ID for r in spark.table("idw_views_latest").collect()) == ["B", "D"]
    assert [r.RESP_ID for r in spark.table("idw_views_v1").collect()] == ["D"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("idw_views_latest")._jdf.queryExecution().executedPlan().toString()
        # both sides are shuffled for the join: neither is the aggregate's own partitioning
        joins = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "struct(" in x or "_groupingexpression" in x or "k#" in x and "Exchange" in x]
        assert "SortMergeJoin" in plan and len(joins) >= 2, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
