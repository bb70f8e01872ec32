"""Sources and sinks: round trips in fresh scratch folders."""

import gzip
import os

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from idweave.operators.history import HistorySpec, latest
from idweave.sources import readers as R
from idweave.sources import writers as W
from idweave.sources.history_store import HistoryStore
from idweave.sources.snapshots import load_snapshots, read_snapshot, write_snapshots
from idweave.streaming import advance_from_stream


def test_pipe_gzip_and_csv_blank_vs_null(spark, tmp_path):
    p = tmp_path / "ids.txt.gz"
    with gzip.open(p, "wt") as f:
        f.write("C_ID|HHID|INDID\nR1|10|1\nR2||2\n")
    df = R.read_pipe(spark, str(p), partitions=4)
    assert df.columns == ["C_ID", "HHID", "INDID"] and df.rdd.getNumPartitions() == 4
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("R1", "10", "1"), ("R2", None, "2")]   # blank field comes back null
    c = tmp_path / "m.csv"
    c.write_text('a,b\n"",x\n,y\n')
    got = R.read_delimited(spark, str(c), columns=["a", "b"]).collect()
    assert [r.a for r in got] == [None, None]


def test_parquet_glob_filter_and_default_load(spark, tmp_path):
    d = tmp_path / "handoff"
    spark.range(5).coalesce(1).write.parquet(str(d / "a"))
    spark.range(3).coalesce(1).write.parquet(str(d / "b"))
    for f in os.listdir(d / "a"):
        if f.endswith(".parquet"):
            os.rename(d / "a" / f, d / "a" / (f[:-8] + ".psv"))
    for f in os.listdir(d / "b"):
        if f.endswith(".parquet"):
            os.rename(d / "b" / f, d / "a" / ("other-" + f))
    assert R.read_parquet(spark, str(d / "a"), glob_filter="*.psv").count() == 5
    assert R.read_parquet(spark, str(d / "a") + "/*.psv").count() == 5
    assert R.read_default(spark, str(d / "a")).count() == 8


def test_codebook(spark, tmp_path):
    p = tmp_path / "codes.txt"
    p.write_text("C1\tEstimated Household Income\nC2\tEstimated Household Income $35,000 - $44,999\n")
    out = {r.CODE: r.CLEAN_LABEL for r in R.read_codebook(spark, str(p)).collect()}
    assert out == {"C1": "EstimatedHouseholdIncome", "C2": "EstimatedHouseholdIncome35000_44999"}


def test_writers_versions_and_reports(spark, tmp_path):
    root = str(tmp_path / "backup")
    assert W.next_version(spark, root) == 0
    df = spark.range(3)
    p0 = W.backup(df, root)
    p1 = W.backup(df, root)
    assert p0.endswith("/0") and p1.endswith("/1") and W.next_version(spark, root) == 2
    with pytest.raises(Exception):
        W.write_table(df, p0, mode="errorifexists")
    W.report_csv(df, str(tmp_path / "rep"))
    W.report_csv(df.repartition(3), str(tmp_path / "rep2"), single_file=True)
    assert len([f for f in os.listdir(tmp_path / "rep2") if f.endswith(".csv")]) == 1
    assert spark.read.csv(str(tmp_path / "rep"), header=True).count() == df.count()
    import datetime as dt
    assert W.run_path("/r", dt.date(2024, 4, 1), 3) == "/r/2024/04/01/3"


def test_snapshots_partition_pruning(spark, tmp_path):
    files = []
    for i in range(3):
        p = str(tmp_path / f"snap{i}.csv")
        spark.createDataFrame([(f"M{i}", "h", "1")], "RESP_ID string, B_HHID string, B_INDID string") \
            .coalesce(1).write.option("header", True).csv(p)
        files.append(p)
    u = load_snapshots(spark, files, lambda s, p: R.read_delimited(s, p), first_version=1)
    root = str(tmp_path / "snaps")
    write_snapshots(u, root)
    v2 = read_snapshot(spark, root, 2)
    assert [r.RESP_ID for r in v2.collect()] == ["M1"]
    plan = v2._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "v#" in plan


def test_history_store_and_stream(spark, tmp_path):
    schema = StructType([StructField(n, StringType()) for n in ("RESP_ID", "B_HHID", "B_INDID")]
                        + [StructField("W", DoubleType()), StructField("v", StringType())])
    landing = tmp_path / "landing"
    rows = {1: [("A", "h", "1", 1.0)], 2: [("B", "h", "1", 1.0), ("A", "k", "1", 2.0)],
            3: [("A", "h", "1", 1.0)]}
    for v, rs in rows.items():
        spark.createDataFrame([(*r, str(v)) for r in rs], schema).coalesce(1) \
            .write.parquet(str(landing / f"batch{v}"))
    store_root = str(tmp_path / "history")
    q = advance_from_stream(spark, str(landing) + "/*", schema, store_root,
                            str(tmp_path / "ckpt"), spec=HistorySpec())
    q.awaitTermination(300)
    store = HistoryStore(spark, store_root)
    hist = store.read()
    assert hist.count() == 3          # A; then B (changed) and k (new); v3 adds nothing
    assert sorted(r.RESP_ID for r in latest(hist, HistorySpec()).collect()) == ["A", "B"]
    assert store.read(as_of=0).count() == 0 and store.read(as_of=1).count() == 1
    # restart: the stream checkpoint remembers the consumed files
    q2 = advance_from_stream(spark, str(landing) + "/*", schema, store_root,
                             str(tmp_path / "ckpt"), spec=HistorySpec())
    q2.awaitTermination(300)
    assert store.read().count() == 3


def test_ingest_catalog_and_sql_functions(spark, tmp_path):
    from idweave.functions.sql import register_sql_functions
    from idweave.sources.catalog import publish_views, save_table
    from idweave.sources.ingest import SourceSpec, ingest
    p = tmp_path / "pop.txt"
    p.write_text("MA1_MA1|IN1_RESP_ID|b_extern_id\nx|R1|7\n")
    df = ingest(spark, SourceSpec(str(p), fmt="pipe", repair=True, overrides={"IN1_RESP_ID": "RESP_ID"},
                                  upcase=True))
    assert df.columns == ["MA1", "RESP_ID", "B_EXTERN_ID"]
    register_sql_functions(spark)
    r = spark.sql("select pair_part('10_2', 1) a, pair_part_or_blank('7', 1) b, "
                  "person_key_id('T1', '1') = md5('T1|1') c").collect()[0]
    assert (r.a, r.b, r.c) == ("2", "", True)
    plan = spark.sql("select pair_part(A, 0) from values ('1_2') as t(A)")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Python" not in plan
    hist = spark.createDataFrame([("A", "h", "1", 1), ("B", "h", "1", 2)],
                                 "RESP_ID string, B_HHID string, B_INDID string, CREATED int")
    names = publish_views(spark, hist, "xw", {"v2": hist.where("CREATED = 2")})
    assert names == ["xw", "xw_latest", "xw_v2"]
    assert spark.table("xw_latest").count() == 1 and spark.table("xw_v2").count() == 2
    save_table(hist, "xw_table", path=str(tmp_path / "xw_table"))
    assert spark.table("xw_table").count() == 2


def test_bucketed_history_store_never_shuffles_the_history(spark, tmp_path):
    import re
    from idweave.operators import history as H
    from idweave.sources.fixtures import Fixtures
    from conftest import SF_SMALL
    spec = HistorySpec()
    fx = Fixtures(spark, SF_SMALL)
    store = HistoryStore(spark, str(tmp_path / "hist_bk"), table="idw_hist_bk", keys=spec.keys, buckets=4)
    plain = HistoryStore(spark, str(tmp_path / "hist_plain"))
    for st in (store, plain):
        st.append(H.initial_history(fx.match(1), spec, "Q1", 1))
        for v in (2, 3):
            parts = st.buckets if st.bucketed else None
            st.append(H.advance_delta(st.read(), fx.match(v), spec, f"Q{v}", v, partitions=parts))
    assert store.next_version() == 3
    for v in range(3):   # one file per bucket and version at most
        files = [f for f in os.listdir(tmp_path / "hist_bk" / f"v={v}") if f.endswith(".parquet")]
        assert len(files) <= 4
    a, b = store.read(), plain.read()
    assert a.count() == 369 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = H.advance_delta(store.read(), fx.match(3), spec, "Q3", 3, partitions=4)
        lt = H.latest(store.read(), spec, bucketed=True)
        for df in (delta, lt):
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            for i, line in enumerate(lines):
                if "FileScan" in line and "idw_hist_bk" in line:
                    # nothing between the bucketed scan and its consumer moves data
                    above = "\n".join(lines[max(0, i - 4):i])
                    assert "Exchange hashpartitioning" not in above, above
        assert "Exchange hashpartitioning" not in lt._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _linked(spark, rows):
    return spark.createDataFrame(rows, "RESP_ID string, B_HHID string, B_INDID string, PERSON_ID string, "
                                       "CREATED int, A_PAIR string")


@pytest.mark.parametrize("buckets", [None, 2])
def test_store_keeps_columns_that_versions_add(spark, tmp_path, buckets):
    table = f"idw_evolve_{buckets}" if buckets else None
    store = HistoryStore(spark, str(tmp_path / "h"), table=table, buckets=buckets)
    linked = _linked(spark, [("A", "h", "1", "p", 2, "5_1")])
    store.append(linked.drop("A_PAIR").withColumn("CREATED", linked["CREATED"] - 1))
    store.append(linked)
    store.append(linked.drop("A_PAIR"))
    got = sorted((r.CREATED, r.A_PAIR) for r in store.read().collect() if r.A_PAIR) 
    assert got == [(2, "5_1")] and store.read().count() == 3


def test_replayed_batch_adds_nothing(spark, tmp_path):
    from idweave.streaming.snapshot_stream import advance_batch
    batch = spark.createDataFrame([("A", None, "1"), ("B", "h", None), ("C", "h", "1")],
                                  "RESP_ID string, B_HHID string, B_INDID string")
    store = HistoryStore(spark, str(tmp_path / "h"))
    for _ in range(3):
        assert advance_batch(batch, store, HistorySpec(), "Q1", 1, version=1) == 1
    assert store.read().count() == 3 and store.next_version() == 2
    for v in (2, 3):
        advance_batch(batch, store, HistorySpec(), f"Q{v}", v, version=v)
    assert store.read().count() == 3
    assert store.read().where("PERSON_ID is null").count() == 0


def test_stored_views_outlive_their_session(spark, tmp_path):
    from idweave.sources.catalog import publish_stored_views, save_table
    rows = [("A", "h", "1", "p", 1, None), ("B", "h", "1", "p", 2, None), ("C", "k", "1", "q", 1, None),
            ("D", None, "1", "r", 9, None)]
    save_table(_linked(spark, rows), "idw_pv", path=str(tmp_path / "t"))
    save_table(_linked(spark, rows[2:3]).select("B_HHID", "B_INDID"), "idw_pv_snap", path=str(tmp_path / "s"))
    assert publish_stored_views(spark, "idw_pv", "idw_pv", {"v2": "idw_pv_snap"}) == ["idw_pv_latest", "idw_pv_v2"]
    other = spark.newSession()
    assert sorted(r.RESP_ID for r in other.table("idw_pv_latest").collect()) == ["B", "C"]
    assert [r.RESP_ID for r in other.table("idw_pv_v2").collect()] == ["C"]


def test_checkpoint_folder_is_never_local_on_a_cluster(spark, monkeypatch):
    from idweave import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
