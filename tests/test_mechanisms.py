"""Digests, sketches, the maintained latest view, run metadata, claims."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from idweave.operators import audit, digests, history as H, sketches
from idweave.sources.history_store import HistoryStore
from idweave.sources.latest_store import LatestStore
from idweave.sources.snapshots import read_run, union_snapshots, write_runs, write_snapshots
from idweave.sources.writers import claim_version, create_marker, write_next
from idweave.streaming.snapshot_stream import advance_batch

from plan_metrics import nodes, ran, shuffled_rows

SPEC = H.HistorySpec()
KEYS = ["B_HHID", "B_INDID"]


def keys(spark, rows):
    return spark.createDataFrame(rows, "B_HHID string, B_INDID string")


def rows(df):
    return sorted(df.collect(), key=repr)


# ---------------------------------------------------------------- digests
@pytest.mark.parametrize("left,right", [
    ([], []), ([("a", "1")], []), ([("a", "1")] * 2, []), ([("a", "1")] * 2, [("b", "1")] * 2),
    ([("a", "1")] * 2 + [("b", "1")] * 2, [("c", "1")] * 2 + [("d", "1")] * 2),
    ([("a", "1")] * 3 + [("b", "2")], [("a", "1"), ("b", "2")]),
    ([(None, "1"), ("x", None)], [("1", None), (None, "x")]), ([(None, None)], [(None, None)] * 2),
    ([("a", "1"), (None, "1")], [("a", "1"), ("z", "9")])])
@pytest.mark.parametrize("buckets", [3, digests.BUCKETS])
def test_digest_diff_is_the_exact_diff(spark, left, right, buckets):
    a, b = keys(spark, left), keys(spark, right)
    got = digests.key_diff_by_digest(a, b, KEYS, buckets)
    assert rows(got) == rows(audit.key_diff(a, b, KEYS))
    want = {("left_only", tuple(r)) for r in a.subtract(b).collect()} | {
        ("right_only", tuple(r)) for r in b.subtract(a).collect()}
    assert {(r.SIDE, (r.B_HHID, r.B_INDID)) for r in got.collect()} == want


def test_rows_shuffled_follow_the_differences(spark):
    n, buckets = 60_000, 256
    a = spark.range(n, numPartitions=4).select(F.concat(F.lit("h"), "id").alias("k"))
    seen = {}
    for gone in (0, 3, 30):
        b = spark.range(n, numPartitions=3).where(F.col("id") % (n // gone if gone else n + 1) != (1 if gone else n)).select(
            F.concat(F.lit("h"), "id").alias("k"))
        got = digests.key_diff_by_digest(a, b, ["k"], buckets)
        assert got.count() == gone and got.where("SIDE = 'left_only'").count() == gone
        seen[gone] = digests.differing_rows(a, b, ["k"], buckets).count()
        # the digests of 7 tasks, and the differing rows
        assert shuffled_rows(got) <= 7 * buckets + seen[gone]
    assert seen[0] == 0 and seen[3] < 3 * 2.2 * n / buckets and seen[30] < 30 * 2.2 * n / buckets
    assert shuffled_rows(audit.key_diff(a, b, ["k"])) >= 2 * n - 100


def test_digests_of_a_hot_key_and_bucket_bound(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    once = hot.distinct()
    assert digests.key_diff_by_digest(hot, once, ["k"], 1024).count() == 0
    # one bucket alone is looked into: that of the repeated key
    assert digests.digests(hot, once, ["k"], 1024).where("not EQUAL").count() == 1
    with pytest.raises(ValueError):
        digests.differing_rows(hot, once, ["k"], digests.MOST_BUCKETS + 1)


# ---------------------------------------------------------------- sketches
def test_filter_keeps_every_key_and_few_others(spark):
    mine = keys(spark, [(f"h{i}", str(i % 3)) for i in range(2000)] + [(None, "1"), ("1", None), (None, None)])
    others = keys(spark, [(f"x{i}", str(i % 3)) for i in range(20_000)] + [(None, "9"), ("9", None)])
    bits = 1 << 16
    blocks = sketches.key_filter(mine, KEYS, bits)
    assert rows(sketches.maybe_in(mine, blocks, KEYS, bits)) == rows(mine)
    assert sketches.maybe_in(others, blocks, KEYS, bits).count() < 200
    full = sketches.key_filter(others, KEYS, 1 << 14)
    assert sketches.maybe_in(others, full, KEYS, 1 << 14).count() == others.count()
    empty = sketches.key_filter(mine.limit(0), KEYS, bits)
    assert sketches.maybe_in(mine, empty, KEYS, bits).count() == 0
    for bad in (100, 0, sketches.MOST_BITS * 2):
        with pytest.raises(ValueError):
            sketches.key_filter(mine, KEYS, bad)


def snapshot(spark, rows_):
    return spark.createDataFrame(rows_, "RESP_ID string, B_HHID string, B_INDID string, W double")


@pytest.mark.parametrize("compare_to", ["all", "latest"])
def test_pruned_advance_equals_the_whole_one(spark, compare_to):
    first = snapshot(spark, [(f"M{i}", f"h{i}", "1", 1.0) for i in range(3000)]
                     + [("A", None, "1", 1.0), ("B", "h", None, 1.0), (None, "h7", "2", 0.0)])
    second = snapshot(spark, [(f"M{i + i % 2}", f"h{i}", "1", 2.0) for i in range(0, 300, 3)]
                      + [("N", f"n{i}", "1", 2.0) for i in range(20)]
                      + [("C", None, "1", 3.0), ("D", None, "2", 3.0), ("E", "h7", "2", 3.0)])
    old = H.initial_history(first, SPEC, "Q1", 1)
    want = H.advance_delta(old, second, SPEC, "Q2", 2, compare_to=compare_to, with_kind=True)
    got = H.advance_delta_pruned(old, second, SPEC, "Q2", 2, bits=1 << 18, compare_to=compare_to, with_kind=True)
    assert rows(got) == rows(want) and want.count() > 50
    assert H.concerned(old, second, SPEC, 1 << 18).count() < 110


def test_pruned_history_rows_are_not_shuffled(spark, tmp_path):
    snapshot(spark, [(f"M{i}", f"h{i}", "1", 1.0) for i in range(20_000)]).createOrReplaceTempView("_first")
    H.initial_history(spark.table("_first"), SPEC, "Q1", 1).write.parquet(str(tmp_path / "h"))
    old = spark.read.parquet(str(tmp_path / "h"))
    second = snapshot(spark, [(f"N{i}", f"h{i}", "1", 2.0) for i in range(100)])
    whole = shuffled_rows(H.advance_delta(old, second, SPEC, "Q2", 2))
    pruned = shuffled_rows(H.advance_delta_pruned(old, second, SPEC, "Q2", 2, bits=1 << 20))
    assert whole > 20_000 and pruned < 2_000


def test_duplicate_keys_by_sketch(spark):
    some = [(f"h{i}", "1") for i in range(20_000)] + [(f"h{i}", "1") for i in range(0, 20_000, 400)]
    df = keys(spark, some + [("hot", "1")] * 10_000 + [(None, "1")] * 2 + [("q", None)])
    want = rows(audit.duplicate_keys(df, KEYS))
    for bits in (1 << 14, 1 << 22):   # crowded, roomy
        assert rows(sketches.duplicate_keys(df, KEYS, bits=bits)) == want
    left = sketches.repeated(df, KEYS, 1 << 22).count()
    assert 10_102 <= left < 10_300
    assert sketches.duplicate_keys(df.limit(0), KEYS).count() == 0


# ---------------------------------------------------------------- latest view
def test_latest_store_touches_only_its_buckets(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "latest"), SPEC, buckets=16)
    assert store.read() is None
    first = snapshot(spark, [(f"M{i}", f"h{i}", "1", 1.0) for i in range(200)] + [("A", None, "1", 1.0)])
    hist = H.initial_history(first, SPEC, "Q1", 1)
    store.merge(hist, 1)
    assert rows(store.read()) == rows(H.latest(hist, SPEC))
    before = store.holders()
    delta = H.initial_history(snapshot(spark, [("X", "h5", "1", 2.0), ("Y", "h5", "1", 2.0)]), SPEC, "Q2", 2)
    store.merge(delta, 2)
    changed = {b for b, v in store.holders().items() if before.get(b) != v}
    assert len(changed) == 1 and set(before) == set(store.holders())
    hist = hist.unionByName(delta)
    assert rows(store.read()) == rows(H.latest(hist, SPEC))
    assert [r.RESP_ID for r in store.read().where("B_HHID = 'h5'").orderBy("RESP_ID").collect()] == ["X", "Y"]
    # replays, also under another number, and a delta that comes late
    for version, part in ((2, delta), (3, delta), (4, hist.where("CREATED = 1"))):
        store.merge(part, version)
        assert rows(store.read()) == rows(H.latest(hist, SPEC))
    assert rows(store.read(1)) == rows(H.latest(hist.where("CREATED = 1"), SPEC))
    assert store.versions() == [1, 2, 3, 4]


def test_merge_cut_off_before_its_commit_is_not_seen(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "latest"), SPEC, buckets=4)
    hist = H.initial_history(snapshot(spark, [("A", "h", "1", 1.0), ("B", "k", "1", 1.0)]), SPEC, "Q1", 1)
    store.merge(hist, 1)
    delta = H.initial_history(snapshot(spark, [("C", "h", "1", 1.0)]), SPEC, "Q2", 2)
    delta.withColumn("b", F.lit(0)).write.partitionBy("b").parquet(str(tmp_path / "latest" / "data" / "v=2"))
    assert rows(store.read()) == rows(H.latest(hist, SPEC))
    store.merge(delta, 2)
    assert rows(store.read()) == rows(H.latest(hist.unionByName(delta), SPEC))


# ---------------------------------------------------------------- run metadata
def test_version_from_the_run_table_reads_one_partition(spark, tmp_path):
    snaps = [snapshot(spark, [(f"M{v}{i}", f"h{i}", "1", float(v)) for i in range(50)]) for v in range(4)]
    root = write_snapshots(union_snapshots(snaps), str(tmp_path / "snaps"))
    runs = write_runs(spark.createDataFrame([("Q0", "ok", 0), ("Q1", "ok", 1), ("Q2", "bad", 2), ("Q2", "ok", 3)],
                                            "QUARTER string, STATE string, v int"), str(tmp_path / "runs"))
    found = read_run(spark, root, spark.read.parquet(runs), QUARTER="Q2", STATE="ok")
    plan = ran(found)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    read = [p.metrics().apply("numPartitions").value() for k, p in nodes(plan)
            if k == "FileSourceScanExec" and p.metrics().contains("numPartitions")]
    assert read == [1]
    assert {r.v for r in found.collect()} == {3} and found.count() == 50
    assert read_run(spark, root, spark.read.parquet(runs), QUARTER="Q9").count() == 0


# ---------------------------------------------------------------- claims
def test_concurrent_claims_differ(spark, tmp_path):
    root, taken = str(tmp_path / "out"), []
    threads = [threading.Thread(target=lambda: taken.extend(claim_version(spark, root) for _ in range(5))) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == list(range(20))
    assert write_next(spark.range(3), root) == f"{root}/20"
    assert not create_marker(spark, f"{root}/_claims/20")


@pytest.mark.parametrize("buckets", [None, 2])
def test_version_cut_off_half_way_is_written_again(spark, tmp_path, buckets):
    table = "idw_cut_off" if buckets else None
    store = HistoryStore(spark, str(tmp_path / "h"), table=table, buckets=buckets)
    first = snapshot(spark, [("A", "h", "1", 1.0)])
    second = snapshot(spark, [("B", "h", "1", 1.0), ("C", "k", "1", 1.0)])
    advance_batch(first, store, SPEC, "Q1", 1, version=1)
    advance_batch(second, store, SPEC, "Q2", 2, version=2)
    want = rows(store.read())
    os.remove(tmp_path / "h" / ("_versions/2" if buckets else "v=2/_SUCCESS"))
    assert not store.has_version(2) and store.versions() == [1]
    assert [r.RESP_ID for r in store.read().collect()] == ["A"]
    advance_batch(second, store, SPEC, "Q2", 2, version=2)
    assert rows(store.read()) == want and store.versions() == [1, 2]
    with pytest.raises(FileExistsError):
        store.append(store.read(), 2)
