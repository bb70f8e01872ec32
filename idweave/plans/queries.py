"""Registered queries: each ``q_*`` takes ``(spark, sf_dir)`` and returns a
DataFrame computed from the driver's tables (through the fixtures), so its
work grows with the scale factor. ``idweave.plans.oracle`` holds the
matching DuckDB SQL for every key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.functions import ids as I
from idweave.functions.geo import geo_parts, legacy_group, legacy_tract, restate
from idweave.functions.demographics import age_from_birth_year, income_from_thousands
from idweave.functions.text import zero_pad
from idweave.operators import audit as AU
from idweave.operators import digests as D
from idweave.operators import history as H
from idweave.operators import linking as L
from idweave.operators import normalise as N
from idweave.operators import sketches as SK
from idweave.operators.columns import repair_columns, upcase_columns
from idweave.operators.ranking import dense_rank
from idweave.operators.lookups import block_lookup, geo_lookup, id_resolution
from idweave.session import configure, scratch_path
from idweave.sources.fixtures import Fixtures
from idweave.sources.latest_store import LatestStore
from idweave.sources.writers import write_lookup
from idweave.sources.snapshots import read_run, union_snapshots, write_runs, write_snapshots

# --- fixed run parameters of the registered queries ------------------------
RUN_YEAR = 2024
QUARTERS = {1: "Q1", 2: "Q2", 3: "Q3"}
LINK_QUARTER = "Q3"
LINK_CREATED = 4
PERSON_KEY = {"B_HHID": "T10", "B_INDID": "3"}
# --------------------------------------------------------------------------

SPEC = H.HistorySpec()
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: Queries over stored tables, which they write while they are built.
STORED: set[str] = set()


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def stored_query(fn: Query) -> Query:
    STORED.add(fn.__name__)
    return query(fn)


def meta(v: int) -> dict:
    return {"snapshot": v}


class Run:
    """Fixtures plus the history built from snapshots 1..3.

    A history refers to its predecessor several times, so an unshared
    chain of advances grows exponentially in plan size (three advances
    planned 1,267 exchanges). Within a query each advanced history is
    therefore persisted (memory, spilling to disk) and computed once; the
    cache replaces its subtree, so plans stay linear, and a lost block is
    recomputed from the (two-step) lineage. The production path writes every
    version instead (``sources.history_store.HistoryStore``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, only: dict[str, str] | None = None):
        configure(spark)
        self.fx = Fixtures(spark, sf_dir)
        self.only = only
        self._hist: dict[int, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def m(self, v: int) -> DataFrame:
        return H.person_history(self.fx.match(v), self.only) if self.only else self.fx.match(v)

    def h1(self) -> DataFrame:
        return H.initial_history(self.m(1), SPEC, QUARTERS[1], 1, meta(1))

    def h(self, upto: int) -> DataFrame:
        """History after snapshot ``upto``. The initial load is only the
        stamped snapshot (one scan, no shuffle), so it is read as is; every
        advanced history is computed once per query."""
        if upto == 1:
            return self.h1()
        if upto not in self._hist:
            hist = H.advance(self.h(upto - 1), self.m(upto), SPEC, QUARTERS[upto], upto, meta(upto))
            self._hist[upto] = hist.persist(StorageLevel.MEMORY_AND_DISK)
        return self._hist[upto]

    def _reused(self, name: str, build) -> DataFrame:
        """An intermediate read by several branches of one query: persisted
        (memory, spilling to disk) so it is computed once; a lost block is
        recomputed from its lineage."""
        if name not in self._tables:
            self._tables[name] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self._tables[name]

    def norm_a(self, reused: bool = False) -> DataFrame:
        fx = self.fx
        build = lambda: N.normalise_a(fx.population_a(), fx.geo, fx.blocks, fx.id_res, RUN_YEAR)
        return self._reused("norm_a", build) if reused else build()

    def norm_b(self, reused: bool = False) -> DataFrame:
        build = lambda: N.normalise_b(self.fx.population_b(), self.fx.id_res_b)
        return self._reused("norm_b", build) if reused else build()

    def everyone(self, reused: bool = False) -> DataFrame:
        return N.everyone(self.norm_a(reused), self.norm_b(reused))

    def residual(self, reused: bool = True) -> DataFrame:
        matched = L.vendor_match(self.norm_a(reused), self.norm_b(reused))
        return L.with_attribute_count(L.residual_population(self.everyone(reused), matched))

    def clean_pairs(self) -> DataFrame:
        return AU.clean_pairs(self.fx.vendor_xwalk, ["B_HHID", "B_INDID", "A_PAIR"])

    def pair_ids(self) -> DataFrame:
        return self.clean_pairs().select("A_PAIR").distinct()

    def pop_a_pairs(self) -> DataFrame:
        return AU.pair_keys(self.fx.current_a, "A_HHID", "A_INDID")

    def population_union(self) -> DataFrame:
        keys = ["B_HHID", "B_INDID"]
        return self.fx.pop_b.select(*keys).union(self.m(3).select(*keys)).distinct()


# ------------------------------------------------------------------ history
@query
def q_initial_history(spark, sf):
    return Run(spark, sf).h1()


@query
def q_new_records_v2(spark, sf):
    r = Run(spark, sf)
    return H.new_records(r.m(2), r.h1(), SPEC, QUARTERS[2], 2, meta(2))


@query
def q_changed_records_v3(spark, sf):
    r = Run(spark, sf)
    h2 = r.h(2)
    new3 = H.new_records(r.m(3), h2, SPEC, QUARTERS[3], 3, meta(3))
    return H.changed_records(r.m(3), h2.unionByName(new3), SPEC, QUARTERS[3], 3, meta(3))


@query
def q_advance_delta_v3(spark, sf):
    r = Run(spark, sf)
    return H.advance_delta(r.h(2), r.m(3), SPEC, QUARTERS[3], 3, meta(3))


@query
def q_history_after_v3(spark, sf):
    r = Run(spark, sf)
    return H.advance(r.h(2), r.m(3), SPEC, QUARTERS[3], 3, meta(3))


@query
def q_latest(spark, sf):
    return H.latest(Run(spark, sf).h(3), SPEC)


@stored_query
def q_latest_maintained(spark, sf):
    """The stored latest view after three merges, and snapshot 3 merged
    again under its own number and another one."""
    r = Run(spark, sf)
    store = LatestStore(spark, scratch_path(spark, "latest"), SPEC, buckets=64)
    history = r.h(3)
    for v, again in ((1, 1), (2, 2), (3, 3), (3, 3), (3, 4)):
        store.merge(history.where(F.col(SPEC.created) == v), again)
    return store.read()


@query
def q_advance_pruned(spark, sf):
    r = Run(spark, sf)
    return H.advance_delta_pruned(r.h(2), r.m(3), SPEC, QUARTERS[3], 3, meta(3))


@stored_query
def q_snapshot_of_run(spark, sf):
    """The stored snapshot that the run table names for a quarter."""
    r = Run(spark, sf)
    root, runs = scratch_path(spark, "snapshots"), scratch_path(spark, "runs")
    write_snapshots(union_snapshots([r.m(1), r.m(2), r.m(3)], first_version=1), root)
    made = spark.read.parquet(root).groupBy("v").agg(F.count(F.lit(1)).alias("N_ROWS"))
    write_runs(made.withColumn("QUARTER", F.concat(F.lit("Q"), F.col("v").cast("string"))), runs)
    return read_run(spark, root, spark.read.parquet(runs), QUARTER=QUARTERS[2])


@query
def q_stale_after_reversion(spark, sf):
    r = Run(spark, sf)
    return H.stale_latest(r.h(3), r.m(3), SPEC)


@query
def q_snapshot_members(spark, sf):
    r = Run(spark, sf)
    return H.members_of(r.h(3), r.m(2), SPEC)


@query
def q_snapshot_union(spark, sf):
    r = Run(spark, sf)
    return union_snapshots([r.m(1), r.m(2), r.m(3)], first_version=1)


@query
def q_person_history(spark, sf):
    """The key is looked up in the snapshots first, so that every scan and
    aggregate of the advances sees one person's rows."""
    return Run(spark, sf, only=PERSON_KEY).h(3)


@stored_query
def q_person_lookup(spark, sf):
    """One person's rows of the stored history, past its row groups'
    filters."""
    path = write_lookup(Run(spark, sf).h(3), scratch_path(spark, "lookup"), list(SPEC.keys))
    return H.person_history(spark.read.parquet(path), PERSON_KEY)


@query
def q_dedup_by_key(spark, sf):
    r = Run(spark, sf)
    u = union_snapshots([r.m(1), r.m(2), r.m(3)], first_version=1)
    return H.dedup_by_key(u, ["B_HHID", "B_INDID"],
                          ["RESP_ID", "v", "GEO_CODE", "PERSON_WGT", "HOUSEHOLD_WGT"])


@query
def q_history_with_match(spark, sf):
    r = Run(spark, sf)
    return H.confirmed_by(r.h(3), r.m(3), SPEC)


@query
def q_respondent_history(spark, sf):
    r = Run(spark, sf)
    return H.rows_of_respondents(r.h(3), r.m(3), SPEC)


# ------------------------------------------------------------------ ids
@query
def q_person_id(spark, sf):
    m1 = Run(spark, sf).m(1)
    return m1.select("RESP_ID", "B_HHID", "B_INDID",
                     I.person_id("B_HHID", "B_INDID").alias("PERSON_ID"))


@query
def q_pair_key(spark, sf):
    p = Run(spark, sf).fx.pop_a
    return p.select("A_HHID", "A_INDID", I.pair_key("A_HHID", "A_INDID").alias("A_PAIR"))


@query
def q_split_pair(spark, sf):
    x = Run(spark, sf).fx.vendor_xwalk
    return x.select(
        "A_PAIR",
        I.split_part("A_PAIR", 0).alias("A_HHID"), I.split_part("A_PAIR", 1).alias("A_INDID"),
        I.split_part("A_PAIR", 2).alias("A_PIECE3"),
        I.split_part_or_blank("A_PAIR", 0).alias("A_HHID_OR_BLANK"),
        I.split_part_or_blank("A_PAIR", 2).alias("A_PIECE3_OR_BLANK"))


# ------------------------------------------------------------------ linking
@query
def q_link_non_email(spark, sf):
    r = Run(spark, sf)
    return L.link_non_email(r.h(3), r.fx.vendor_xwalk, SPEC, meta={"link": "non_email"})


@query
def q_link_email_only(spark, sf):
    r = Run(spark, sf)
    return L.link_email_only(r.h(3), r.fx.vendor_xwalk, LINK_QUARTER, LINK_CREATED, SPEC,
                             meta={"link": "email"})


@query
def q_linked_history(spark, sf):
    r = Run(spark, sf)
    h3 = r.h(3)
    return L.linked_history(
        L.link_non_email(h3, r.fx.vendor_xwalk, SPEC, meta={"link": "non_email"}),
        L.link_email_only(h3, r.fx.vendor_xwalk, LINK_QUARTER, LINK_CREATED, SPEC,
                          meta={"link": "email"}))


@query
def q_vendor_match(spark, sf):
    r = Run(spark, sf)
    return L.vendor_match(r.norm_a(), r.norm_b())


@query
def q_vendor_match_previous(spark, sf):
    """The match united with an earlier crosswalk: what the B resolution file
    says of persons that both vendors know by one key."""
    r = Run(spark, sf)
    b = r.fx.id_res_b.withColumn("A_HHID", F.expr("substring(B_HHID, 2)")).withColumn("A_INDID", F.col("B_INDID"))
    known = b.join(r.fx.pop_a_old, ["A_HHID", "A_INDID"])
    earlier = known.select("RESP_ID", "B_HHID", "B_INDID", "A_HHID", "A_INDID",
                           I.person_id("B_HHID", "B_INDID").alias("PERSON_ID"))
    return L.vendor_match(r.norm_a(), r.norm_b(), previous=earlier)


@query
def q_vendor_members(spark, sf):
    r = Run(spark, sf)
    return L.vendor_members(r.norm_a(), r.norm_b())


@query
def q_residual_of_members(spark, sf):
    r = Run(spark, sf)
    members = L.vendor_members(r.norm_a(True), r.norm_b(True))
    return L.residual_of_members(r.everyone(True), members)


@query
def q_everyone(spark, sf):
    return Run(spark, sf).everyone()


@query
def q_residual_population(spark, sf):
    r = Run(spark, sf)
    matched = L.vendor_match(r.norm_a(True), r.norm_b(True))
    return L.residual_population(r.everyone(True), matched)


@query
def q_residual_within_source(spark, sf):
    """Keys as vendor A has them on both sides, so that one key may be matched
    by one vendor and not by the other."""
    r = Run(spark, sf)
    matched = L.vendor_match(r.norm_a(True), r.norm_b(True)).withColumn("B_HHID", F.expr("substring(B_HHID, 2)"))
    plain = F.when(F.col("DATA_SOURCE") == "B", F.expr("substring(HHID, 2)")).otherwise(F.col("HHID"))
    return L.residual_within_source(r.everyone(True).withColumn("HHID", plain), matched)


@query
def q_attribute_count(spark, sf):
    return Run(spark, sf).residual()


@query
def q_rank_completeness(spark, sf):
    r = Run(spark, sf)
    return L.rank_completeness(r._reused("residual", r.residual))


@stored_query
def q_dense_rank_weight(spark, sf):
    """Dense rank of every snapshot row by its weight inside its region."""
    r = Run(spark, sf)
    return dense_rank(union_snapshots([r.m(1), r.m(2), r.m(3)], first_version=1), ["GEO_CODE"], "PERSON_WGT", buckets=8)


@query
def q_initial_crosswalk_left(spark, sf):
    fx = Run(spark, sf).fx
    return L.panel_crosswalk(fx.pop_b, fx.id_res_b, "Q2", 0)


@query
def q_append_attributes(spark, sf):
    fx = Run(spark, sf).fx
    res = fx.id_res_b.select("RESP_ID", "B_HHID",
                             I.pair_key("B_HHID", "B_INDID").alias("EXTERN_ID"))
    pop = fx.coded_b.select("*", I.pair_key("B_HHID", "B_INDID").alias("B_PAIR"))
    return L.append_attributes(res, pop, "EXTERN_ID", "B_PAIR")


# ------------------------------------------------------------------ normalisation
@query
def q_geo_lookup(spark, sf):
    fx = Run(spark, sf).fx
    return geo_lookup(fx.pop_a.select("A_HHID", "A_INDID", "STATE_NAME"), fx.geo)


@query
def q_block_lookup(spark, sf):
    fx = Run(spark, sf).fx
    return block_lookup(fx.pop_a.select("A_HHID", "A_INDID"), fx.blocks)


@query
def q_id_resolution(spark, sf):
    fx = Run(spark, sf).fx
    return id_resolution(fx.pop_a.select("A_HHID", "A_INDID"), fx.id_res)


@query
def q_block_codes(spark, sf):
    fx = Run(spark, sf).fx
    df = block_lookup(geo_lookup(fx.pop_a.select("A_HHID", "A_INDID", "STATE_NAME"), fx.geo),
                      fx.blocks)
    bg = restate(F.col("FIPS_STATE"), F.col("BLOCK_GROUP"), 12)
    return df.select(
        "A_HHID", "A_INDID", "FIPS_STATE", "BLOCK", "BLOCK_GROUP",
        restate(F.col("FIPS_STATE"), F.col("BLOCK"), 15).alias("BLOCK_ID"),
        bg.alias("BLOCK_GROUP_ID"), legacy_tract(bg).alias("FIPS_CENSUS_TRACT"),
        legacy_group(bg).alias("FIPS_BLOCK_GROUP"), *geo_parts(bg))


@query
def q_fips_concat(spark, sf):
    return N.label_b(Run(spark, sf).fx.population_b()).select("B_HHID", "B_INDID", "FIPS")


@query
def q_zero_pad(spark, sf):
    a = Run(spark, sf).fx.pop_a_attr
    return a.select("A_HHID", "A_INDID", "A_COUNTY", zero_pad("A_COUNTY", 3).alias("FIPS_COUNTY_CODE"))


@query
def q_income_scale(spark, sf):
    a = Run(spark, sf).fx.pop_a_attr
    return a.select("A_HHID", "A_INDID", "A_INCOME_K", income_from_thousands("A_INCOME_K").alias("INCOME"))


@query
def q_age(spark, sf):
    a = Run(spark, sf).fx.pop_a_attr
    return a.select("A_HHID", "A_INDID", "A_BIRTH_YEAR",
                    age_from_birth_year("A_BIRTH_YEAR", RUN_YEAR).alias("AGE"))


A_FLAGS = ["HISPANIC", "BLACK", "MALE", "FEMALE", "MARRIED", "SINGLE", "FULL_TIME_EMPLOYMENT",
           "PART_TIME_EMPLOYMENT", "SOME_HIGH_SCHOOL", "HIGH_SCHOOL_DIPLOMA", "BACHELORS_DEGREE",
           "SOME_COLLEGE", "GRADUATE_DEGREE", "PRESENCE_OF_CHILDREN"]
RECODED = ["GENDER_VALUE", "MARITAL_STATUS_VALUE", "EMPLOYMENT_STATUS_VALUE"]


@query
def q_recode_a(spark, sf):
    return N.recode_a(Run(spark, sf).fx.population_a()).select("A_HHID", "A_INDID", *RECODED)


@query
def q_flags_a(spark, sf):
    df = N.flags_a(N.recode_a(Run(spark, sf).fx.population_a()))
    return df.select("A_HHID", "A_INDID", *A_FLAGS)


@query
def q_recode_b(spark, sf):
    return N.recode_b(N.label_b(Run(spark, sf).fx.population_b())).select("B_HHID", "B_INDID", *RECODED)


@query
def q_flags_b(spark, sf):
    df = N.flags_b(N.recode_b(N.label_b(Run(spark, sf).fx.population_b())))
    return df.select("B_HHID", "B_INDID", *A_FLAGS)


@query
def q_normalise_a(spark, sf):
    return Run(spark, sf).norm_a()


@query
def q_normalise_b(spark, sf):
    return Run(spark, sf).norm_b()


@query
def q_upcase(spark, sf):
    p = Run(spark, sf).fx.pop_a
    return upcase_columns(p.select(F.col("A_HHID").alias("a_hhid"), F.col("A_INDID").alias("A_IndId"),
                                   F.col("STATE_NAME").alias("State_Name")))


@query
def q_repair_columns(spark, sf):
    c = Run(spark, sf).fx.coded_b
    awkward = c.select("B_HHID", "B_INDID", F.col("K01_GENDER").alias("K01_GENDER_K01"),
                       F.col("K02_MARITAL").alias("K02_MARITAL__"), "K05_STATE")
    return repair_columns(awkward, {"B_HHID": "HHID", "B_INDID": "INDID"})


# ------------------------------------------------------------------ audit
@query
def q_pairs_clean(spark, sf):
    return Run(spark, sf).clean_pairs()


@query
def q_population_union(spark, sf):
    return Run(spark, sf).population_union()


@query
def q_match_rate_a(spark, sf):
    r = Run(spark, sf)
    return AU.match_rate(r.pop_a_pairs(), r.pair_ids(), ["A_PAIR"])


@query
def q_match_rate_b(spark, sf):
    r = Run(spark, sf)
    return AU.match_rate(r.population_union(), r.clean_pairs(), ["B_HHID", "B_INDID"])


@query
def q_missing_from_population(spark, sf):
    r = Run(spark, sf)
    return AU.only_left(r.pair_ids(), r.pop_a_pairs(), ["A_PAIR"])


@query
def q_missing_from_pairs(spark, sf):
    r = Run(spark, sf)
    return AU.only_left(r.pop_a_pairs(), r.pair_ids(), ["A_PAIR"])


@query
def q_key_diff(spark, sf):
    r = Run(spark, sf)
    return AU.key_diff(r.pair_ids(), r.pop_a_pairs(), ["A_PAIR"])


@query
def q_key_diff_digest(spark, sf):
    """The hand-off file against the population, both as delivered."""
    fx = Run(spark, sf).fx
    population = fx.pop_a.select(I.pair_key("A_HHID", "A_INDID").alias("A_PAIR"))
    return D.key_diff_by_digest(fx.handoff_a, population, ["A_PAIR"])


@query
def q_missing_by_key(spark, sf):
    r = Run(spark, sf)
    pop = r.fx.current_a.select(I.pair_key("A_HHID", "A_INDID").alias("A_PAIR"))
    return AU.missing_by_key(r.fx.vendor_xwalk, "A_PAIR", pop, "A_PAIR")


@query
def q_duplicate_keys(spark, sf):
    return AU.duplicate_keys(Run(spark, sf).fx.vendor_xwalk, ["B_HHID", "B_INDID"])


@query
def q_duplicate_keys_sketch(spark, sf):
    return SK.duplicate_keys(Run(spark, sf).fx.vendor_xwalk, ["B_HHID", "B_INDID"])


@query
def q_duplicate_pairs(spark, sf):
    return AU.duplicate_rows(Run(spark, sf).fx.vendor_xwalk, ["B_HHID", "B_INDID"])


@query
def q_missing_regions(spark, sf):
    fx = Run(spark, sf).fx
    return AU.missing_regions(fx.vendor_xwalk, fx.current_a, fx.pop_a_old)


@query
def q_row_counts(spark, sf):
    fx = Run(spark, sf).fx
    return AU.row_counts({
        "pop_a": fx.pop_a, "current_a": fx.current_a, "pop_b": fx.pop_b, "coded_b": fx.coded_b,
        "match_v1": fx.match(1), "match_v2": fx.match(2), "match_v3": fx.match(3),
        "vendor_xwalk": fx.vendor_xwalk, "geo": fx.geo, "blocks": fx.blocks,
        "id_res": fx.id_res, "id_res_b": fx.id_res_b,
    })
