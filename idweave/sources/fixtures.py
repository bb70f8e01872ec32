"""Vendor-shaped relations derived from the driver's TPC-H-style tables.

The reference's inputs (vendor populations, match snapshots, pair files)
are private; these stand-ins have the same shapes and are derived with
plain Spark expressions from ``customer``, ``orders``, ``supplier`` and
``nation``, so they grow with the scale factor. Definitions follow
FIXTURES.md; the SQL oracle (idweave.plans.oracle) re-derives each one
independently in DuckDB.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.sources.readers import read_table

# --- fixed values: first and last year of each snapshot (None: open) --------
SNAPSHOT_YEARS = {1: (None, 1995), 2: (1996, 1998), 3: (1999, None)}
# --------------------------------------------------------------------------


def hh(k: Column) -> Column:
    """HH(k) = floor(k/3) as text."""
    return F.floor(k / 3).cast("bigint").cast("string")


def ind(k: Column) -> Column:
    """IND(k) = k%3+1 as text."""
    return (k % 3 + 1).cast("string")


def p2(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def _years(col: str, first: int | None, last: int | None) -> Column:
    # ranges (not year(col)) so the filter is pushed to the Parquet scan
    at = lambda year: F.lit(f"{year}-01-01").cast("timestamp_ntz")
    out = F.col(col).isNotNull() if first is None else F.col(col) >= at(first)
    return out if last is None else out & (F.col(col) < at(last + 1))


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- populations -----------------------------------------------------
    @cached_property
    def pop_a(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            hh(k).alias("A_HHID"), ind(k).alias("A_INDID"), k.alias("pk"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("STATE_NAME"),
            F.col("c_nationkey"),
            F.when((k % 5).isin(0, 1), "Male").when((k % 5).isin(2, 3), "Female").alias("A_GENDER"),
            F.when(k % 4 == 0, "Married").when((k % 4).isin(1, 2), "Never Married").alias("A_MARITAL"),
            F.when(k % 6 == 0, F.lit(None).cast("string")).when(k % 6 == 1, "x")
             .otherwise((k % 8).cast("string")).alias("A_EMPLOYMENT"),
            F.floor(k / 3).cast("bigint").alias("hh"),
        )

    @cached_property
    def pop_a_old(self) -> DataFrame:
        """An earlier A delivery: every customer, with its state."""
        k = F.col("c_custkey")
        return self.table("customer").select(
            hh(k).alias("A_HHID"), ind(k).alias("A_INDID"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("STATE_NAME"))

    @cached_property
    def current_a(self) -> DataFrame:
        """The newest A delivery: persons whose account is in debt have left."""
        k = F.col("c_custkey")
        return self.table("customer").where(F.col("c_acctbal") >= 0).select(
            hh(k).alias("A_HHID"), ind(k).alias("A_INDID"))

    @cached_property
    def handoff_a(self) -> DataFrame:
        """The pair keys of a hand-off file: the A population but for a few
        persons, and a few keys that it does not know."""
        k = F.col("c_custkey")
        known = self.table("customer").where(k % 499 != 7).select(F.concat(hh(k), F.lit("_"), ind(k)).alias("A_PAIR"))
        unknown = self.table("customer").where(k % 1000 == 1).select(F.concat(hh(k), F.lit("_9")).alias("A_PAIR"))
        return known.union(unknown)

    @cached_property
    def pop_b(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("T"), hh(k)).alias("B_HHID"), ind(k).alias("B_INDID"), k.alias("pk"))

    @cached_property
    def coded_b(self) -> DataFrame:
        pk = F.col("pk")
        return self.pop_b.select(
            "B_HHID", "B_INDID", "pk",
            F.when((pk % 5).isin(0, 1), "M").when((pk % 5).isin(2, 3), "F").otherwise("X").alias("K01_GENDER"),
            F.when(pk % 4 == 1, "S").when(pk % 4 == 2, "M").alias("K02_MARITAL"),
            F.when(pk % 7 == 0, "O").when(pk % 7 == 1, "B").when(pk % 7 == 2, "W").alias("K03_ETHNIC"),
            (pk % 2).cast("string").alias("K04_COLLEGE"),
            F.when(pk % 6 == 0, F.lit(None).cast("string")).otherwise(p2(pk % 25)).alias("K05_STATE"),
            F.lpad((pk % 300).cast("string"), 3, "0").alias("K06_COUNTY"),
            F.lpad(pk.cast("string"), 6, "0").alias("K07_TRACT"),
            (pk % 9).cast("string").alias("K08_BG"),
            (pk % 6 + 1).cast("string").alias("K09_HHSIZE"),
        )

    @staticmethod
    def _a_attr_cols(pk: Column) -> list[Column]:
        txt = lambda c: c.cast("string")
        none = F.lit(None).cast("string")
        return [
            F.when(pk % 9 == 0, none).otherwise(txt(1930 + pk % 75)).alias("A_BIRTH_YEAR"),
            F.when(pk % 8 == 0, none).otherwise(txt(20 + pk % 180)).alias("A_INCOME_K"),
            F.when(pk % 5 == 0, none).when(pk % 5 == 1, "")
             .when(pk % 5 == 2, txt(pk % 10)).when(pk % 5 == 3, txt(1000 + pk))
             .otherwise(txt(100 + pk % 800)).alias("A_COUNTY"),
            F.when(pk % 6 == 0, "HS Degree").when(pk % 6 == 1, "Less Than HS")
             .when(pk % 6 == 2, "Bachelor Degree").when(pk % 6 == 3, "Graduate Degree")
             .when(pk % 6 == 4, "Other").alias("A_EDUCATION"),
            F.when(pk % 4 == 0, "Y").when(pk % 4 == 1, "F").when(pk % 4 == 2, "W").alias("A_ETHNIC"),
            F.when(pk % 7 == 0, none).otherwise(txt(pk % 3)).alias("A_CHILDREN"),
            txt(1 + pk % 6).alias("A_PEOPLE"), txt(1 + pk % 3).alias("A_ADULTS"),
            txt(1 + pk % 12).alias("A_BIRTH_MONTH"),
        ]

    @cached_property
    def pop_a_attr(self) -> DataFrame:
        return self.pop_a.select("A_HHID", "A_INDID", "pk", *self._a_attr_cols(F.col("pk")))

    @staticmethod
    def _b_attr_cols(pk: Column) -> list[Column]:
        return [
            (pk % 2).cast("string").alias("K10_CHILDREN"),
            F.when(pk % 5 == 0, "1").when(pk % 5 == 1, "0").alias("K11_GRADUATE"),
            F.when(pk % 3 == 0, "1").otherwise("0").alias("K12_HIGH_SCHOOL"),
            (18 + pk % 70).cast("string").alias("K13_AGE"),
        ]

    @cached_property
    def coded_b_attr(self) -> DataFrame:
        return self.pop_b.select("B_HHID", "B_INDID", "pk", *self._b_attr_cols(F.col("pk")))

    # ---- snapshots and pair file ----------------------------------------
    def match(self, version: int) -> DataFrame:
        k = F.col("o_custkey")
        o = self.table("orders").where(_years("o_orderdate", *SNAPSHOT_YEARS[version]))
        g = o.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("_n"), F.max("o_totalprice").alias("PERSON_WGT"),
            F.min("o_totalprice").alias("HOUSEHOLD_WGT"))
        return g.select(
            F.concat(F.lit("M"), F.col("_n").cast("string")).alias("RESP_ID"),
            F.concat(F.lit("T"), hh(k)).alias("B_HHID"), ind(k).alias("B_INDID"),
            (k % 25).alias("GEO_CODE"), "PERSON_WGT", "HOUSEHOLD_WGT")

    @cached_property
    def vendor_xwalk(self) -> DataFrame:
        k, ok = F.col("o_custkey"), F.col("o_orderkey")
        o = self.table("orders")
        k2 = F.when(F.col("o_orderpriority") == "1-URGENT", k + 1).otherwise(k)
        return o.select(
            F.when(ok % 50 == 0, F.lit("  ")).otherwise(F.concat(F.lit("T"), hh(k))).alias("B_HHID"),
            ind(k).alias("B_INDID"),
            F.concat(hh(k2), F.lit("_"), ind(k2)).alias("A_PAIR"),
            F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
             .alias("EMAIL_FLAG"))

    # ---- lookups ---------------------------------------------------------
    @cached_property
    def geo(self) -> DataFrame:
        s = self.table("supplier").select("s_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name")
        return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
            F.col("n_name").alias("STATE_NAME"), p2(F.col("n_nationkey")).alias("FIPS_STATE"))

    @cached_property
    def blocks(self) -> DataFrame:
        k = F.col("c_custkey")
        nat = p2(F.col("c_nationkey"))
        code = (k * 7919).cast("string")
        return self.table("customer").where(F.col("c_mktsegment") != "MACHINERY").select(
            hh(k).alias("A_HHID"), ind(k).alias("A_INDID"),
            F.concat(nat, F.lpad(code, 13, "0")).alias("BLOCK"),
            F.when(k % 5 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(nat, F.lpad(code, 10, "0"))).alias("BLOCK_GROUP"))

    @cached_property
    def id_res(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").where(F.col("c_mktsegment") != "BUILDING").select(
            hh(k).alias("A_HHID"), ind(k).alias("A_INDID"),
            F.concat(F.lit("R"), F.floor(k / 2).cast("bigint").cast("string")).alias("RESP_ID"))

    @cached_property
    def id_res_b(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").where(F.col("c_mktsegment") != "HOUSEHOLD").select(
            F.concat(F.lit("T"), hh(k)).alias("B_HHID"), ind(k).alias("B_INDID"),
            F.concat(F.lit("R"), F.floor(k / 2).cast("bigint").cast("string")).alias("RESP_ID"))

    # ---- convenience -----------------------------------------------------
    def population_a(self) -> DataFrame:
        """Vendor A population with its attributes in one projection (a real
        delivery carries them in one file; no self-join)."""
        return self.pop_a.select("*", *self._a_attr_cols(F.col("pk")))

    def population_b(self) -> DataFrame:
        """Vendor B population with all coded columns in one projection."""
        return self.coded_b.select("*", *self._b_attr_cols(F.col("pk")))
