"""Audits: match rates, two-way key differences, duplicate keys, regions.

The reference computes these with several ``count()`` actions and two
``subtract`` calls, each recomputing its inputs. Here both key sets are
tagged, stacked and grouped once: one shuffle with map-side reduction
answers every direction (``subtract`` semantics: distinct rows, nulls
equal to nulls), and all counts come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.ids import pair_key, split_part_or_blank
from idweave.functions.text import non_blank
from idweave.operators.joins import keyed_join


def tagged_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct key of ``left`` or ``right`` with flags
    ``IN_LEFT`` / ``IN_RIGHT`` (grouping treats nulls as equal)."""
    l = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    r = right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    return (l.unionByName(r).groupBy(*keys)
            .agg(F.max("_l").cast("boolean").alias("IN_LEFT"), F.max("_r").cast("boolean").alias("IN_RIGHT")))


def only_left(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """``left.subtract(right)`` on ``keys`` (distinct, null-safe)."""
    keys = list(keys or left.columns)
    t = tagged_keys(left.select(*keys), right, keys)
    return t.where(F.col("IN_LEFT") & ~F.col("IN_RIGHT")).select(*keys)


def key_diff(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Both directions at once: keys with ``SIDE`` 'left_only' or 'right_only'."""
    keys = list(keys or left.columns)
    t = tagged_keys(left.select(*keys), right, keys)
    side = (F.when(F.col("IN_LEFT") & ~F.col("IN_RIGHT"), F.lit("left_only"))
            .when(~F.col("IN_LEFT") & F.col("IN_RIGHT"), F.lit("right_only")))
    return t.select(*keys, side.alias("SIDE")).where(F.col("SIDE").isNotNull())


def match_rate(population: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total_population`` (distinct population keys),
    ``unique_ids`` (distinct pair keys), ``missing_from_population`` (pair
    keys not in the population), ``within_legacy`` (the reference's
    total - missing_from_population), ``missing_from_crosswalk``
    (population keys without a pair), ``matched`` and ``match_rate``
    (null on an empty population instead of a division error)."""
    t = tagged_keys(population.select(*keys), pairs.select(*keys), keys)
    il, ir = F.col("IN_LEFT").cast("long"), F.col("IN_RIGHT").cast("long")
    s = t.agg(
        F.sum(il).alias("total_population"),
        F.sum(ir).alias("unique_ids"),
        F.sum(ir * (1 - il)).alias("missing_from_population"),
        F.sum(il * (1 - ir)).alias("missing_from_crosswalk"),
    ).select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in
               ("total_population", "unique_ids", "missing_from_population", "missing_from_crosswalk")])
    return s.select(
        "total_population", "unique_ids", "missing_from_population",
        (F.col("total_population") - F.col("missing_from_population")).alias("within_legacy"),
        "missing_from_crosswalk",
        (F.col("total_population") - F.col("missing_from_crosswalk")).alias("matched"),
        F.try_divide((F.col("total_population") - F.col("missing_from_crosswalk")).cast("double"),
                     F.col("total_population").cast("double")).alias("match_rate"),
    )


def clean_pairs(pairs: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct pair rows with every one of ``cols`` non-blank."""
    cond = reduce(lambda a, b: a & b, [non_blank(F.col(c)) for c in cols])
    return pairs.where(cond).select(*cols).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "count") -> DataFrame:
    """Key groups occurring more than once, with their size (partial
    aggregation, so a hot key is counted map-side)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once (null keys never match, as
    in the equi join of the reference). Duplicate keys are found by an
    aggregate and joined back with a semi join: no window over a group."""
    dup = duplicate_keys(df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])),
                         keys).select(*keys)
    return keyed_join(df, dup, list(keys), how="left_semi")


def missing_by_key(df: DataFrame, df_key: str, population: DataFrame, pop_key: str) -> DataFrame:
    """Rows of ``df`` whose ``df_key`` is not a key of ``population``."""
    ks = population.select(F.col(pop_key).alias("_k")).distinct()
    return keyed_join(df, ks, [df_key], ["_k"], "left_anti")


def missing_regions(pairs: DataFrame, pop_new: DataFrame, pop_old: DataFrame,
                    pair_col: str = "A_PAIR", keys: Sequence[str] = ("A_HHID", "A_INDID"),
                    state_col: str = "STATE_NAME") -> DataFrame:
    """States (from the older delivery) of persons that the pair file names
    but the newer delivery lacks."""
    hh, ind = keys
    named = pairs.select(split_part_or_blank(F.col(pair_col), 0).alias(hh),
                         split_part_or_blank(F.col(pair_col), 1).alias(ind))
    gone = only_left(named, pop_new.select(*keys), list(keys))
    return keyed_join(pop_old, gone, list(keys), how="left_semi").select(state_col).distinct()


def row_counts(relations: Mapping[str, DataFrame]) -> DataFrame:
    """``(relation, n_rows)`` for every named relation, in one job."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
               .select(F.lit(name).alias("relation"), "n_rows") for name, df in relations.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def pair_keys(df: DataFrame, hhid: str, indid: str, out: str = "A_PAIR") -> DataFrame:
    """Distinct ``hhid || '_' || indid`` keys of a population."""
    return df.select(pair_key(F.col(hhid), F.col(indid)).alias(out)).distinct()
