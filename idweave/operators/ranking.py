"""Dense rank of any score inside groups of any size.

A ``dense_rank`` window brings a whole group into one task. Here only the
distinct (group, score) pairs are ordered: they are dealt to range buckets by
(group, score), numbered inside each bucket, and a group's buckets are joined
up by prefix sums of their sizes, at most one row per bucket and group. The
ranks, one row per distinct pair, are joined back by ``keyed_join``, so that
neither a hot group nor a hot score gathers its rows anywhere.

The pairs are written once with their bucket, as range bounds are sampled:
every later use must see the same buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idweave.operators.joins import keyed_join
from idweave.session import materialise


def dense_rank(df: DataFrame, group: Sequence[str], score: str, out: str = "DENSE_RANK", descending: bool = True,
               buckets: int = 200) -> DataFrame:
    """``df`` with the dense rank of ``score`` inside ``group``, from 1. Null
    scores come last and share a rank; a null group is a group."""
    group = list(group)
    place = F.desc_nulls_last(score) if descending else F.asc_nulls_last(score)
    pairs = df.select(*group, score).distinct().repartitionByRange(buckets, *group, place)
    pairs = materialise(pairs.withColumn("_bucket", F.spark_partition_id()), "ranks")
    sizes = pairs.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*group, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(place))
    numbered = pairs.withColumn("_at", within)
    ranks = keyed_join(numbered, before, [*group, "_bucket"], null_safe=True).select(
        *group, score, (F.col("_before") + F.col("_at")).alias(out))
    return keyed_join(df, ranks, [*group, score], null_safe=True)
