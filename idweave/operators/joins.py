"""A join against a side that is unique (or reduced) per key, safe for hot
keys.

AQE splits a skewed partition of a shuffle join only where both sides are
plain shuffles that the join itself asked for. A side that comes out of an
aggregate or a ``distinct`` on the same key is already partitioned, gets no
shuffle of its own, and so the rows of one hot key all stay in one task.

``keyed_join`` joins on one struct made of the key columns. No aggregate is
partitioned by that struct, so the planner shuffles both sides for the join
(the reduced side is small) and AQE may split the hot partition of the rows
and read the reduced side next to each piece. Nothing is counted
beforehand, no key list is built, and there is no size switch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_struct(df: DataFrame, columns: Sequence[str], null_safe: bool) -> Column:
    """The key as one struct; null if a part is null, unless ``null_safe``
    (equal structs may hold equal nulls)."""
    key = F.struct(*[df[c].alias(f"k{i}") for i, c in enumerate(columns)])
    if null_safe:
        return key
    return F.when(reduce(lambda a, b: a & b, [df[c].isNotNull() for c in columns]), key)


def keyed_join(rows: DataFrame, side: DataFrame, on: Sequence[str], side_on: Sequence[str] | None = None,
               how: str = "inner", null_safe: bool = False,
               also: Callable[[], Column] | None = None) -> DataFrame:
    """``rows`` joined to ``side`` on ``on`` = ``side_on``. The result has the
    columns of ``rows`` and those of ``side`` that are not keys (none for
    semi and anti joins). ``also``: a further condition on both."""
    side_on = list(side_on or on)
    rest = [c for c in side.columns if c not in side_on]
    left = rows.withColumn("_join_key", key_struct(rows, on, null_safe))
    right = side.select(key_struct(side, side_on, null_safe).alias("_side_key"), *rest)
    cond = F.col("_join_key") == F.col("_side_key")
    if also is not None:
        cond = cond & also()
    return left.join(right, cond, how).drop("_join_key", "_side_key")
