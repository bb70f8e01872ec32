"""Reconciling two large key sets by digests.

Two deliveries of some 2.6 * 10^8 keys differ in a few thousand of them.
``key_diff`` shuffles every key of both. Here keys are dealt to buckets by
hash, and each bucket is digested in one map-side aggregate over both sides:

* the rows of the left side less those of the right side,
* the xor of a 64-bit hash of the rows of both sides,
* the sum of a second hash, left less right, in three pieces of 20 bits.

What is shuffled is one row per bucket and map task. Rows that occur equally
often on both sides cancel; nothing else does: two copies of a key on one
side vanish from the xor, but not from the count, and two copies against two
copies of another key not from the sums. A bucket whose digest is all zero
holds equal rows on both sides. Only the rows of the other buckets are
shuffled, and compared exactly there, as distinct keys: a key that one side
repeats costs its bucket a look and is no difference.

A difference is overlooked only if 64 bits of xor and 60 bits of sums both
come out as zero. Sums do not overflow below 8 * 10^12 rows a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.ids import key_hash

BUCKETS = 1 << 15
#: The list of differing buckets is broadcast: that many numbers at most.
MOST_BUCKETS = 1 << 20
PIECES, BITS = 3, 20


def _stacked(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The keys of both sides with ``_side`` (1 or -1) and ``_bucket``."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {MOST_BUCKETS}")
    both = left.select(*keys, F.lit(1).alias("_side")).unionByName(right.select(*keys, F.lit(-1).alias("_side")))
    return both.withColumn("_bucket", F.pmod(key_hash(keys), F.lit(buckets)).cast("int"))


def digests(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket with rows: ``_bucket`` and ``EQUAL``."""
    other = key_hash(keys, 1)
    pieces = [F.shiftrightunsigned(other, i * BITS).bitwiseAND(F.lit((1 << BITS) - 1)) for i in range(PIECES)]
    found = _stacked(left, right, keys, buckets).groupBy("_bucket").agg(
        F.sum(F.col("_side").cast("long")).alias("rows"), F.bit_xor(key_hash(keys, 2)).alias("xor"),
        *[F.sum(F.col("_side") * p).alias(f"sum{i}") for i, p in enumerate(pieces)])
    zero = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in ("rows", "xor", *(f"sum{i}" for i in range(PIECES)))])
    return found.select("_bucket", zero.alias("EQUAL"))


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows of both sides, with ``_side``, that lie in buckets with
    different digests."""
    differ = digests(left, right, keys, buckets).where(~F.col("EQUAL")).select("_bucket")
    return _stacked(left, right, keys, buckets).join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket")


def key_diff_by_digest(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None,
                       buckets: int = BUCKETS) -> DataFrame:
    """``audit.key_diff``: the distinct keys (nulls equal to nulls) that one
    side alone has, with ``SIDE`` 'left_only' or 'right_only'. Each input is
    scanned twice; its keys are shuffled only where digests differ."""
    keys = list(keys or left.columns)
    ends = differing_rows(left, right, keys, buckets).groupBy(*keys).agg(
        F.max("_side").alias("_most"), F.min("_side").alias("_least"))
    return ends.where(F.col("_most") == F.col("_least")).select(
        *keys, F.when(F.col("_most") > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("SIDE"))
