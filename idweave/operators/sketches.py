"""Sketches of key sets that keep rows out of a shuffle.

* ``key_filter``: a Bloom filter of a table's keys, cut into words of 64
  bits. A key sets ``PROBES`` bits of one word, so building the filter is one
  aggregate, ``bit_or`` by word, reduced map-side, and asking it is one
  lookup. ``maybe_in`` keeps the rows whose key may be in it: all that are,
  and few others while there are some ten bits a key. With more keys it lets
  more rows pass and never loses one.
* ``duplicate_keys``: a count-min sketch tells keys that occur once. Each key
  is counted in ``DEPTH`` cells of its own hash; a cell with one row proves
  that its key is unique. Only keys of which all cells have two rows or more
  are shuffled and counted exactly.

Both are broadcast as blocks of ``BLOCK`` words, and both have a fixed size
whatever the tables hold: ``bits / 8`` bytes, at most ``MOST_BITS / 8``
(64 MB).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.functions.ids import key_hash

BLOCK = 64
BITS = 1 << 25
MOST_BITS = 1 << 29
PROBES = 4
DEPTH = 3
_WORD = 64


def _checked(bits: int) -> int:
    if bits % (_WORD * BLOCK) or not 0 < bits <= MOST_BITS:
        raise ValueError(f"bits must be a multiple of {_WORD * BLOCK}, at most {MOST_BITS}")
    return bits // _WORD


def _bit(number: Column) -> Column:
    """A word with the bit set that the low six bits of ``number`` name."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def _blocks(words: DataFrame) -> DataFrame:
    """(_word, _mask) rows -> (_block, _words): ``BLOCK`` words in a row."""
    merged = words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    place = (F.col("_word") % BLOCK).cast("int")
    held = merged.groupBy((F.floor(F.col("_word") / BLOCK)).cast("int").alias("_block")).agg(
        F.map_from_entries(F.collect_list(F.struct(place, "_mask"))).alias("_by_place"))
    return held.select("_block", F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK - 1)),
        lambda i: F.coalesce(F.try_element_at("_by_place", i), F.lit(0).cast("long"))).alias("_words"))


def _holding(rows: DataFrame, blocks: DataFrame, word: Column, mask: Column) -> DataFrame:
    """The rows of which all bits of ``mask`` are set in their word."""
    asked = rows.withColumns({"_w": word, "_m": mask})
    found = asked.join(F.broadcast(blocks), F.floor(asked["_w"] / BLOCK).cast("int") == blocks["_block"])
    held = F.get("_words", (F.col("_w") % BLOCK).cast("int")).bitwiseAND(F.col("_m")) == F.col("_m")
    return found.where(held).select(*rows.columns)


def _place(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """(word, mask) of a key in a filter."""
    probes = key_hash(keys, 4)
    bits = [_bit(F.shiftrightunsigned(probes, 6 * i)) for i in range(PROBES)]
    return F.pmod(key_hash(keys, 3), F.lit(words)), reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """A Bloom filter of the keys of ``df`` (nulls are values)."""
    word, mask = _place(keys, _checked(bits))
    return _blocks(df.select(word.alias("_word"), mask.alias("_mask")))


def maybe_in(rows: DataFrame, blocks: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose key may be in the filter; ``keys`` in its order and of
    its types, ``bits`` as it was made with."""
    word, mask = _place(keys, _checked(bits))
    return _holding(rows, blocks, word, mask)


def repeated(df: DataFrame, keys: Sequence[str], bits: int = BITS, depth: int = DEPTH) -> DataFrame:
    """The rows whose key may occur more than once: all whose key does."""
    cells = _checked(bits) * _WORD
    cell = [F.pmod(key_hash(keys, 5 + d), F.lit(cells)) for d in range(depth)]
    for at in cell:
        counted = df.select(at.alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        crowded = _blocks(counted.select(F.floor(F.col("_cell") / _WORD).alias("_word"), _bit(F.col("_cell")).alias("_mask")))
        df = _holding(df, crowded, F.floor(at / _WORD), _bit(at))
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "count", bits: int = BITS,
                   depth: int = DEPTH) -> DataFrame:
    """``audit.duplicate_keys``: keys that occur more than once with their
    number. The sketch's passes shuffle cell numbers and counts, reduced
    map-side and fewer from pass to pass; keys are shuffled only for what is
    left."""
    return (repeated(df, keys, bits, depth).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))
