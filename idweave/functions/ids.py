"""Identifier expressions: deterministic person ids and pair keys.

The reference mints ids with ``uuid()`` (or a constant, or a random Python
UDF). Those values change whenever a plan is rebuilt or a task retried, so
the history could not be recomputed after an executor loss. Here an id is
a pure function of the person key: recomputing any partition gives the
same id, and once a key is in the history its id is always taken from
there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from idweave.functions.util import as_col, ColumnLike

KEY_SEP = "|"
PAIR_SEP = "_"


def person_id(*keys: ColumnLike, namespace: str | None = None) -> Column:
    """``md5(k1 || '|' || k2 ...)`` with ``\\`` and ``|`` inside a part escaped by
    ``\\``, so that no two keys give one string; null when any part is null
    (``null_person_id`` has ids for those)."""
    parts: list[Column] = []
    if namespace:
        parts += [F.lit(namespace), F.lit(KEY_SEP)]
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit(KEY_SEP))
        parts.append(F.regexp_replace(as_col(k).cast("string"), r"([\\|])", r"\\$1"))
    return F.md5(F.concat(*parts))


def null_person_id(*keys: ColumnLike, namespace: str | None = None) -> Column:
    """An id for a key with null parts: minted from which parts are null and
    the others, apart from the ids of whole keys."""
    given = [F.coalesce(F.concat(F.lit("="), as_col(k).cast("string")), F.lit("null")) for k in keys]
    return person_id(*given, namespace=f"{namespace or ''}~")


def pair_key(hhid: ColumnLike, indid: ColumnLike, sep: str = PAIR_SEP) -> Column:
    """``HHID || '_' || INDID`` (null if either side is null)."""
    return F.concat(as_col(hhid), F.lit(sep), as_col(indid))


def split_part(value: ColumnLike, index: int, sep: str = PAIR_SEP) -> Column:
    """Piece ``index`` (0-based) of ``value`` split on ``sep``.

    Null for null or empty input and for a missing piece (the reference's
    UDF raised on a missing piece)."""
    v = as_col(value)
    return F.get(F.split(F.nullif(v, F.lit("")), _regex_literal(sep)), F.lit(index))


def split_part_or_blank(value: ColumnLike, index: int, sep: str = PAIR_SEP) -> Column:
    """As :func:`split_part` but ``''`` instead of null (SQL-registered
    variant used by the region audit)."""
    return F.coalesce(split_part(value, index, sep), F.lit(""))


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def key_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """A 64-bit hash of a key. Which parts are null is part of it, so that
    (null, 'a') and ('a', null) differ; equal keys with equal nulls agree."""
    parts = [F.lit(seed)]
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)
