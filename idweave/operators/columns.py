"""Column-name alignment: upper-casing, code -> label renames, sanitising,
repair of repeated-token names. All are metadata-only projections (no data
movement); each checks that the renamed schema has no duplicate names,
which Spark would otherwise accept silently and fail on later."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame


class ColumnCollision(ValueError):
    pass


def _check_unique(names: list[str], what: str) -> None:
    dup = sorted(n for n, c in Counter(x.upper() for x in names).items() if c > 1)
    if dup:
        raise ColumnCollision(f"{what} would give duplicate column names: {dup}")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary (missing source names are ignored, as Spark does)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    new = [present.get(c, c) for c in df.columns]
    _check_unique(new, "rename")
    return df.withColumnsRenamed(present) if present else df


def upcase_columns(df: DataFrame) -> DataFrame:
    """Every column name in upper case."""
    return rename_columns(df, {c: c.upper() for c in df.columns if c != c.upper()})


def sanitise_name(name: str) -> str:
    """Spaces -> '_', trailing dots dropped, upper case."""
    return name.replace(" ", "_").rstrip(".").upper()


def sanitise_columns(df: DataFrame) -> DataFrame:
    return rename_columns(df, {c: sanitise_name(c) for c in df.columns if sanitise_name(c) != c})


def repaired_name(name: str, sep: str = "_") -> str:
    """The first token of a name in which some token (an empty one too)
    occurs again; any other name as it is."""
    tokens = name.split(sep)
    return tokens[0] if len(set(tokens)) < len(tokens) else name


def repair_columns(df: DataFrame, overrides: Mapping[str, str] | None = None,
                   sep: str = "_") -> DataFrame:
    """Names with a repeated token keep only their first token
    ('MA1693_MA1693' -> 'MA1693'); ``overrides`` then win."""
    mapping = {c: repaired_name(c, sep) for c in df.columns if repaired_name(c, sep) != c}
    mapping.update({k: v for k, v in (overrides or {}).items() if k in df.columns})
    return rename_columns(df, mapping)
