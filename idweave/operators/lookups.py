"""Lookup joins: state -> FIPS, person -> census block, person -> respondent.

No join here carries a broadcast hint: Spark broadcasts a lookup whose size
is below ``autoBroadcastJoinThreshold`` (AQE decides by its size at run
time), and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from idweave.operators.joins import keyed_join


def lookup_join(df: DataFrame, dim: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                take: Sequence[str], how: str = "left", distinct: bool = True) -> DataFrame:
    """``df`` joined to ``dim`` on ``left_on = right_on``, adding ``take``.

    ``distinct`` removes duplicate lookup rows first (duplicates would fan
    out the left side)."""
    d = dim.select(*dict.fromkeys([*right_on, *take]))
    if distinct:
        d = d.distinct()
    keep = [c for c in df.columns if c not in take]
    return keyed_join(df.select(*keep), d, left_on, right_on, how).select(
        *keep, *[c for c in take if c not in right_on])


def geo_lookup(df: DataFrame, geo: DataFrame, state_col: str = "STATE_NAME",
               geo_state: str = "STATE_NAME", geo_fips: str = "FIPS_STATE") -> DataFrame:
    """Add the FIPS state code (distinct lookup)."""
    return lookup_join(df, geo, [state_col], [geo_state], [geo_fips])


def block_lookup(df: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("A_HHID", "A_INDID"),
                 take: Sequence[str] = ("BLOCK", "BLOCK_GROUP")) -> DataFrame:
    """Add census block and block group by person key (shuffle join)."""
    return lookup_join(df, blocks, list(keys), list(keys), list(take), distinct=False)


def id_resolution(df: DataFrame, id_res: DataFrame, keys: Sequence[str] = ("A_HHID", "A_INDID"),
                  resp: str = "RESP_ID", id_res_keys: Sequence[str] | None = None) -> DataFrame:
    """``RESP_ID`` first, then every column of ``df``. A key resolved to
    several respondents yields several rows (see ``duplicate_keys``)."""
    out = lookup_join(df, id_res, list(keys), list(id_res_keys or keys), [resp], distinct=False)
    return out.select(resp, *[c for c in out.columns if c != resp])
