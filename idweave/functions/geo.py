"""Census geography codes (FIPS state / county / tract / block group / block)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from idweave.functions.util import as_col, ColumnLike

# --- fixed values: code widths of a census block-group id ------------------
# state 2, county 3, tract 6, block group 1 (12 digits); a block id adds 3.
GEO_WIDTHS = (("STATE", 2), ("COUNTY", 3), ("TRACT", 6), ("GROUP", 1))
# Slices the reference applies to the 12-digit block group id, kept as
# written for parity (they start inside the county code).
LEGACY_TRACT_SLICE = (5, 11)
LEGACY_GROUP_SLICE = (11, 11)
# --------------------------------------------------------------------------


def fips_concat(*parts: ColumnLike) -> Column:
    """Concatenate code parts; null when any part is null."""
    return F.concat(*[as_col(p).cast("string") for p in parts])


def restate(state_code: ColumnLike, code: ColumnLike, length: int) -> Column:
    """Replace the 2-digit state prefix of a block / block-group id by
    ``state_code``: ``state || substring(code, 3, length)``; null when
    ``code`` is null."""
    c = as_col(code).cast("string")
    return F.when(c.isNotNull(),
                  F.concat(as_col(state_code).cast("string"), F.substring(c, 3, length)))


def legacy_tract(block_group: ColumnLike) -> Column:
    pos, ln = LEGACY_TRACT_SLICE
    return F.substring(as_col(block_group), pos, ln)


def legacy_group(block_group: ColumnLike) -> Column:
    pos, ln = LEGACY_GROUP_SLICE
    return F.substring(as_col(block_group), pos, ln)


def geo_parts(block_group: ColumnLike, prefix: str = "GEO_") -> list[Column]:
    """Split a 12-digit block-group id into state/county/tract/group."""
    c = as_col(block_group)
    out, pos = [], 1
    for name, width in GEO_WIDTHS:
        out.append(F.substring(c, pos, width).alias(prefix + name))
        pos += width
    return out
