"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from idweave.functions.util import as_col, ColumnLike


def zero_pad(value: ColumnLike, width: int = 3, numeric: bool = False) -> Column:
    """Left-pad with zeros to ``width`` without truncating longer values.

    Null for null and ``''``; with ``numeric=True`` the input is a number
    and 0 is treated as missing too (the reference's truthiness test).
    A bare ``lpad`` would cut '1234' to '123'.
    """
    v = as_col(value)
    if numeric:
        missing = v.isNull() | (v == 0)
        v = v.cast("string")
    else:
        missing = v.isNull() | (v == "")
    return (
        F.when(missing, F.lit(None).cast("string"))
        .when(F.length(v) >= width, v)
        .otherwise(F.lpad(v, width, "0"))
    )


def non_blank(value: ColumnLike) -> Column:
    """``trim(x) != ''``: false for blanks, null (so filtered) for null."""
    return F.trim(as_col(value)) != F.lit("")


def clean_label(value: ColumnLike) -> Column:
    """Code-book label clean-up: trim, drop spaces, '$' and ',', then '-' -> '_'."""
    v = F.trim(as_col(value))
    return F.replace(F.translate(v, " $,", ""), F.lit("-"), F.lit("_"))
