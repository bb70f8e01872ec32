from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Union[str, Column]


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no(cond: Column) -> Column:
    """'Y' when ``cond`` is true, 'N' when false or null."""
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))
