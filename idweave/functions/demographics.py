"""Demographic recodes and one-hot flags, driven by mapping tables.

Both vendors are mapped onto one shared schema of Y/N flags. The mappings
are data (dicts below), the expressions are built from them, so a new
vendor is a new table, not a new copy of the code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from idweave.functions.util import as_col, yes_no, ColumnLike

UNKNOWN = "U"

# --- fixed values: codes and labels each vendor delivers -------------------
# Vendor A delivers readable labels.
A_GENDER_CODES = {"Male": "M", "Female": "F"}
A_MARRIED_LABEL = "Married"
A_HISPANIC_CODE = "Y"
A_BLACK_CODE = "F"
A_FULL_TIME_MIN = 5  # employment code >= 5 is full time
A_PART_TIME_MAX = 3  # employment code <= 3 is part time
A_EDUCATION_FLAGS = {
    "SOME_HIGH_SCHOOL": ("HS Degree", "Less Than HS"),
    "HIGH_SCHOOL_DIPLOMA": ("HS Degree",),
    "BACHELORS_DEGREE": ("Bachelor Degree",),
    "SOME_COLLEGE": ("Bachelor Degree",),
    "GRADUATE_DEGREE": ("Graduate Degree",),
}
# Vendor B delivers one-letter codes and '1'/'0' indicators.
B_GENDER_CODES = {"M": "M", "F": "F"}
B_MARITAL_CODES = {"S": "S", "M": "M"}
B_HISPANIC_CODE = "O"
B_BLACK_CODE = "B"
B_INDICATOR_TRUE = "1"
# --------------------------------------------------------------------------

# Flag pairs that describe one attribute; used by attribute_count.
COMPLETENESS_PAIRS = (
    ("MALE", "FEMALE"),
    ("MARRIED", "SINGLE"),
    ("HISPANIC", "BLACK"),
    ("FULL_TIME_EMPLOYMENT", "PART_TIME_EMPLOYMENT"),
)


def recode(value: ColumnLike, mapping: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """CASE value WHEN k THEN v ... ELSE default (null input -> default)."""
    v = as_col(value)
    expr = None
    for k, out in mapping.items():
        expr = (F.when(v == k, F.lit(out)) if expr is None
                else expr.when(v == k, F.lit(out)))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def marital_from_label(value: ColumnLike, married: str = A_MARRIED_LABEL) -> Column:
    """'M' for the married label, 'S' for any other label, 'U' for null."""
    v = as_col(value)
    return (F.when(v == married, F.lit("M"))
            .when(v != married, F.lit("S"))
            .otherwise(F.lit(UNKNOWN)))


def employment_status(value: ColumnLike, full_min: int = A_FULL_TIME_MIN,
                      part_max: int = A_PART_TIME_MAX) -> Column:
    """'F' for code >= full_min, 'P' for <= part_max, else 'U'.

    ``try_cast``: free text gives 'U' instead of failing the job under ANSI."""
    code = as_col(value).try_cast("int")
    return (F.when(code >= full_min, F.lit("F"))
            .when(code <= part_max, F.lit("P"))
            .otherwise(F.lit(UNKNOWN)))


def flag_eq(value: ColumnLike, code: str) -> Column:
    return yes_no(as_col(value) == code)


def flag_in(value: ColumnLike, codes: Iterable[str]) -> Column:
    return yes_no(as_col(value).isin(list(codes)))


def flag_positive(value: ColumnLike) -> Column:
    """'Y' when the (text) count is a number > 0."""
    return yes_no(as_col(value).try_cast("int") > 0)


def income_from_thousands(value: ColumnLike) -> Column:
    """Income in thousands -> whole units: '45' -> 45000, '45.5' -> 45500;
    null -> 0, other text -> null.

    Typed bigint explicitly (the untyped form changes type with ANSI mode)."""
    v = as_col(value)
    return (F.when(v.isNotNull(), (v.cast("string").try_cast("decimal(20,3)") * 1000).try_cast("bigint"))
            .otherwise(F.lit(0).cast("bigint")))


def age_from_birth_year(value: ColumnLike, run_year: int) -> Column:
    """run_year - birth year; 0 when the year is missing."""
    v = as_col(value)
    return (F.when(v.isNotNull(), F.lit(run_year) - v.try_cast("int"))
            .otherwise(F.lit(0))).cast("int")


def attribute_count(pairs=COMPLETENESS_PAIRS) -> Column:
    """Completeness 0..4: start at 4, minus one per attribute whose two
    flags are both 'N'. Null flags never subtract."""
    total = F.lit(len(pairs))
    for a, b in pairs:
        both_no = F.coalesce((F.col(a) == "N") & (F.col(b) == "N"), F.lit(False))
        total = total - F.when(both_no, F.lit(1)).otherwise(F.lit(0))
    return total.cast("int")
