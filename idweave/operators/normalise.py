"""Per-vendor normalisation onto one shared demographic schema.

Vendor A delivers readable labels plus a state name, a block file and an
id-resolution file; vendor B delivers coded columns (code book names) with
FIPS parts. Both end in the same Y/N flag schema so they can be stacked,
matched and ranked together.

Plan shape (A): the state lookup is broadcast by its size; the block and id
resolution joins are keyed joins (a hot key is split by AQE).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions import demographics as D
from idweave.functions.geo import fips_concat, restate, legacy_tract, legacy_group
from idweave.functions.text import zero_pad
from idweave.operators.columns import rename_columns, sanitise_columns, sanitise_name, upcase_columns
from idweave.operators.lookups import block_lookup, geo_lookup, id_resolution

# --- fixed values: shared schema of the stacked vendors, in output order ----
SHARED_COLUMNS = (
    "RESP_ID", "HHID", "INDID", "MALE", "FEMALE", "MARRIED", "SINGLE", "HISPANIC", "BLACK",
    "FULL_TIME_EMPLOYMENT", "PART_TIME_EMPLOYMENT", "SOME_HIGH_SCHOOL", "SOME_COLLEGE",
    "BACHELORS_DEGREE", "GRADUATE_DEGREE", "BLOCK_GROUP", "AGE", "DATA_SOURCE",
)
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class VendorAColumns:
    """Input column names of a vendor A population (defaults: fixtures)."""

    hhid: str = "A_HHID"
    indid: str = "A_INDID"
    state: str = "STATE_NAME"
    gender: str = "A_GENDER"
    marital: str = "A_MARITAL"
    employment: str = "A_EMPLOYMENT"
    ethnic: str = "A_ETHNIC"
    education: str = "A_EDUCATION"
    children: str = "A_CHILDREN"
    county: str = "A_COUNTY"
    income_k: str = "A_INCOME_K"
    birth_year: str = "A_BIRTH_YEAR"
    birth_month: str = "A_BIRTH_MONTH"
    people: str = "A_PEOPLE"
    adults: str = "A_ADULTS"
    source_tag: str = "A"
    # key columns that the id-resolution file is joined on (same names there)
    resolve_on: tuple[str, ...] = ("A_HHID", "A_INDID")


# --- fixed values: vendor A delivery column names --------------------------
DELIVERED_A = VendorAColumns(
    hhid="AIQ_HHID", indid="AIQ_INDID", state="STATE", gender="AIQ_GENDER",
    marital="AIQ_MARITAL_V2", employment="AIQ_EMPLOYMENT", ethnic="ETHNIC_GROUP",
    education="AIQ_EDUCATION_V2", children="AIQ_CHILDREN_IN_HH_V2", county="COUNTY_CODE",
    income_k="INCOMEIQ_PLUS_V3", birth_year="AIQ_BIRTH_YEAR", birth_month="AIQ_BIRTH_MONTH",
    people="AIQ_PEOPLE_IN_HH_V2", adults="AIQ_ADULTS_IN_HH_V2", source_tag="AIQ",
    resolve_on=("AIQID", "AIQ_HHID"),
)
# Vendor B code book: delivered code -> label, as the vendor names them.
DELIVERED_B_CODES = {
    "MA1693": "Gender",
    "MA4249": "Ethnic_Group",
    "MA1699": "Ethnic_Race_Code",
    "MA2929": "Married_",
    "MA2930": "Single_",
    "MA1698": "Marital Status",
    "MA4348": "Household Income",
    "MA2676": "Fips County Code",
    "MA4507": "Fips State Code",
    "MA1783": "Census Tract",
    "MA1784": "Census Block Group",
    "MA1899": "Has Children",
    "MA1884": "Number of people in household.",
    "MA2783": "College Graduate",
    "MA2784": "Graduate School",
    "MA2781": "High School",
    "MA1694": "Age",
    "MA2782": "Some College_",
}
DELIVERED_B_KEYS = ("TU_Extern_HHID", "TU_Extern_ID")
# --------------------------------------------------------------------------

# Code map of the fixture's coded vendor-B columns (same label style).
FIXTURE_B_CODES = {
    "K01_GENDER": "Gender",
    "K02_MARITAL": "Marital Status",
    "K03_ETHNIC": "Ethnic_Group",
    "K04_COLLEGE": "College Graduate",
    "K05_STATE": "Fips State Code",
    "K06_COUNTY": "Fips County Code",
    "K07_TRACT": "Census Tract",
    "K08_BG": "Census Block Group",
    "K09_HHSIZE": "Number of people in household.",
    "K10_CHILDREN": "Has Children",
    "K11_GRADUATE": "Graduate School",
    "K12_HIGH_SCHOOL": "High School",
    "K13_AGE": "Age",
}


@dataclass(frozen=True)
class VendorBSpec:
    keys: tuple[str, str] = ("B_HHID", "B_INDID")
    codes: Mapping[str, str] = field(default_factory=lambda: dict(FIXTURE_B_CODES))
    source_tag: str = "B"


# ---------------------------------------------------------------- vendor A
def recode_a(df: DataFrame, c: VendorAColumns = VendorAColumns()) -> DataFrame:
    """Value recodes (gender, marital, employment) next to the inputs."""
    return df.select(
        "*",
        F.col(c.gender).alias("GENDER"),
        D.recode(F.col(c.gender), D.A_GENDER_CODES).alias("GENDER_VALUE"),
        F.col(c.marital).alias("MARITAL_STATUS"),
        D.marital_from_label(F.col(c.marital)).alias("MARITAL_STATUS_VALUE"),
        F.col(c.employment).alias("EMPLOYMENT"),
        D.employment_status(F.col(c.employment)).alias("EMPLOYMENT_STATUS_VALUE"),
    )


def flags_a(df: DataFrame, c: VendorAColumns = VendorAColumns()) -> DataFrame:
    """One-hot Y/N flags from the recoded values (input: ``recode_a``)."""
    edu = F.col(c.education)
    return df.select(
        "*",
        F.col(c.education).alias("EDUCATION"),
        D.flag_eq(F.col(c.ethnic), D.A_HISPANIC_CODE).alias("HISPANIC"),
        D.flag_eq(F.col(c.ethnic), D.A_BLACK_CODE).alias("BLACK"),
        D.flag_eq(F.col("GENDER_VALUE"), "M").alias("MALE"),
        D.flag_eq(F.col("GENDER_VALUE"), "F").alias("FEMALE"),
        D.flag_eq(F.col("MARITAL_STATUS_VALUE"), "M").alias("MARRIED"),
        D.flag_eq(F.col("MARITAL_STATUS_VALUE"), "S").alias("SINGLE"),
        D.flag_eq(F.col("EMPLOYMENT_STATUS_VALUE"), "F").alias("FULL_TIME_EMPLOYMENT"),
        D.flag_eq(F.col("EMPLOYMENT_STATUS_VALUE"), "P").alias("PART_TIME_EMPLOYMENT"),
        *[D.flag_in(edu, labels).alias(name) for name, labels in D.A_EDUCATION_FLAGS.items()],
        F.col(c.people).alias("HOUSEHOLD_SIZE"),
        F.col(c.adults).alias("NUMBER_OF_ADULTS_IN_HOUSEHOLD"),
        F.col(c.children).alias("NUMBER_OF_CHILDREN_IN_HOUSEHOLD"),
        F.col(c.birth_month).alias("BIRTH_MONTH"),
        D.flag_positive(F.col(c.children)).alias("PRESENCE_OF_CHILDREN"),
    )


A_OUTPUT = (
    "RESP_ID", "HHID", "INDID", "STATE_NAME", "FIPS_STATE", "BLOCK", "BLOCK_GROUP",
    "BLOCK_ID", "BLOCK_GROUP_ID", "INCOME", "AGE", "BIRTH_YEAR", "BIRTH_MONTH",
    "GENDER", "GENDER_VALUE", "MARITAL_STATUS", "MARITAL_STATUS_VALUE",
    "EMPLOYMENT", "EMPLOYMENT_STATUS_VALUE", "EDUCATION", "HISPANIC", "BLACK",
    "MALE", "FEMALE", "MARRIED", "SINGLE", "FULL_TIME_EMPLOYMENT", "PART_TIME_EMPLOYMENT",
    "SOME_HIGH_SCHOOL", "HIGH_SCHOOL_DIPLOMA", "BACHELORS_DEGREE", "SOME_COLLEGE",
    "GRADUATE_DEGREE", "HOUSEHOLD_SIZE", "NUMBER_OF_ADULTS_IN_HOUSEHOLD",
    "NUMBER_OF_CHILDREN_IN_HOUSEHOLD", "PRESENCE_OF_CHILDREN",
    "FIPS_COUNTY_CODE", "FIPS_CENSUS_TRACT", "FIPS_BLOCK_GROUP", "DATA_SOURCE",
)


def normalise_a(pop: DataFrame, geo: DataFrame, blocks: DataFrame, id_res: DataFrame,
                run_year: int, c: VendorAColumns = VendorAColumns(),
                geo_state: str = "STATE_NAME", geo_fips: str = "FIPS_STATE",
                resp: str = "RESP_ID") -> DataFrame:
    """Vendor A population -> shared schema (``A_OUTPUT`` columns, the person
    key under its vendor names) followed by every other delivered column,
    in upper case. ``geo_state`` / ``geo_fips`` name the lookup's columns and
    ``resp`` the respondent in the resolution file."""
    pop = upcase_columns(pop)
    keys = [c.hhid, c.indid]
    geo = upcase_columns(geo).select(F.col(geo_state).alias("_GEO_STATE"), F.col(geo_fips).alias("FIPS_STATE"))
    df = geo_lookup(pop, geo, c.state, "_GEO_STATE", "FIPS_STATE")
    df = block_lookup(df, upcase_columns(blocks), keys)
    df = df.select(
        "*",
        restate(F.col("FIPS_STATE"), F.col("BLOCK"), 15).alias("BLOCK_ID"),
        restate(F.col("FIPS_STATE"), F.col("BLOCK_GROUP"), 12).alias("BLOCK_GROUP_ID"),
        D.income_from_thousands(F.col(c.income_k)).alias("INCOME"),
        D.age_from_birth_year(F.col(c.birth_year), run_year).alias("AGE"),
        F.col(c.birth_year).alias("BIRTH_YEAR"),
        zero_pad(F.col(c.county), 3).alias("FIPS_COUNTY_CODE"),
    )
    df = df.select("*", legacy_tract(F.col("BLOCK_GROUP_ID")).alias("FIPS_CENSUS_TRACT"),
                   legacy_group(F.col("BLOCK_GROUP_ID")).alias("FIPS_BLOCK_GROUP"),
                   F.lit(c.source_tag).alias("DATA_SOURCE"))
    df = flags_a(recode_a(df, c), c)
    found = upcase_columns(id_res).select(*c.resolve_on, F.col(resp).alias("RESP_ID"))
    df = id_resolution(df, found, list(c.resolve_on))
    named = {"HHID": c.hhid, "INDID": c.indid, "STATE_NAME": c.state}
    out = [F.col(named[x]).alias(x if x == "STATE_NAME" else named[x]) if x in named else F.col(x)
           for x in A_OUTPUT]
    taken = {x.upper() for x in A_OUTPUT} - {"HHID", "INDID"} | {c.hhid.upper(), c.indid.upper()}
    return df.select(*out, *[F.col(x) for x in pop.columns if x not in taken])


# ---------------------------------------------------------------- vendor B
def label_b(pop: DataFrame, spec: VendorBSpec = VendorBSpec()) -> DataFrame:
    """Keys + coded columns renamed to sanitised labels, plus ``FIPS``. Names
    are matched in any case; a code column that was not delivered is an
    error, not a shorter result."""
    pop = upcase_columns(pop)
    codes = {k.upper(): v for k, v in spec.codes.items()}
    keys = [k.upper() for k in spec.keys]
    absent = sorted({*keys, *codes} - {*pop.columns})
    if absent:
        raise ValueError(f"columns not delivered: {absent}")
    df = rename_columns(pop.select(*keys, *codes), codes)
    label = {sanitise_name(v): v for v in codes.values()}
    df = df.select("*", fips_concat(*[F.col(f"`{label[x]}`") for x in FIPS_PARTS]).alias("FIPS"))
    return sanitise_columns(df)


#: Parts of a block group's code, in order.
FIPS_PARTS = ("FIPS_STATE_CODE", "FIPS_COUNTY_CODE", "CENSUS_TRACT", "CENSUS_BLOCK_GROUP")


def recode_b(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        D.recode(F.col("GENDER"), D.B_GENDER_CODES).alias("GENDER_VALUE"),
        D.recode(F.col("MARITAL_STATUS"), D.B_MARITAL_CODES).alias("MARITAL_STATUS_VALUE"),
        F.lit(None).cast("string").alias("EMPLOYMENT"),
        F.lit(D.UNKNOWN).alias("EMPLOYMENT_STATUS_VALUE"),
    )


def flags_b(df: DataFrame) -> DataFrame:
    one = D.B_INDICATOR_TRUE
    return df.select(
        "*",
        D.flag_eq(F.col("GENDER_VALUE"), "M").alias("MALE"),
        D.flag_eq(F.col("GENDER_VALUE"), "F").alias("FEMALE"),
        D.flag_eq(F.col("MARITAL_STATUS_VALUE"), "M").alias("MARRIED"),
        D.flag_eq(F.col("MARITAL_STATUS_VALUE"), "S").alias("SINGLE"),
        D.flag_eq(F.col("ETHNIC_GROUP"), D.B_HISPANIC_CODE).alias("HISPANIC"),
        D.flag_eq(F.col("ETHNIC_GROUP"), D.B_BLACK_CODE).alias("BLACK"),
        D.flag_eq(F.col("EMPLOYMENT_STATUS_VALUE"), "F").alias("FULL_TIME_EMPLOYMENT"),
        D.flag_eq(F.col("EMPLOYMENT_STATUS_VALUE"), "P").alias("PART_TIME_EMPLOYMENT"),
        D.flag_eq(F.col("HIGH_SCHOOL"), one).alias("SOME_HIGH_SCHOOL"),
        D.flag_eq(F.col("HIGH_SCHOOL"), one).alias("HIGH_SCHOOL_DIPLOMA"),
        D.flag_eq(F.col("COLLEGE_GRADUATE"), one).alias("SOME_COLLEGE"),
        D.flag_eq(F.col("COLLEGE_GRADUATE"), one).alias("BACHELORS_DEGREE"),
        D.flag_eq(F.col("GRADUATE_SCHOOL"), one).alias("GRADUATE_DEGREE"),
        D.flag_eq(F.col("HAS_CHILDREN"), one).alias("PRESENCE_OF_CHILDREN"),
    )


B_OUTPUT = (
    "RESP_ID", "HHID", "INDID", "FIPS", "GENDER", "GENDER_VALUE", "MARITAL_STATUS",
    "MARITAL_STATUS_VALUE", "ETHNIC_GROUP", "HISPANIC", "BLACK", "EMPLOYMENT",
    "EMPLOYMENT_STATUS_VALUE", "FULL_TIME_EMPLOYMENT", "PART_TIME_EMPLOYMENT", "MALE", "FEMALE",
    "MARRIED", "SINGLE", "HOUSEHOLD_SIZE", "NUMBER_OF_ADULTS_IN_HOUSEHOLD",
    "NUMBER_OF_CHILDREN_IN_HOUSEHOLD", "SOME_HIGH_SCHOOL", "HIGH_SCHOOL_DIPLOMA", "SOME_COLLEGE",
    "BACHELORS_DEGREE", "GRADUATE_DEGREE", "PRESENCE_OF_CHILDREN", "EDUCATION", "AGE",
    "BLOCK", "BLOCK_GROUP", "DATA_SOURCE",
)


def normalise_b(pop: DataFrame, id_res: DataFrame, spec: VendorBSpec = VendorBSpec(),
                resp: str = "RESP_ID") -> DataFrame:
    """Vendor B coded population -> shared schema (``B_OUTPUT`` columns)
    followed by every other labelled column."""
    keys = [k.upper() for k in spec.keys]
    labelled = label_b(pop, spec)
    df = flags_b(recode_b(labelled))
    df = df.select(
        "*",
        F.col("NUMBER_OF_PEOPLE_IN_HOUSEHOLD").try_cast("int").alias("HOUSEHOLD_SIZE"),
        F.lit(0).alias("NUMBER_OF_ADULTS_IN_HOUSEHOLD"),
        F.lit(0).alias("NUMBER_OF_CHILDREN_IN_HOUSEHOLD"),
        F.lit(None).cast("string").alias("EDUCATION"),
        F.lit(None).cast("string").alias("BLOCK"),
        F.col("FIPS").alias("BLOCK_GROUP"),
        F.lit(spec.source_tag).alias("DATA_SOURCE"),
    ).withColumn("AGE", F.col("AGE").try_cast("int"))
    df = id_resolution(df, upcase_columns(id_res).select(*keys, F.col(resp).alias("RESP_ID")), keys)
    named = dict(zip(("HHID", "INDID"), keys))
    out = [F.col(named.get(x, x)) for x in B_OUTPUT]
    taken = {*B_OUTPUT, *keys}
    return df.select(*out, *[F.col(x) for x in labelled.columns if x not in taken])


# ---------------------------------------------------------------- stacked
def to_shared(df: DataFrame, hhid: str, indid: str) -> DataFrame:
    """Project a normalised vendor onto ``SHARED_COLUMNS`` with fixed types."""
    cols = []
    for x in SHARED_COLUMNS:
        if x == "HHID":
            cols.append(F.col(hhid).cast("string").alias("HHID"))
        elif x == "INDID":
            cols.append(F.col(indid).cast("string").alias("INDID"))
        elif x == "AGE":
            cols.append(F.col("AGE").cast("int").alias("AGE"))
        else:
            cols.append(F.col(x).cast("string").alias(x))
    return df.select(*cols)


def everyone(norm_a: DataFrame, norm_b: DataFrame, a_keys=("A_HHID", "A_INDID"),
             b_keys=("B_HHID", "B_INDID")) -> DataFrame:
    """Both vendors stacked on the shared schema (B first, then A)."""
    return to_shared(norm_b, *b_keys).unionByName(to_shared(norm_a, *a_keys))
