"""Column expressions. All are built-in Spark expressions (no Python UDFs)."""

from idweave.functions.ids import (
    person_id, pair_key, split_part, split_part_or_blank,
)
from idweave.functions.text import zero_pad, non_blank, clean_label
from idweave.functions.geo import fips_concat, restate, geo_parts, legacy_tract, legacy_group
from idweave.functions.meta import meta_json, meta_literal
from idweave.functions.demographics import (
    recode, marital_from_label, employment_status, flag_eq, flag_in,
    flag_positive, income_from_thousands, age_from_birth_year, attribute_count,
)

__all__ = [
    "person_id", "pair_key", "split_part", "split_part_or_blank",
    "zero_pad", "non_blank", "clean_label",
    "fips_concat", "restate", "geo_parts", "legacy_tract", "legacy_group",
    "meta_json", "meta_literal",
    "recode", "marital_from_label", "employment_status", "flag_eq", "flag_in",
    "flag_positive", "income_from_thousands", "age_from_birth_year", "attribute_count",
]
