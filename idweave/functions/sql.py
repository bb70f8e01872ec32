"""The id helpers as SQL functions, for users who work in SQL cells.

They are native SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``),
inlined by the analyzer into ordinary expressions: whole-stage codegen,
no Python worker, unlike a registered Python UDF.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    # piece i (0-based) of an 'HHID_INDID' pair key; null when missing
    "pair_part": ("s STRING, i INT", "STRING",
                  "get(split(nullif(s, ''), '_'), i)"),
    # same, '' when missing (the SQL-registered variant of the reference)
    "pair_part_or_blank": ("s STRING, i INT", "STRING",
                           "coalesce(get(split(nullif(s, ''), '_'), i), '')"),
    # deterministic person id of a two-part key
    "person_key_id": ("h STRING, i STRING", "STRING",
                      "md5(concat(h, '|', i))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(SQL_FUNCTIONS)
