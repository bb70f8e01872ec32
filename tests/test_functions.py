"""Column expressions on tiny in-line rows: nulls, blanks, bad text."""

from idweave.functions import demographics as D
from idweave.functions.ids import pair_key, person_id, split_part, split_part_or_blank
from idweave.functions.text import clean_label, non_blank, zero_pad
from idweave.functions.geo import fips_concat, geo_parts, legacy_group, legacy_tract, restate
from idweave.functions.meta import meta_json


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_person_id_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([("T1", "1"), ("T1", None), ("T1", "1")], "h string, i string")
    out = rows(df, person_id("h", "i"))
    assert out[0] == out[2] and out[0][0] is not None
    assert out[1] == (None,)
    # neither the place of the cut nor a separator inside a part confuses keys
    d2 = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a|b", "c"), ("a", "b|c"), ("a\\|b", "c"), ("a\\", "b|c")],
                               "h string, i string")
    assert len(set(rows(d2, person_id("h", "i")))) == 6
    ns = rows(df.limit(1), person_id("h", "i", namespace="A"))[0]
    assert ns != out[0]


def test_pair_key_and_split(spark):
    df = spark.createDataFrame([("10_2",), ("",), (None,), ("7",), ("a_b_c",), ("x_",)], "p string")
    assert rows(df, split_part("p", 0)) == [("10",), (None,), (None,), ("7",), ("a",), ("x",)]
    assert rows(df, split_part("p", 1)) == [("2",), (None,), (None,), (None,), ("b",), ("",)]
    assert rows(df, split_part_or_blank("p", 1)) == [("2",), ("",), ("",), ("",), ("b",), ("",)]
    d2 = spark.createDataFrame([("10", "2"), ("10", None)], "h string, i string")
    assert rows(d2, pair_key("h", "i")) == [("10_2",), (None,)]


def test_zero_pad_keeps_long_values(spark):
    df = spark.createDataFrame([("7",), ("12",), ("123",), ("1234",), ("",), (None,), ("0",)], "c string")
    assert rows(df, zero_pad("c", 3)) == [("007",), ("012",), ("123",), ("1234",), (None,), (None,), ("000",)]
    n = spark.createDataFrame([(7,), (0,), (None,), (1234,)], "c int")
    assert rows(n, zero_pad("c", 3, numeric=True)) == [("007",), (None,), (None,), ("1234",)]


def test_non_blank_and_labels(spark):
    df = spark.createDataFrame([(" ",), ("a",), (None,), ("\t",)], "c string")
    assert df.where(non_blank("c")).count() == 2  # tab is not trimmed, as in the reference
    lab = spark.createDataFrame([(" Estimated Household Income $100,000 - $124,999 ",)], "l string")
    assert rows(lab, clean_label("l")) == [("EstimatedHouseholdIncome100000_124999",)]


def test_recodes_and_flags(spark):
    df = spark.createDataFrame([("Male", "Married", "6"), ("Female", "Never Married", "2"),
                                (None, None, "x"), ("other", "Divorced", "4")],
                               "g string, m string, e string")
    out = rows(df, D.recode("g", D.A_GENDER_CODES), D.marital_from_label("m"), D.employment_status("e"))
    assert out == [("M", "M", "F"), ("F", "S", "P"), ("U", "U", "U"), ("U", "S", "U")]
    assert rows(df, D.flag_in("g", ["Male", "x"])) == [("Y",), ("N",), ("N",), ("N",)]


def test_income_and_age_types(spark):
    df = spark.createDataFrame([("45", "1980"), (None, None), ("abc", "19x0")], "i string, y string")
    out = df.select(D.income_from_thousands("i").alias("inc"), D.age_from_birth_year("y", 2024).alias("age"))
    assert dict(out.dtypes) == {"inc": "bigint", "age": "int"}
    assert rows(out, "inc", "age") == [(45000, 44), (0, 0), (None, None)]


def test_attribute_count_nulls_do_not_subtract(spark):
    cols = "MALE string, FEMALE string, MARRIED string, SINGLE string, HISPANIC string, " \
           "BLACK string, FULL_TIME_EMPLOYMENT string, PART_TIME_EMPLOYMENT string"
    df = spark.createDataFrame([("N", "N", "N", "N", "N", "N", "N", "N"),
                                ("Y", "N", "N", "Y", "N", "N", "N", "N"),
                                (None, "N", None, None, "N", "Y", "N", None)], cols)
    assert rows(df, D.attribute_count()) == [(0,), (2,), (4,)]


def test_geo_codes(spark):
    df = spark.createDataFrame([("06", "010010201001"), ("06", None)], "st string, bg string")
    assert rows(df, restate("st", "bg", 12)) == [("060010201001",), (None,)]
    assert rows(df.limit(1), *geo_parts("bg")) == [("01", "001", "020100", "1")]
    assert rows(df.limit(1), legacy_tract("bg"), legacy_group("bg")) == [("10201001", "01")]
    d2 = spark.createDataFrame([("1", "2", None)], "a string, b string, c string")
    assert rows(d2, fips_concat("a", "b"), fips_concat("a", "b", "c")) == [("12", None)]


def test_meta_json_is_stable():
    assert meta_json({"b": 1, "a": "x"}) == '{"a":"x","b":1}'
    assert meta_json(None) == "{}"
