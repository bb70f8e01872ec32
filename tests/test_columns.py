import pytest

from idweave.operators.columns import (
    ColumnCollision, rename_columns, repair_columns, repaired_name,
    sanitise_columns, upcase_columns,
)


def test_upcase_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert upcase_columns(df).columns == ["A", "B"]
    clash = spark.createDataFrame([(1, 2)], "ab int, xy int")
    with pytest.raises(ColumnCollision):
        rename_columns(clash, {"xy": "AB"})


def test_sanitise_dotted_and_spaced_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Number of people in household.` int, `Fips State Code` int")
    assert sanitise_columns(df).columns == ["NUMBER_OF_PEOPLE_IN_HOUSEHOLD", "FIPS_STATE_CODE"]


def test_repeated_token_repair(spark):
    assert repaired_name("MA1693_MA1693") == "MA1693"
    assert repaired_name("X___Y") == "X"         # empty tokens repeat too
    assert repaired_name("X__Y") == "X__Y"
    assert repaired_name("B_Extern_ID") == "B_Extern_ID"
    assert repaired_name("MA1693_x_MA1693") == "MA1693"
    assert repaired_name("plain") == "plain"
    df = spark.createDataFrame([(1, 2, 3)], "MA1_MA1 int, IN1_RESP_ID int, `K__` int")
    out = repair_columns(df, {"IN1_RESP_ID": "RESP_ID"})
    assert out.columns == ["MA1", "RESP_ID", "K"]
    dup = spark.createDataFrame([(1, 2)], "MA1_MA1 int, MA1 int")
    with pytest.raises(ColumnCollision):
        repair_columns(dup)
