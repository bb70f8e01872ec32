"""The vendor normalisers on frames of the delivered shape."""

import pytest

from idweave.operators import normalise as N

A_DELIVERY = {
    "C_CustomerUniqueID": "u1", "AIQ_HHID": "10", "AIQ_INDID": "1", "AIQID": "q1", "city": "X", "state": "TX",
    "COUNTY": "c", "Zip5": "1", "Zip4": "2", "AIQ_GENDER": "Female", "AIQ_AGE": "40", "COUNTY_CODE": "7",
    "ethnic_code": "e", "ethnic_group": "F", "Presence_of_Children_v2": "Y", "AIQ_Adults_in_HH_v2": "2",
    "AIQ_Children_in_HH_v2": "1", "AIQ_People_in_HH_v2": "3", "AIQ_MARITAL_V2": "Married",
    "AIQ_EDUCATION_V2": "HS Degree", "AIQ_Employment": "6", "WEALTH_PROFILES": "w", "INCOMEIQ_PLUS_v3": "45.5",
    "AIQ_BIRTH_YEAR": "1984", "AIQ_BIRTH_MONTH": "5",
}


def frame(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in rows[0]))


def test_vendor_a_as_delivered(spark):
    pop = frame(spark, A_DELIVERY, A_DELIVERY | {"AIQ_HHID": "11", "AIQID": "q9", "AIQ_GENDER": None})
    geo = frame(spark, {"ST_ABBR": "TX", "FIPS_STATE_CODE": "48"}, {"ST_ABBR": "TX", "FIPS_STATE_CODE": "48"})
    blocks = frame(spark, {"AIQ_HHID": "10", "AIQ_INDID": "1", "BLOCK": "990070000110001", "BLOCK_GROUP": "990070000111"})
    found = frame(spark, {"MRI_ID": "R1", "AIQID": "q1", "AIQ_HHID": "10"}, {"MRI_ID": "R2", "AIQID": "q1", "AIQ_HHID": "99"})
    out = N.normalise_a(pop, geo, blocks, found, 2024, N.DELIVERED_A, geo_state="ST_ABBR",
                        geo_fips="FIPS_STATE_CODE", resp="MRI_ID")
    assert {c.upper() for c in A_DELIVERY} - {"STATE"} <= set(out.columns)
    assert len(out.columns) == len({c.upper() for c in out.columns})
    one, other = sorted(out.collect(), key=lambda r: r.AIQ_HHID)
    assert (one.RESP_ID, other.RESP_ID) == ("R1", None)
    assert (one.FIPS_STATE, one.BLOCK_ID, one.BLOCK_GROUP_ID) == ("48", "480070000110001", "480070000111")
    assert (one.HOUSEHOLD_SIZE, one.NUMBER_OF_ADULTS_IN_HOUSEHOLD, one.NUMBER_OF_CHILDREN_IN_HOUSEHOLD,
            one.BIRTH_MONTH, one.AGE, one.INCOME, one.FIPS_COUNTY_CODE) == ("3", "2", "1", "5", 40, 45500, "007")
    assert (one.FEMALE, one.MARRIED, one.BLACK, one.FULL_TIME_EMPLOYMENT, one.HIGH_SCHOOL_DIPLOMA,
            one.PRESENCE_OF_CHILDREN, one.DATA_SOURCE) == ("Y", "Y", "Y", "Y", "Y", "Y", "AIQ")
    assert other.BLOCK is None and other.GENDER_VALUE == "U"


B_DELIVERY = {"TU_Extern_HHID": "T1", "TU_Extern_ID": "2"} | {c: "1" for c in N.DELIVERED_B_CODES} | {
    "MA1693": "M", "MA1698": "S", "MA4249": "O", "MA4507": "48", "MA2676": "007", "MA1783": "000011", "MA1784": "1",
    "MA1884": "4", "MA1694": "55"}
B_SPEC = N.VendorBSpec(keys=N.DELIVERED_B_KEYS, codes=N.DELIVERED_B_CODES, source_tag="TU")


@pytest.mark.parametrize("case", [str, str.lower, str.upper])
def test_vendor_b_as_delivered(spark, case):
    pop = frame(spark, {case(k): v for k, v in B_DELIVERY.items()})
    found = frame(spark, {"MRI_ID": "R7", "TU_EXTERN_HHID": "T1", "TU_EXTERN_ID": "2"})
    out = N.normalise_b(pop, found, B_SPEC, resp="MRI_ID")
    assert {N.sanitise_name(v) for v in N.DELIVERED_B_CODES.values()} <= set(out.columns)
    r, = out.collect()
    assert (r.RESP_ID, r.FIPS, r.BLOCK_GROUP, r.AGE, r.HOUSEHOLD_SIZE) == ("R7", "480070000111", "480070000111", 55, 4)
    assert (r.MALE, r.SINGLE, r.HISPANIC, r.BLACK, r.GRADUATE_DEGREE, r.DATA_SOURCE) == ("Y", "Y", "Y", "N", "Y", "TU")


def test_a_code_column_that_is_absent_is_an_error(spark):
    pop = frame(spark, {k: v for k, v in B_DELIVERY.items() if k != "MA1783"})
    with pytest.raises(ValueError, match="MA1783"):
        N.label_b(pop, B_SPEC)


def test_both_vendors_stack(spark):
    a = N.normalise_a(frame(spark, A_DELIVERY), frame(spark, {"ST_ABBR": "TX", "F": "48"}),
                      frame(spark, {"AIQ_HHID": "0", "AIQ_INDID": "1", "BLOCK": "1", "BLOCK_GROUP": "2"}),
                      frame(spark, {"MRI_ID": "R1", "AIQID": "q1", "AIQ_HHID": "10"}), 2024, N.DELIVERED_A,
                      geo_state="ST_ABBR", geo_fips="F", resp="MRI_ID")
    b = N.normalise_b(frame(spark, B_DELIVERY), frame(spark, {"RESP_ID": "x", "TU_EXTERN_HHID": "y", "TU_EXTERN_ID": "z"}),
                      B_SPEC)
    both = N.everyone(a, b, ("AIQ_HHID", "AIQ_INDID"), ("TU_EXTERN_HHID", "TU_EXTERN_ID"))
    assert both.columns == list(N.SHARED_COLUMNS) and both.count() == 2
