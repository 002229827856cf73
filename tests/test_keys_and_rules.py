"""Member key and cleaning rules on hand-made frames (FIXTURES.md §4)."""

import hashlib

import pytest

from lendwise.functions import rules
from lendwise.functions.keys import MEMBER_KEY_COLUMNS, member_key
from lendwise.operators import clean
from lendwise.params import Variant

KEY_SCHEMA = ("emp_title string, emp_length string, home_ownership string, annual_inc double, "
              "zip_code string, addr_state string, grade string, sub_grade string, "
              "verification_status string")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_member_key_nulls_collide_and_all_null_hashes_empty(spark):
    rows = [(None, "a", None, None, None, None, None, None, None),
            ("a", None, None, None, None, None, None, None, None),
            (None,) * 9,
            ("t", "1", "OWN", 1.0e7, "001xx", "CA", "A", "A1", "Verified")]
    keys = [r[0] for r in spark.createDataFrame(rows, KEY_SCHEMA).select(member_key()).collect()]
    assert keys[0] == keys[1] == _sha("a")
    assert keys[2] == _sha("")
    assert keys[3] == _sha("t||1||OWN||1.0E7||001xx||CA||A||A1||Verified")
    assert len(MEMBER_KEY_COLUMNS) == 9


def test_emp_length_digits(spark):
    rows = [("10+ years",), ("< 1 year",), ("3 years",), ("n/a",), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "e string")
           .select(rules.digits_to_int("e")).collect()]
    assert got == [10, 1, 3, None, None, None]


def test_term_years_both_parsers(spark):
    df = spark.createDataFrame([(" 36 months",), ("60 months",), ("x",)], "t string")
    assert [r[0] for r in df.select(rules.term_years("t")).collect()] == [3, 5, None]
    assert [r[0] for r in df.select(rules.term_years("t", "suffix")).collect()] == [3, 5, None]


def test_state_purpose_sentinel(spark):
    df = spark.createDataFrame([("CA", "car", "0.0"), ("NATION_1", "yoga", "Jan-2019"),
                                (None, None, None)], "s string, p string, d string")
    got = df.select(rules.state_or_na("s"), rules.purpose_or_other("p"),
                    rules.null_if_sentinel("d")).collect()
    assert [tuple(r) for r in got] == [("CA", "car", None), ("NA", "other", "Jan-2019"),
                                       (None, "other", None)]


def test_repair_and_recompute_total(spark):
    df = spark.createDataFrame([(10.0, 2.0, 1.0, 0.0), (0.0, 2.0, 1.0, 0.0), (10.0, 2.0, 1.0, 5.0)],
                               "p float, i float, f float, t float")
    repaired = [r[0] for r in df.select(rules.repaired_total("p", "i", "f", "t")).collect()]
    assert repaired == [13.0, 0.0, 5.0]
    assert [r[0] for r in df.select(rules.recomputed_total("p", "i", "f")).collect()] == [13.0, 3.0, 13.0]


def test_mean_imputation_and_empty_input(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "e int")
    assert sorted(r[0] for r in clean.impute_mean_floor(df, "e").collect()) == [1, 1, 2]
    empty = spark.createDataFrame([], "e int")
    assert clean.impute_mean_floor(empty, "e").collect() == []
    nulls = spark.createDataFrame([(None,)], "e int")
    assert [r[0] for r in clean.impute_mean_floor(nulls, "e").collect()] == [None]


def test_rename_strict_rejects_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        clean.rename_strict(df, {"tot_hi_credit_lim": "total_high_credit_limit"})


DEF_SCHEMA = ("member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, "
              "pub_rec_bankruptcies float, inq_last_6mths float, total_rec_late_fee float, "
              "mths_since_last_delinq float, mths_since_last_record float")


def test_delinquency_variants(spark):
    rows = [("m1", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5, None),
            ("m2", None, 1.0, 1.0, None, 0.0, 0.0, None, None),
            ("m3", 2.7, 1.0, None, 0.0, 0.0, 0.0, 3.9, None)]
    base = clean.defaulters_base(spark.createDataFrame(rows, DEF_SCHEMA))
    lib = {r.member_id: tuple(r) for r in clean.delinq_members(base).collect()}
    nb = {r.member_id for r in clean.delinq_members(base, Variant(delinq_filter_on="int")).collect()}
    assert set(lib) == {"m1", "m3"} and nb == {"m3"}
    assert lib["m1"][3] == 0 and lib["m3"][1] == 2 and lib["m3"][3] == 3
    detail = {r.member_id: tuple(r)[1:] for r in clean.record_detail(base).collect()}
    assert detail == {"m1": (0, 0, 0), "m2": (1, 0, 0), "m3": (0, 0, 0)}
    filtered = {r.member_id for r in clean.record_detail(base, Variant(record_detail="filtered")).collect()}
    assert filtered == {"m2"}
    assert {r.member_id for r in clean.record_members(base).collect()} == {"m2"}


def test_float_counters_that_no_int_holds(spark):
    from pyspark.sql import functions as F
    from lendwise.functions import rules
    from lendwise.operators import clean
    cells = [float("nan"), float("inf"), float("-inf"), 1e12, 2.9, -0.5, None]
    rows = spark.createDataFrame([(f"m{i}", x, 1.0, x) for i, x in enumerate(cells)],
                                 "member_id string, delinq_2yrs float, delinq_amnt float, mths_since_last_delinq float")
    got = [r.n for r in rows.select(rules.int_or_zero("delinq_2yrs").alias("n")).collect()]
    # Beyond an int counts as its largest value, which rates worst.
    assert got == [0, 2**31 - 1, -2**31, 2**31 - 1, 2, 0, 0]
    assert clean.delinq_members(clean.defaulters_base(rows)).count() >= 1
    assert clean.months_since_delinq_zero(rows).where(F.col("mths_since_last_delinq").isNull()).count() == 0
