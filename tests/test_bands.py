"""Branch tests: one row per arm and boundary of every point rule, plus nulls."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendwise.functions import bands
from lendwise.params import ScoreParams


def _eval(spark, schema, rows, col):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_last_payment_arms(spark):
    # installment 100: <50, [50,100), =100, (100,150], >150, null
    rows = [(10.0, 100.0), (50.0, 100.0), (99.0, 100.0), (100.0, 100.0), (101.0, 100.0),
            (150.0, 100.0), (151.0, 100.0), (None, 100.0), (100.0, None)]
    got = _eval(spark, "a float, i float", rows, bands.last_payment_pts("a", "i"))
    assert got == [100, 100, 100, 500, 650, 650, 800, 0, 0]


def test_last_payment_below_half_override(spark):
    p = ScoreParams(below_half_installment_pts=0)
    got = _eval(spark, "a float, i float", [(10.0, 100.0), (60.0, 100.0)], bands.last_payment_pts("a", "i", p))
    assert got == [0, 100]


def test_total_payment_arms(spark):
    rows = [(50.0, 100.0), (80.0, 100.0), (49.0, 100.0), (0.0, 100.0), (None, 100.0), (-5.0, 100.0)]
    got = _eval(spark, "t float, f float", rows, bands.total_payment_pts("t", "f"))
    assert got == [650, 650, 500, 0, 0, None]


@pytest.mark.parametrize("rule,worst", [
    (bands.delinq_pts, 750), (bands.public_records_pts, 100),
    (bands.bankruptcies_pts, 100), (bands.inquiries_pts, 0)])
def test_count_bands(spark, rule, worst):
    rows = [(0,), (1,), (2,), (3,), (5,), (6,), (None,), (-1,)]
    got = _eval(spark, "c int", rows, rule("c"))
    assert got == [800, 250, 250, 100, 100, worst, worst, None]


def test_delinq_worst_override(spark):
    got = _eval(spark, "c int", [(9,)], bands.delinq_pts("c", ScoreParams(worst_delinq_pts=0)))
    assert got == [0]


def test_loan_status_arms(spark):
    rows = [("Fully Paid",), ("Current",), ("In Grace Period",), ("Late (16-30 days)",),
            ("Late (31-120 days)",), ("Charged Off",), ("Default",),
            ("Does not meet the credit policy. Status:Fully Paid",), (None,)]
    got = _eval(spark, "s string", rows, bands.loan_status_pts("s"))
    assert got == [800, 500, 250, 100, 100, 0, 0, 800, 0]


def test_home_arms(spark):
    rows = [("OWN",), ("RENT",), ("MORTGAGE",), ("ANY",), (None,), ("OTHER",), ("NONE",)]
    got = _eval(spark, "h string", rows, bands.home_pts("h"))
    assert got == [800, 500, 250, 100, 100, None, None]


def test_credit_limit_arms(spark):
    h = 1000.0
    rows = [(100.0, h), (101.0, h), (200.0, h), (300.0, h), (500.0, h), (700.0, h), (701.0, h), (5.0, None)]
    got = _eval(spark, "f float, h float", rows, bands.credit_limit_pts("f", "h"))
    assert got == [800, 650, 650, 500, 250, 100, 0, 0]


def test_grade_arms(spark):
    rows = [("A", "A1"), ("A", "A2"), ("B", "B5"), ("C", "C3"), ("D", "D4"), ("E", "E2"),
            ("F", "F1"), ("G", "G5"), ("A", "Z9"), ("A", "B1"), (None, None)]
    got = _eval(spark, "g string, s string", rows, bands.grade_pts("g", "s"))
    assert got == [Decimal("800.00"), Decimal("760.00"), Decimal("520.00"), Decimal("450.00"),
                   Decimal("212.50"), Decimal("95.00"), Decimal("0.00"), Decimal("0.00"),
                   None, None, None]


def test_loan_grade_boundaries(spark):
    rows = [(2500.01,), (2500.0,), (2000.01,), (2000.0,), (1500.0,), (1000.0,), (750.01,),
            (750.0,), (135.0,), (None,)]
    got = _eval(spark, "x double", rows, bands.loan_grade("x"))
    assert got == ["A", "B", "B", "C", "D", "E", "E", "F", "F", None]


def test_compiled_rules_are_codegen_case_when(spark):
    df = spark.createDataFrame([("A", "A1")], "g string, s string").select(
        bands.grade_pts("g", "s").alias("p"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan and "PythonUDF" not in plan and "ArrowEvalPython" not in plan
