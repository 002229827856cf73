"""Weighted score equals the reference's row-per-join fan-out; properties."""

from collections import Counter

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from lendwise.functions import bands
from lendwise.operators import score
from lendwise.params import Variant
from lendwise.plans.stages import Stages


def _naive_reference_rows(s: Stages):
    """The reference's fan-out, joined row by row (brute force, tiny data only)."""
    ph = s.payment_history.alias("p")
    rec = s.records_new.alias("l")
    dq = s.delinq_new.alias("d")
    ldh = (rec.join(dq, F.col("d.member_id") == F.col("l.member_id"))
              .join(ph, F.col("p.member_id") == F.col("l.member_id"))
              .join(s.bad.alias("b"), F.col("b.member_id") == F.col("l.member_id"), "left_anti")
              .select(F.col("p.member_id").alias("member_id"), "p.last_payment_pts", "p.total_payment_pts",
                      bands.delinq_pts("d.delinq_2yrs").alias("delinq_pts"),
                      bands.public_records_pts("l.pub_rec").alias("public_records_pts"),
                      bands.bankruptcies_pts("l.pub_rec_bankruptcies").alias("public_bankruptcies_pts"),
                      bands.inquiries_pts("l.inq_last_6mths").alias("enq_pts")))
    fh = (ldh.alias("x").join(s.loans.alias("ln"), F.col("ln.member_id") == F.col("x.member_id"))
             .join(s.customers_new.alias("a"), F.col("a.member_id") == F.col("x.member_id"))
             .select("x.*",
                     bands.loan_status_pts("ln.loan_status").alias("loan_status_pts"),
                     bands.home_pts("a.home_ownership").alias("home_pts"),
                     bands.credit_limit_pts("ln.funded_amount", "a.total_high_credit_limit").alias("credit_limit_pts"),
                     bands.grade_pts("a.grade", "a.sub_grade").alias("grade_pts")))
    pay = (F.col("last_payment_pts") + F.col("total_payment_pts")) * F.lit(0.2).cast("decimal(2,2)")
    dflt = (F.col("delinq_pts") + F.col("public_records_pts") + F.col("public_bankruptcies_pts")
            + F.col("enq_pts")) * F.lit(0.45).cast("decimal(3,2)")
    fin = (F.col("loan_status_pts") + F.col("home_pts") + F.col("credit_limit_pts")
           + F.col("grade_pts")) * F.lit(0.35).cast("decimal(3,2)")
    return fh.select("member_id", pay.cast("double"), dflt.cast("double"), fin.cast("double"),
                     (pay + dflt + fin).cast("double"))


def test_weighted_score_equals_expanded_fanout(spark):
    s = Stages.from_testdata(spark, SF_SMALL)
    weighted = s.loan_score
    got = Counter()
    for r in weighted.collect():
        got[r.member_id, r.payment_history_pts, r.defaulters_history_pts, r.financial_health_pts, r.loan_score] += int(r.n_rows)
    want = Counter(tuple(r) for r in _naive_reference_rows(s).collect())
    assert got == want and sum(want.values()) > 0
    assert weighted.agg(F.sum("n_rows")).first()[0] == sum(want.values())


def test_score_properties(spark):
    s = Stages.from_testdata(spark, SF_SMALL)
    rows = s.loan_score.collect()
    scored = [r for r in rows if r.loan_score is not None]
    assert scored and all(135 <= r.loan_score <= 2850 for r in scored)
    assert all(r.loan_final_grade in "ABCDEF" for r in scored)
    assert all(r.loan_final_grade is None for r in rows if r.loan_score is None)
    # rows per member stay bounded by the band domains, whatever a member's loan count
    per_member = s.loan_score.groupBy("member_id").count().agg(F.max("count")).first()[0]
    assert per_member <= 24 * 144 * 30


def test_loan_grain_is_one_row_per_loan(spark):
    s = Stages.from_testdata(spark, SF_SMALL)
    by_loan = s.loan_score_by_loan
    assert by_loan.count() == by_loan.select("loan_id").distinct().count() > 0


def test_notebook_variant_runs(spark):
    s = Stages.from_testdata(spark, SF_SMALL, variant=Variant.notebook())
    cols = s.loan_score.columns
    assert cols[:5] == ["member_id", "paymentHistory", "defaultHistory", "financialHealth", "loanScore"]
    assert s.loan_score.count() > 0


def test_cleaning_is_idempotent(spark):
    from lendwise.operators import clean
    s = Stages.from_testdata(spark, SF_SMALL)
    once = clean.drop_all_null_rows(s.loans_raw)
    twice = clean.drop_all_null_rows(once)
    assert once.count() == twice.count()
    rep = s.repayments.drop("ingest_date")
    again = clean.repayments_clean(rep).drop("ingest_date")
    assert rep.exceptAll(again).count() == 0 and again.exceptAll(rep).count() == 0


def test_notebook_audits_hold_after_cleaning(spark):
    """F19/F20 as asserted audits: no nulls or sentinels survive cleaning."""
    from lendwise.operators import audit
    s = Stages.from_testdata(spark, SF_SMALL)
    counts = {r.check: r.n for r in audit.null_counts(
        s.customers_raw, s.customers, s.repayments_raw, s.repayments, s.defaulters_base).collect()}
    assert counts["emp_length_null_clean"] == 0 and counts["emp_length_null_raw"] > 0
    assert counts["principal_null_clean"] == 0 and counts["principal_null_raw"] > 0
    assert counts["last_date_sentinel_clean"] == 0 and counts["last_date_sentinel_raw"] > 0
    assert counts["next_date_sentinel_clean"] == 0 and counts["next_date_sentinel_raw"] > 0
    rows = {r.stage: r.n for r in audit.row_counts(
        {"raw": s.loans_raw, "clean": s.loans, "cust_raw": s.customers_raw,
         "cust_clean": s.customers}).collect()}
    assert rows["clean"] < rows["raw"] and rows["cust_clean"] < rows["cust_raw"]
