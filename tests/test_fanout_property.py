"""Property: on random tables the weighted score is the naive fan-out, grouped."""

from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendwise.functions import bands
from lendwise.operators import score

MEMBERS = ["m0", "m1", "m2"]

loan_rows = st.lists(st.tuples(st.sampled_from(MEMBERS),
                               st.sampled_from([100.0, 40.0]),
                               st.sampled_from([1000.0, 30000.0, None]),
                               st.sampled_from(["Fully Paid", "Current", "Charged Off", "Default"])),
                     min_size=1, max_size=6)
pay_rows = st.lists(st.tuples(st.sampled_from([10.0, 40.0, 100.0, 120.0, 400.0, None]),
                              st.sampled_from([0.0, 300.0, 900.0])), min_size=6, max_size=6)
count_val = st.one_of(st.none(), st.integers(min_value=0, max_value=8))
delinq_rows = st.lists(st.tuples(st.sampled_from(MEMBERS), count_val), max_size=5)
record_rows = st.lists(st.tuples(st.sampled_from(MEMBERS), count_val, count_val, count_val), max_size=5)
cust_rows = st.tuples(*[st.tuples(st.sampled_from(["OWN", "RENT", "OTHER", None]),
                                  st.sampled_from([10000.0, 100000.0, None]),
                                  st.sampled_from([("A", "A2"), ("C", "C5"), ("F", "F1"), ("B", "Z9")]))
                        for _ in MEMBERS])


@settings(max_examples=6, deadline=None)
@given(loan_rows, pay_rows, delinq_rows, record_rows, cust_rows)
def test_weighted_score_equals_naive_fanout(spark, loans_in, pays, delinq_in, records_in, custs):
    loans = spark.createDataFrame(
        [(f"l{i}", m, inst, funded, status) for i, (m, inst, funded, status) in enumerate(loans_in)],
        "loan_id string, member_id string, monthly_installment float, funded_amount float, loan_status string")
    repayments = spark.createDataFrame(
        [(f"l{i}", a, t) for i, (a, t) in enumerate(pays[:len(loans_in)])],
        "loan_id string, last_payment_amount float, total_payment_received float")
    customers = spark.createDataFrame(
        [(m, h, lim, g, sg) for m, (h, lim, (g, sg)) in zip(MEMBERS, custs)],
        "member_id string, home_ownership string, total_high_credit_limit float, grade string, sub_grade string")
    delinq = spark.createDataFrame(delinq_in, "member_id string, delinq_2yrs int")
    records = spark.createDataFrame(records_in, "member_id string, pub_rec int, pub_rec_bankruptcies int, "
                                                "inq_last_6mths int")
    bad = spark.createDataFrame([], "member_id string")

    ph = score.payment_history(loans, repayments, customers, bad)
    weighted = score.loan_score_final(ph, delinq, records, loans, customers, None)
    got = Counter()
    for r in weighted.collect():
        got[(r.member_id, r.payment_history_pts, r.defaulters_history_pts,
             r.financial_health_pts, r.loan_score, r.loan_final_grade)] += r.n_rows

    # brute force: the reference's joins, row by row
    p = ph.alias("p")
    naive = (records.alias("l").join(delinq.alias("d"), F.col("d.member_id") == F.col("l.member_id"))
             .join(p, F.col("p.member_id") == F.col("l.member_id"))
             .join(loans.alias("ln"), F.col("ln.member_id") == F.col("l.member_id"))
             .join(customers.alias("a"), F.col("a.member_id") == F.col("l.member_id")))
    pay = (F.col("p.last_payment_pts") + F.col("p.total_payment_pts")) * F.lit(0.2).cast("decimal(2,2)")
    dflt = (bands.delinq_pts("d.delinq_2yrs") + bands.public_records_pts("l.pub_rec")
            + bands.bankruptcies_pts("l.pub_rec_bankruptcies")
            + bands.inquiries_pts("l.inq_last_6mths")) * F.lit(0.45).cast("decimal(3,2)")
    fin = (bands.loan_status_pts("ln.loan_status") + bands.home_pts("a.home_ownership")
           + bands.credit_limit_pts("ln.funded_amount", "a.total_high_credit_limit")
           + bands.grade_pts("a.grade", "a.sub_grade")) * F.lit(0.35).cast("decimal(3,2)")
    total = pay + dflt + fin
    rows = naive.select(F.col("l.member_id"), pay.cast("double"), dflt.cast("double"),
                        fin.cast("double"), total.cast("double"), bands.loan_grade(total)).collect()
    want = Counter(tuple(r) for r in rows)
    assert got == want
