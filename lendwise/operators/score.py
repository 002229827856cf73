"""Loan score (G1–G18, J1, J2, J5, J6) without emitting all pairs per member.

The reference scores one row per joined row: with *n* loans, *q*
delinquency rows and *r* record rows a member yields ``n·q·r·n`` rows,
because the loan id is dropped before loans are joined back by member.  A
member holding a large share of the data would make that product explode.

Here every factor is first reduced to ``(member, point values) -> count``
with a partial+final hash aggregate (a hot member collapses map-side), and
only these bounded per-member frames are joined.  The result is the same
multiset of score rows, written once per distinct row with its multiplicity
in ``n_rows``.  Point values come from finite bands, so the rows per member
are bounded by the band domains, not by how many loans the member has.
Multiplicities of joined frames are ``decimal(38,0)``: a member with 3e8 rows
in each of four factors has 8.1e33 joined rows, more than a long can count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.functions import bands
from lendwise.operators.quarantine import keep_known, not_in
from lendwise.params import DEFAULT_PARAMS, DEFAULT_VARIANT, ScoreParams, Variant

KEY = "member_id"
N = "n_rows"
MULTIPLICITY = "decimal(38,0)"
PAY_COLS = ("last_payment_pts", "total_payment_pts")
DEFAULT_COLS = ("delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts")
HEALTH_COLS = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")


def _dec(x: Decimal) -> Column:
    return F.lit(x)


def _weighted_count(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(KEY, *cols).agg(F.count(F.lit(1)).alias(N))


def _product(*counts: str) -> Column:
    """Product of counts, wider than a long."""
    out = F.col(counts[0]).cast(MULTIPLICITY)
    for c in counts[1:]:
        out = (out * F.col(c).cast(MULTIPLICITY)).cast(MULTIPLICITY)
    return out


def _product_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two weighted frames on member; multiplicities multiply."""
    r = right.withColumnRenamed(N, "_n_right")
    return (left.join(r, on=KEY, how=how)
                .withColumn(N, _product(N, "_n_right")).drop("_n_right"))


# -- per-row point frames ---------------------------------------------------

def payment_points(loans: DataFrame, repayments: DataFrame,
                   p: ScoreParams = DEFAULT_PARAMS, carry: tuple[str, ...] = ()) -> DataFrame:
    """J1 + G1 + G2: one row per loan ⋈ repayment (equi join on loan_id).

    ``carry`` names further loan columns to keep, so a caller that needs
    them does not join loans a second time.
    """
    cols = ["loan_id", KEY, "monthly_installment", "funded_amount",
            *[c for c in carry if c != "funded_amount"]]
    joined = repayments.join(loans.select(*cols), on="loan_id", how="inner")
    return joined.select(
        "loan_id", KEY, *carry,
        bands.last_payment_pts("last_payment_amount", "monthly_installment", p).alias("last_payment_pts"),
        bands.total_payment_pts("total_payment_received", "funded_amount", p).alias("total_payment_pts"))


def _members_only(points: DataFrame, known: DataFrame, bad: DataFrame, variant: Variant) -> DataFrame:
    """V6: points of known members, or of members not on the list."""
    return not_in(points, bad) if variant.payment_membership == "not_bad" else keep_known(points, known)


def payment_history(loans: DataFrame, repayments: DataFrame, customers_new: DataFrame,
                    bad: DataFrame, variant: Variant = DEFAULT_VARIANT,
                    p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """Payment points of members known to customers_new (V6: or not bad).

    Only the member ids of ``customers_new`` are used, so any frame holding
    them (e.g. ``Stages.known_members``) can be passed.
    """
    return history_of_points(payment_points(loans, repayments, p), customers_new, bad, variant)


def history_of_points(points: DataFrame, customers_new: DataFrame, bad: DataFrame,
                      variant: Variant = DEFAULT_VARIANT) -> DataFrame:
    """G15 from payment points that have been written once."""
    return _members_only(points, customers_new, bad, variant).select(KEY, *PAY_COLS)


def delinq_points(delinq_new: DataFrame, p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G3 per delinquency row."""
    return delinq_new.select(KEY, bands.delinq_pts("delinq_2yrs", p).alias("delinq_pts"))


def record_points(records_new: DataFrame, p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G4–G6 per record row."""
    return records_new.select(
        KEY,
        bands.public_records_pts("pub_rec", p).alias("public_records_pts"),
        bands.bankruptcies_pts("pub_rec_bankruptcies", p).alias("public_bankruptcies_pts"),
        bands.inquiries_pts("inq_last_6mths", p).alias("enq_pts"))


def health_points(loans: DataFrame, customers_new: DataFrame,
                  p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G7–G10 per loan ⋈ customer row (customers_new has one row per member)."""
    cust = customers_new.select(KEY, "home_ownership", "total_high_credit_limit",
                                "grade", "sub_grade")
    joined = loans.select(KEY, "loan_status", "funded_amount").join(cust, on=KEY, how="inner")
    return joined.select(
        KEY,
        bands.loan_status_pts("loan_status", p).alias("loan_status_pts"),
        bands.home_pts("home_ownership", p).alias("home_pts"),
        bands.credit_limit_pts("funded_amount", "total_high_credit_limit", p).alias("credit_limit_pts"),
        bands.grade_pts("grade", "sub_grade", p).alias("grade_pts"))


# -- weighted reference-grain results --------------------------------------

def _not_in_opt(df: DataFrame, bad: DataFrame | None) -> DataFrame:
    return df if bad is None else not_in(df, bad)


def default_history(ph: DataFrame, delinq_new: DataFrame, records_new: DataFrame,
                    bad: DataFrame | None, p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G16 (J5 + J3 + G3..G6), weighted: payment ⋈ delinquency ⋈ records.

    ``bad=None`` skips the NOT IN when ``records_new`` was already
    quarantined with the same list (it would remove nothing).
    """
    rec = _not_in_opt(_weighted_count(record_points(records_new, p), *DEFAULT_COLS[1:]), bad)
    dq = _weighted_count(delinq_points(delinq_new, p), "delinq_pts")
    pay = _weighted_count(ph, *PAY_COLS)
    out = _product_join(_product_join(pay, dq), rec)
    return out.select(KEY, *PAY_COLS, *DEFAULT_COLS, N)


def financial_health(ldh: DataFrame, loans: DataFrame, customers_new: DataFrame,
                     bad: DataFrame | None = None, p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G17 (J6 + J3 + G7..G10), weighted: default history ⋈ loans ⋈ customers.

    The reference's NOT IN on this side never removes a row: every health
    row is inner-joined with customers_new, which already excludes the list.
    Pass ``bad`` only for a customers table that was not quarantined.
    """
    fh = _not_in_opt(_weighted_count(health_points(loans, customers_new, p), *HEALTH_COLS), bad)
    out = _product_join(ldh, fh)
    return out.select(KEY, *PAY_COLS, *DEFAULT_COLS, *HEALTH_COLS, N)


def _sum(cols) -> Column:
    out = None
    for c in cols:
        out = F.col(c) if out is None else out + F.col(c)
    return out


def score_factors(ph: DataFrame, delinq_new: DataFrame, records_new: DataFrame,
                  loans: DataFrame, customers_new: DataFrame, bad: DataFrame | None,
                  p: ScoreParams = DEFAULT_PARAMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unweighted component sums per member, each with its multiplicity."""
    pay = ph.select(KEY, _sum(PAY_COLS).alias("pay_sum"))
    pay = _weighted_count(pay, "pay_sum")

    rec = record_points(records_new, p).select(KEY, _sum(DEFAULT_COLS[1:]).alias("rec_sum"))
    rec = _not_in_opt(_weighted_count(rec, "rec_sum"), bad)
    dq = _weighted_count(delinq_points(delinq_new, p), "delinq_pts")
    dflt = _product_join(dq, rec).select(
        KEY, (F.col("delinq_pts") + F.col("rec_sum")).alias("default_sum"), N)
    dflt = dflt.groupBy(KEY, "default_sum").agg(F.sum(N).cast(MULTIPLICITY).alias(N))

    fh = health_points(loans, customers_new, p).select(KEY, _sum(HEALTH_COLS).alias("health_sum"))
    fh = _weighted_count(fh, "health_sum")  # customers_new already excludes the list
    return pay, dflt, fh


def loan_score_final(ph: DataFrame, delinq_new: DataFrame, records_new: DataFrame,
                     loans: DataFrame, customers_new: DataFrame, bad: DataFrame | None,
                     variant: Variant = DEFAULT_VARIANT,
                     p: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """G18 = G11/G12 -> G13 -> G14 over the weighted factors.

    Components and score are exact decimals (as the reference's
    ``int * 0.20`` arithmetic) and are returned as double.
    """
    pay, dflt, fh = score_factors(ph, delinq_new, records_new, loans, customers_new, bad, p)
    rows = _product_join(_product_join(pay, dflt), fh)
    ps, ds, hs = F.col("pay_sum"), F.col("default_sum"), F.col("health_sum")
    if variant.components == "raw":
        score = ps * _dec(p.payment_weight) + ds * _dec(p.default_weight) + hs * _dec(p.health_weight)
        return rows.select(
            KEY,
            ps.cast("double").alias("paymentHistory"),
            ds.cast("double").alias("defaultHistory"),
            hs.cast("double").alias("financialHealth"),
            score.cast("double").alias("loanScore"),
            bands.loan_grade(score, p).alias("loan_final_grade"),
            N)
    pay_pts = ps * _dec(p.payment_weight)
    def_pts = ds * _dec(p.default_weight)
    fin_pts = hs * _dec(p.health_weight)
    score = pay_pts + def_pts + fin_pts
    return rows.select(
        KEY,
        pay_pts.cast("double").alias("payment_history_pts"),
        def_pts.cast("double").alias("defaulters_history_pts"),
        fin_pts.cast("double").alias("financial_health_pts"),
        score.cast("double").alias("loan_score"),
        bands.loan_grade(score, p).alias("loan_final_grade"),
        N)


# -- join cardinality (J5, J6) -----------------------------------------------

def join_cardinality(ph: DataFrame, delinq_new: DataFrame, records_new: DataFrame,
                     loans: DataFrame | None = None, customers_new: DataFrame | None = None,
                     bad: DataFrame | None = None) -> DataFrame:
    """J5 (and J6 when loans/customers are given): joined rows per member.

    Counts per member multiply, so the size of each member's inner join is
    known without producing it.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(KEY).agg(F.count(F.lit(1)).alias(name))

    rec = counts(records_new, "n_record_rows")
    if bad is not None:
        rec = not_in(rec, bad)
    out = (counts(ph, "n_payment_rows")
           .join(counts(delinq_new, "n_delinq_rows"), on=KEY)
           .join(rec, on=KEY))
    factors = ["n_payment_rows", "n_delinq_rows", "n_record_rows"]
    if loans is not None:
        loans_per = counts(loans.join(customers_new.select(KEY), on=KEY), "n_loan_rows")
        if bad is not None:
            loans_per = not_in(loans_per, bad)
        out = out.join(loans_per, on=KEY)
        factors.append("n_loan_rows")
    return out.withColumn("joined_rows", _product(*factors))


# -- loan grain (extension: one row per loan) --------------------------------

def loan_score_by_loan(loans: DataFrame, repayments: DataFrame, customers_new: DataFrame,
                       delinq_new: DataFrame, records_new: DataFrame, bad: DataFrame,
                       variant: Variant = DEFAULT_VARIANT,
                       p: ScoreParams = DEFAULT_PARAMS,
                       records_bad: DataFrame | None = None,
                       known: DataFrame | None = None) -> DataFrame:
    """One score per loan: the loan id is kept through the payment join, and
    the member's delinquency and records are reduced to their worst values.

    Same membership rules as the reference grain (known customers, present
    in both default tables, not quarantined).
    """
    points = payment_points(loans, repayments, p, carry=CARRIED)
    return score_loans(points, customers_new, delinq_new, records_new, bad, variant, p, records_bad, known)


# What a loan's own score needs of it beside its payment points.
CARRIED = ("loan_status", "funded_amount")


def score_loans(points: DataFrame, customers_new: DataFrame, delinq_new: DataFrame, records_new: DataFrame,
                bad: DataFrame, variant: Variant = DEFAULT_VARIANT, p: ScoreParams = DEFAULT_PARAMS,
                records_bad: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """``loan_score_by_loan`` from payment points with the carried columns."""
    pay = _members_only(points, customers_new if known is None else known, bad, variant)
    worst_delinq = delinq_new.groupBy(KEY).agg(F.max("delinq_2yrs").alias("delinq_2yrs"))
    worst_rec = _not_in_opt(records_new.groupBy(KEY).agg(
        F.max("pub_rec").alias("pub_rec"),
        F.max("pub_rec_bankruptcies").alias("pub_rec_bankruptcies"),
        F.max("inq_last_6mths").alias("inq_last_6mths")), records_bad)
    cust = customers_new.select(KEY, "home_ownership", "total_high_credit_limit",
                                "grade", "sub_grade")
    row = pay.join(worst_delinq, on=KEY).join(worst_rec, on=KEY).join(cust, on=KEY)
    pay_sum = F.col("last_payment_pts") + F.col("total_payment_pts")
    def_sum = (bands.delinq_pts("delinq_2yrs", p) + bands.public_records_pts("pub_rec", p)
               + bands.bankruptcies_pts("pub_rec_bankruptcies", p)
               + bands.inquiries_pts("inq_last_6mths", p))
    fin_sum = (bands.loan_status_pts("loan_status", p) + bands.home_pts("home_ownership", p)
               + bands.credit_limit_pts("funded_amount", "total_high_credit_limit", p)
               + bands.grade_pts("grade", "sub_grade", p))
    pay_pts = pay_sum * _dec(p.payment_weight)
    def_pts = def_sum * _dec(p.default_weight)
    fin_pts = fin_sum * _dec(p.health_weight)
    score = pay_pts + def_pts + fin_pts
    return row.select(
        "loan_id", KEY,
        pay_pts.cast("double").alias("payment_history_pts"),
        def_pts.cast("double").alias("defaulters_history_pts"),
        fin_pts.cast("double").alias("financial_health_pts"),
        score.cast("double").alias("loan_score"),
        bands.loan_grade(score, p).alias("loan_final_grade"))
