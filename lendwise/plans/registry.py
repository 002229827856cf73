"""Query registry: one Spark query and one oracle SQL per SURVEY §2 key.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables.  Audit timestamps (``ingest_date``) are left out of
compared outputs because they differ between engines by construction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.functions import bands
from lendwise.functions import rules
from lendwise.functions.keys import pack, unpack
from lendwise.operators import audit, clean, quarantine, score, split, views
from lendwise.params import DEFAULT_PARAMS, ScoreParams, Variant
from lendwise.plans import oracle
from lendwise.plans.oracle import with_ctes
from lendwise.plans.stages import Stages, keyed_raw_plan, staged_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

NOTEBOOK = Variant.notebook()
# D8 override: the worst delinquency band scores 0 points instead of 750.
OVERRIDE_PARAMS = replace(DEFAULT_PARAMS, worst_delinq_pts=0)


def register(key: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


_STAGE_GRAPHS: dict[tuple, Stages] = {}


def stages(spark: SparkSession, sf_dir: str, variant: Variant | None = None,
           params: ScoreParams | None = None) -> Stages:
    """The lazy stage graph over ``sf_dir``, built once per application.

    Only logical plans are reused (analysis is the costly part of building
    them); every action still executes its whole plan.
    """
    variant = variant or Variant()
    params = params or DEFAULT_PARAMS
    path = staged_path(spark, sf_dir)
    key = (spark.sparkContext.applicationId, path, variant, params)
    graph = _STAGE_GRAPHS.get(key)
    if graph is None:
        graph = _STAGE_GRAPHS[key] = Stages(spark.read.parquet(path), variant=variant, params=params,
                                            raw_is_keyed=True)
    return graph


def over_stages(fn: Callable[[Stages], DataFrame], **stage_kw) -> QueryFn:
    """A query ``(spark, sf_dir)`` from a function of the stage graph."""
    return lambda spark, sf_dir: fn(stages(spark, sf_dir, **stage_kw))


def no_audit(df: DataFrame) -> DataFrame:
    return df.drop("ingest_date")


CUST_COLS = ("member_id, emp_title, emp_length, home_ownership, annual_income, address_state, "
             "address_zipcode, address_country, grade, sub_grade, verification_status, "
             "total_high_credit_limit, application_type, join_annual_income, verification_status_joint")

# ---------------------------------------------------------------- projections

register("member_key", with_ctes("SELECT id, member_id FROM keyed"))(
    lambda spark, d: stages(spark, d).keyed.select("id", "member_id"))

register("split_customers", with_ctes("""
SELECT member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code,
       'USA' AS country, grade, sub_grade, verification_status, tot_hi_cred_lim,
       application_type, annual_inc_joint, verification_status_joint FROM keyed"""))(
    lambda spark, d: split.split_customers(stages(spark, d).keyed))

register("split_loans", with_ctes("""
SELECT id AS loan_id, member_id, loan_amnt, funded_amnt, term, int_rate, installment,
       issue_d, loan_status, purpose, title FROM keyed"""))(
    lambda spark, d: split.split_loans(stages(spark, d).keyed))

register("split_repayments", with_ctes("""
SELECT id AS loan_id, total_rec_prncp, total_rec_int, total_rec_late_fee, total_pymnt,
       last_pymnt_amnt, last_pymnt_d, next_pymnt_d FROM keyed"""))(
    lambda spark, d: split.split_repayments(stages(spark, d).keyed))

register("split_defaulters", with_ctes("""
SELECT member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths,
       total_rec_late_fee, mths_since_last_delinq, mths_since_last_record FROM keyed"""))(
    lambda spark, d: split.split_defaulters(stages(spark, d).keyed))

register("conform_customers", with_ctes("SELECT * FROM cust_renamed"))(
    lambda spark, d: clean.rename_strict(stages(spark, d).customers_raw, clean.CUSTOMER_RENAMES))


@register("conform_term", with_ctes("SELECT loan_id, loan_term_years FROM loans_f8"))
def _conform_term(spark, d):
    loans = clean.require(clean.drop_all_null_rows(stages(spark, d).loans_raw), clean.LOAN_REQUIRED)
    return (loans.withColumn("loan_term_months", rules.term_years("loan_term_months"))
                 .withColumnRenamed("loan_term_months", "loan_term_years")
                 .select("loan_id", "loan_term_years"))


register("audit_timestamp", with_ctes("SELECT loan_id, TRUE AS has_ingest_date FROM loans_clean"))(
    lambda spark, d: stages(spark, d).loans.select(
        "loan_id", F.col("ingest_date").isNotNull().alias("has_ingest_date")))

register("project_star_plus", with_ctes(
    f"SELECT *, {oracle.status_points('loan_status')} AS loan_status_pts FROM loans_clean"))(
    lambda spark, d: no_audit(stages(spark, d).loans).select(
        "*", bands.loan_status_pts("loan_status").alias("loan_status_pts")))

register("drop_column", with_ctes(
    "SELECT loan_id, total_principal_received, total_interest_received, total_late_fee_received, "
    "total_payment_received, last_payment_amount, last_payment_date FROM rep_clean"))(
    lambda spark, d: no_audit(stages(spark, d).repayments).drop("next_payment_date"))

# ---------------------------------------------------------------- cleaning rules

register("require_income", with_ctes("SELECT * FROM cust_f1"))(
    lambda spark, d: clean.require(
        clean.dedupe_rows(clean.rename_strict(stages(spark, d).customers_raw, clean.CUSTOMER_RENAMES)),
        ["annual_income"]))

register("drop_all_null_rows", with_ctes("""
SELECT * FROM loans_raw WHERE NOT (loan_id IS NULL AND member_id IS NULL AND loan_amount IS NULL
  AND funded_amount IS NULL AND loan_term_months IS NULL AND interest_rate IS NULL
  AND monthly_installment IS NULL AND issue_date IS NULL AND loan_status IS NULL
  AND loan_purpose IS NULL AND loan_title IS NULL)"""))(
    lambda spark, d: clean.drop_all_null_rows(stages(spark, d).loans_raw))

register("require_loan_fields", with_ctes("SELECT * FROM loans_f3"))(
    lambda spark, d: clean.require(clean.drop_all_null_rows(stages(spark, d).loans_raw),
                                   clean.LOAN_REQUIRED))

register("require_repayment_fields", with_ctes("SELECT * FROM rep_f4"))(
    lambda spark, d: clean.require(stages(spark, d).repayments_raw, clean.REPAYMENT_REQUIRED))

register("emp_length_digits", with_ctes(
    "SELECT member_id, emp_length AS emp_length_text, "
    "TRY_CAST(regexp_replace(emp_length, '\\D', '', 'g') AS INTEGER) AS emp_length FROM cust_raw"))(
    lambda spark, d: stages(spark, d).customers_raw.select(
        "member_id", F.col("emp_length").alias("emp_length_text"),
        rules.digits_to_int("emp_length").alias("emp_length")))


@register("emp_length_impute", with_ctes(
    "SELECT member_id, COALESCE(emp_length, (SELECT m FROM cust_mean)) AS emp_length FROM cust_f5"))
def _emp_impute(spark, d):
    df = clean.require(clean.dedupe_rows(clean.rename_strict(
        stages(spark, d).customers_raw, clean.CUSTOMER_RENAMES)), ["annual_income"])
    df = df.withColumn("emp_length", rules.digits_to_int("emp_length"))
    return clean.impute_mean_floor(df, "emp_length").select("member_id", "emp_length")


register("state_na", with_ctes(
    "SELECT member_id, addr_state, CASE WHEN length(addr_state) > 2 THEN 'NA' ELSE addr_state END "
    "AS address_state FROM cust_raw"))(
    lambda spark, d: stages(spark, d).customers_raw.select(
        "member_id", "addr_state", rules.state_or_na("addr_state").alias("address_state")))

register("term_years", with_ctes(
    "SELECT loan_id, loan_term_months, CAST(trunc(TRY_CAST(regexp_replace(loan_term_months, '\\D', '', 'g') "
    "AS INTEGER) / 12) AS INTEGER) AS loan_term_years FROM loans_raw"))(
    lambda spark, d: stages(spark, d).loans_raw.select(
        "loan_id", "loan_term_months", rules.term_years("loan_term_months").alias("loan_term_years")))

register("term_years_suffix", with_ctes(
    "SELECT loan_id, loan_term_months, CAST(trunc(TRY_CAST(regexp_replace(loan_term_months, ' months', '', 'g') "
    "AS INTEGER) / 12) AS INTEGER) AS loan_term_years FROM loans_raw"))(
    lambda spark, d: stages(spark, d).loans_raw.select(
        "loan_id", "loan_term_months", rules.term_years("loan_term_months", "suffix").alias("loan_term_years")))

register("purpose_enum", with_ctes(
    "SELECT loan_id, loan_purpose AS purpose_text, CASE WHEN loan_purpose IN ("
    + ", ".join("'" + x + "'" for x in oracle.PURPOSE_ENUM)
    + ") THEN loan_purpose ELSE 'other' END AS loan_purpose FROM loans_raw"))(
    lambda spark, d: stages(spark, d).loans_raw.select(
        "loan_id", F.col("loan_purpose").alias("purpose_text"),
        rules.purpose_or_other("loan_purpose").alias("loan_purpose")))

register("repair_total_payment", with_ctes(
    "SELECT loan_id, CASE WHEN total_principal_received <> 0.0 AND total_payment_received = 0.0 "
    "THEN total_principal_received + total_interest_received + total_late_fee_received "
    "ELSE total_payment_received END AS total_payment_received FROM rep_f4"))(
    lambda spark, d: clean.require(stages(spark, d).repayments_raw, clean.REPAYMENT_REQUIRED).select(
        "loan_id", rules.repaired_total("total_principal_received", "total_interest_received",
                                        "total_late_fee_received", "total_payment_received")
        .alias("total_payment_received")))

register("recompute_total_payment", with_ctes(
    "SELECT loan_id, total_principal_received + total_interest_received + total_late_fee_received "
    "AS total_payment_received FROM rep_f4"))(
    lambda spark, d: clean.require(stages(spark, d).repayments_raw, clean.REPAYMENT_REQUIRED).select(
        "loan_id", rules.recomputed_total("total_principal_received", "total_interest_received",
                                          "total_late_fee_received").alias("total_payment_received")))

register("drop_zero_total", with_ctes(
    "SELECT loan_id, total_principal_received + total_interest_received + total_late_fee_received "
    "AS total_payment_received FROM rep_f4 WHERE total_principal_received + total_interest_received "
    "+ total_late_fee_received <> 0.0"))(
    lambda spark, d: clean.require(stages(spark, d).repayments_raw, clean.REPAYMENT_REQUIRED).select(
        "loan_id", rules.recomputed_total("total_principal_received", "total_interest_received",
                                          "total_late_fee_received").alias("total_payment_received"))
    .filter(F.col("total_payment_received") != 0.0))

register("null_date_sentinel", with_ctes(
    "SELECT loan_id, CASE WHEN last_payment_date = '0.0' THEN NULL ELSE last_payment_date END AS "
    "last_payment_date, CASE WHEN next_payment_date = '0.0' THEN NULL ELSE next_payment_date END AS "
    "next_payment_date FROM rep_raw"))(
    lambda spark, d: stages(spark, d).repayments_raw.select(
        "loan_id", rules.null_if_sentinel("last_payment_date").alias("last_payment_date"),
        rules.null_if_sentinel("next_payment_date").alias("next_payment_date")))

register("delinq_counter", with_ctes("SELECT member_id, delinq_2yrs FROM def_base"))(
    lambda spark, d: stages(spark, d).defaulters_base.select("member_id", "delinq_2yrs"))

register("delinq_members", with_ctes("SELECT * FROM delinq"))(
    lambda spark, d: stages(spark, d).delinq)

register("record_members", with_ctes("SELECT * FROM record_members"))(
    lambda spark, d: stages(spark, d).record_members)

register("record_detail_all", with_ctes("SELECT * FROM rec_all"))(
    lambda spark, d: stages(spark, d).records)

register("record_detail_filtered", with_ctes("SELECT * FROM records", NOTEBOOK))(
    lambda spark, d: clean.record_detail(stages(spark, d).defaulters_base, NOTEBOOK))

register("months_since_delinq_zero", with_ctes(
    "SELECT member_id, COALESCE(CAST(trunc(mths_since_last_delinq) AS INTEGER), 0) "
    "AS mths_since_last_delinq FROM def_raw"))(
    lambda spark, d: clean.months_since_delinq_zero(stages(spark, d).defaulters_raw)
    .select("member_id", "mths_since_last_delinq"))

register("audit_null_counts", with_ctes("""
SELECT 'emp_length_null_raw' AS check_name, count(*) FILTER (WHERE emp_length IS NULL) AS n FROM cust_raw
UNION ALL SELECT 'emp_length_null_clean', count(*) FILTER (WHERE emp_length IS NULL) FROM cust_clean
UNION ALL SELECT 'principal_null_raw', count(*) FILTER (WHERE total_principal_received IS NULL) FROM rep_raw
UNION ALL SELECT 'last_date_sentinel_raw', count(*) FILTER (WHERE last_payment_date = '0.0') FROM rep_raw
UNION ALL SELECT 'next_date_sentinel_raw', count(*) FILTER (WHERE next_payment_date = '0.0') FROM rep_raw
UNION ALL SELECT 'principal_null_clean', count(*) FILTER (WHERE total_principal_received IS NULL) FROM rep_clean
UNION ALL SELECT 'last_date_sentinel_clean', count(*) FILTER (WHERE last_payment_date = '0.0') FROM rep_clean
UNION ALL SELECT 'next_date_sentinel_clean', count(*) FILTER (WHERE next_payment_date = '0.0') FROM rep_clean
UNION ALL SELECT 'delinq_zero_rows', count(*) FILTER (WHERE delinq_2yrs = 0) FROM def_base"""))(
    over_stages(lambda s: audit.null_counts(s.customers_raw, s.customers, s.repayments_raw,
                                                  s.repayments, s.defaulters_base)
                      .withColumnRenamed("check", "check_name")))


@register("audit_row_counts", with_ctes("""
SELECT 'customers_raw' AS stage, count(*) AS n FROM cust_raw
UNION ALL SELECT 'customers_dedup', count(*) FROM cust_dedup
UNION ALL SELECT 'customers_clean', count(*) FROM cust_clean
UNION ALL SELECT 'loans_raw', count(*) FROM loans_raw
UNION ALL SELECT 'loans_clean', count(*) FROM loans_clean
UNION ALL SELECT 'repayments_raw', count(*) FROM rep_raw
UNION ALL SELECT 'repayments_clean', count(*) FROM rep_clean
UNION ALL SELECT 'delinq', count(*) FROM delinq
UNION ALL SELECT 'records', count(*) FROM records
UNION ALL SELECT 'customers_new', count(*) FROM customers_new"""))
def _row_counts(spark, d):
    s = stages(spark, d)
    return audit.row_counts({
        "customers_raw": s.customers_raw,
        "customers_dedup": clean.dedupe_rows(clean.rename_strict(s.customers_raw, clean.CUSTOMER_RENAMES)),
        "customers_clean": s.customers, "loans_raw": s.loans_raw, "loans_clean": s.loans,
        "repayments_raw": s.repayments_raw, "repayments_clean": s.repayments,
        "delinq": s.delinq, "records": s.records, "customers_new": s.customers_new})


# ---------------------------------------------------------------- composite cleaning jobs

register("customers_clean", with_ctes(f"SELECT {CUST_COLS} FROM cust_clean"))(
    lambda spark, d: no_audit(stages(spark, d).customers))

register("loans_clean", with_ctes("SELECT * FROM loans_clean"))(
    lambda spark, d: no_audit(stages(spark, d).loans))

register("repayments_clean", with_ctes("SELECT * FROM rep_clean"))(
    lambda spark, d: no_audit(stages(spark, d).repayments))

register("repayments_clean_recomputed", with_ctes("SELECT * FROM rep_clean", NOTEBOOK))(
    lambda spark, d: no_audit(clean.repayments_clean(stages(spark, d).repayments_raw, NOTEBOOK)))


@register("defaulters_clean", with_ctes("""
SELECT 'delinq' AS output, member_id, delinq_2yrs, delinq_amnt, mths_since_last_delinq,
       NULL::INTEGER AS pub_rec, NULL::INTEGER AS pub_rec_bankruptcies, NULL::INTEGER AS inq_last_6mths
FROM delinq
UNION ALL SELECT 'record_members', member_id, NULL, NULL, NULL, NULL, NULL, NULL FROM record_members
UNION ALL SELECT 'record_detail', member_id, NULL, NULL, NULL, pub_rec, pub_rec_bankruptcies, inq_last_6mths
FROM records"""))
def _defaulters_clean(spark, d):
    s = stages(spark, d)
    parts = [s.delinq.withColumn("output", F.lit("delinq")),
             s.record_members.withColumn("output", F.lit("record_members")),
             s.records.withColumn("output", F.lit("record_detail"))]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True) \
                  .unionByName(parts[2], allowMissingColumns=True)
    return out.select("output", "member_id", "delinq_2yrs", "delinq_amnt", "mths_since_last_delinq",
                      "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")


# ---------------------------------------------------------------- aggregates, quarantine

register("dedupe_rows", with_ctes("SELECT * FROM cust_dedup"))(
    lambda spark, d: clean.dedupe_rows(clean.rename_strict(stages(spark, d).customers_raw,
                                                           clean.CUSTOMER_RENAMES)))


@register("mean_floor", with_ctes("SELECT m AS emp_length_mean FROM cust_mean"))
def _mean_floor(spark, d):
    df = clean.require(clean.dedupe_rows(clean.rename_strict(
        stages(spark, d).customers_raw, clean.CUSTOMER_RENAMES)), ["annual_income"])
    df = df.withColumn("emp_length", rules.digits_to_int("emp_length"))
    return df.agg(F.floor(F.avg("emp_length")).cast("int").alias("emp_length_mean"))


register("dup_members_customers", with_ctes("SELECT * FROM dup_cust"))(
    lambda spark, d: quarantine.dup_members(stages(spark, d).customers))
register("dup_members_delinq", with_ctes("SELECT * FROM dup_delinq"))(
    lambda spark, d: quarantine.dup_members(stages(spark, d).delinq))
register("dup_members_records", with_ctes("SELECT * FROM dup_rec"))(
    lambda spark, d: quarantine.dup_members(stages(spark, d).records))
register("dup_members_union", with_ctes("SELECT * FROM bad", NOTEBOOK))(
    over_stages(lambda s: quarantine.union_distinct(
        quarantine.dup_members(s.customers), quarantine.dup_members(s.delinq),
        quarantine.dup_members(s.records)), variant=NOTEBOOK))


@register("purpose_counts_before", with_ctes(
    "SELECT loan_purpose, count(loan_purpose) AS total FROM loans_f8 GROUP BY loan_purpose ORDER BY total DESC"))
def _purpose_before(spark, d):
    loans = clean.require(clean.drop_all_null_rows(stages(spark, d).loans_raw), clean.LOAN_REQUIRED)
    return audit.value_counts(loans, "loan_purpose")


register("purpose_counts_after", with_ctes(
    "SELECT loan_purpose, count(loan_purpose) AS total FROM loans_clean GROUP BY loan_purpose ORDER BY total DESC"))(
    lambda spark, d: audit.value_counts(stages(spark, d).loans, "loan_purpose"))

register("member_multiplicity", with_ctes(
    "SELECT member_id, count(*) AS total FROM records_new GROUP BY member_id ORDER BY total DESC", NOTEBOOK))(
    lambda spark, d: quarantine.member_multiplicity(stages(spark, d, variant=NOTEBOOK).records_new))

register("distinct_members", with_ctes("SELECT count(DISTINCT member_id) AS n_members FROM keyed"))(
    lambda spark, d: audit.distinct_count(stages(spark, d).keyed, "member_id", "n_members"))

register("anti_bad_members", with_ctes("SELECT * FROM records_new"))(
    over_stages(lambda s: quarantine.not_in(s.records, s.bad)))
register("customers_new", with_ctes(f"SELECT {CUST_COLS} FROM customers_new"))(
    lambda spark, d: no_audit(stages(spark, d).customers_new))
register("delinq_new", with_ctes("SELECT * FROM delinq_new"))(
    lambda spark, d: stages(spark, d).delinq_new)
register("records_new", with_ctes("SELECT * FROM records_new"))(
    lambda spark, d: stages(spark, d).records_new)
register("customers_new_notebook", with_ctes(f"SELECT {CUST_COLS} FROM customers_new", NOTEBOOK))(
    lambda spark, d: no_audit(stages(spark, d, variant=NOTEBOOK).customers_new))
register("delinq_new_notebook", with_ctes("SELECT * FROM delinq_new", NOTEBOOK))(
    lambda spark, d: stages(spark, d, variant=NOTEBOOK).delinq_new)
register("records_new_notebook", with_ctes("SELECT * FROM records_new", NOTEBOOK))(
    lambda spark, d: stages(spark, d, variant=NOTEBOOK).records_new)

# ---------------------------------------------------------------- joins

register("join_loan_repayment", with_ctes("""
SELECT loan_id, member_id, monthly_installment, funded_amount, last_payment_amount, total_payment_received
FROM loans_clean JOIN rep_clean USING (loan_id)"""))(
    over_stages(lambda s: s.repayments.join(s.loans.select(
        "loan_id", "member_id", "monthly_installment", "funded_amount"), on="loan_id", how="inner")
        .select("loan_id", "member_id", "monthly_installment", "funded_amount",
                "last_payment_amount", "total_payment_received")))

register("semi_known_members", with_ctes(
    "SELECT * FROM pay_rows WHERE member_id IN (SELECT member_id FROM customers_new)"))(
    over_stages(lambda s: quarantine.keep_known(
        score.payment_points(s.loans, s.repayments), s.customers_new)
        .select("loan_id", "member_id", "last_payment_pts", "total_payment_pts")))

register("join_default_history", with_ctes("""
SELECT x.member_id, pc.n AS n_payment_rows, dc.n AS n_delinq_rows, rc.n AS n_record_rows, x.joined_rows
FROM (SELECT member_id, CAST(count(*) AS DECIMAL(38,0)) AS joined_rows FROM ldh GROUP BY member_id) x
JOIN (SELECT member_id, count(*) AS n FROM ph GROUP BY member_id) pc ON pc.member_id = x.member_id
JOIN (SELECT member_id, count(*) AS n FROM delinq_new GROUP BY member_id) dc ON dc.member_id = x.member_id
JOIN (SELECT member_id, count(*) AS n FROM records_new GROUP BY member_id) rc ON rc.member_id = x.member_id"""))(
    over_stages(lambda s: score.join_cardinality(
        s.payment_history, s.delinq_new, s.records_new, bad=s.records_score_bad)))

register("join_financial_health", with_ctes("""
SELECT x.member_id, pc.n AS n_payment_rows, dc.n AS n_delinq_rows, rc.n AS n_record_rows,
       lc.n AS n_loan_rows, x.joined_rows
FROM (SELECT member_id, CAST(count(*) AS DECIMAL(38,0)) AS joined_rows FROM fh GROUP BY member_id) x
JOIN (SELECT member_id, count(*) AS n FROM ph GROUP BY member_id) pc ON pc.member_id = x.member_id
JOIN (SELECT member_id, count(*) AS n FROM delinq_new GROUP BY member_id) dc ON dc.member_id = x.member_id
JOIN (SELECT member_id, count(*) AS n FROM records_new GROUP BY member_id) rc ON rc.member_id = x.member_id
JOIN (SELECT member_id, count(*) AS n FROM customers_new JOIN loans_clean USING (member_id) GROUP BY member_id) lc ON lc.member_id = x.member_id"""))(
    over_stages(lambda s: score.join_cardinality(
        s.payment_history, s.delinq_new, s.records_new, s.loans, s.customers_new,
        s.records_score_bad)))

# The plain view over all customers, every source row numbered; only the last
# step takes each source row once and counts.
_PLAIN_VIEW = """
, cust AS (SELECT *, row_number() OVER () AS cust_no FROM cust_clean),
late AS (SELECT *, row_number() OVER () AS late_no FROM delinq),
filed AS (SELECT *, row_number() OVER () AS filed_no FROM records),
plain AS (
  SELECT * FROM cust LEFT JOIN loans_clean USING (member_id) LEFT JOIN rep_clean USING (loan_id)
  LEFT JOIN late USING (member_id) LEFT JOIN filed USING (member_id)),
per_member AS (
  SELECT member_id, count(DISTINCT cust_no) AS n_customers, count(DISTINCT loan_id) AS n_loans,
         count(DISTINCT late_no) AS n_delinq_rows, count(DISTINCT filed_no) AS n_record_rows,
         max(delinq_2yrs) AS worst_delinq_2yrs, max(pub_rec) AS worst_pub_rec, max(pub_rec_bankruptcies) AS worst_pub_rec_bankruptcies,
         max(inq_last_6mths) AS worst_inq_last_6mths FROM plain GROUP BY member_id)
"""


# One line a column: the parts that show it (l loan, c customer, d delinquency,
# r record), written out here so that the SQL does not follow the views' code.
_FULL_COLUMNS = """
loan_id l, member_id lcdr, emp_title c, emp_length c, home_ownership c, annual_income c, address_state c, address_zipcode c,
address_country c, grade c, sub_grade c, verification_status c, total_high_credit_limit c, application_type c, join_annual_income c,
verification_status_joint c, loan_amount l, funded_amount l, loan_term_years l, interest_rate l, monthly_installment l, issue_date l,
loan_status l, loan_purpose l, total_principal_received l, total_interest_received l, total_late_fee_received l, last_payment_date l,
next_payment_date l, delinq_2yrs d, delinq_amnt d, mths_since_last_delinq d, pub_rec r, pub_rec_bankruptcies r, inq_last_6mths r"""
_SLIM_COLUMNS = "member_id lcd, address_state c, total_payment_received l, delinq_2yrs d"


def _view_sql(columns: str, parts: str, worst: str) -> str:
    names = [c.split() for c in columns.replace("\n", " ").split(",")]
    about = {"l": ("loan", "loan_id", "TRUE"), "c": ("customer", "cust_no", "n_customers > 1 OR n_loans = 0"),
             "d": ("delinquency", "late_no", "TRUE"), "r": ("record", "filed_no", "TRUE")}

    def shown(part: str, c: str, of: str) -> str:
        if part in of:
            return c
        if part == "l" and "c" in of:
            return f"CASE WHEN n_customers = 1 THEN {c} END AS {c}"
        return f"NULL AS {c}"

    member = f"n_customers, n_loans, n_delinq_rows, n_record_rows, {worst}"
    rows = []
    for part in parts:
        name, number, where = about[part]
        kept = ", ".join(shown(part, c, of) for c, of in names)
        source = f"FROM plain JOIN per_member USING (member_id) WHERE {number} IS NOT NULL AND ({where})"
        if part in "lc":
            # The join repeats a source row, its number tells equal ones apart.
            rows.append(f"SELECT '{name}' AS part, * EXCLUDE (source_row) FROM "
                        f"(SELECT DISTINCT {kept}, 1::BIGINT AS n_rows, {member}, {number} AS source_row {source})")
        else:
            rows.append(f"SELECT '{name}' AS part, {kept}, count(DISTINCT {number}) AS n_rows, {member} {source} GROUP BY ALL")
    return _PLAIN_VIEW.lstrip() + " UNION ALL BY NAME ".join(rows)


_FULL_VIEW = _view_sql(_FULL_COLUMNS, "lcdr", "worst_delinq_2yrs, worst_pub_rec, worst_pub_rec_bankruptcies, worst_inq_last_6mths")
_SLIM_VIEW = _view_sql(_SLIM_COLUMNS, "lcd", "worst_delinq_2yrs")

def _kept_customers(spark: SparkSession, s: Stages) -> DataFrame:
    """The clean customers, written out once where several branches of a
    query read them: each would else deduplicate the whole rows again."""
    return spark.read.parquet(io.write_parquet(s.customers, scratch_path(spark, "cleaned", "customers")))


@register("consolidated_view", with_ctes(_FULL_VIEW))
def _consolidated_view(spark, d):
    s = stages(spark, d)
    return views.consolidated_view(_kept_customers(spark, s), s.loans, s.repayments, s.delinq, s.records)


@register("consolidated_view_slim", with_ctes(_SLIM_VIEW))
def _consolidated_view_slim(spark, d):
    s = stages(spark, d)
    return views.consolidated_view_slim(_kept_customers(spark, s), s.loans, s.repayments, s.delinq, s.records)

# ---------------------------------------------------------------- point rules

register("pts_last_payment", with_ctes("SELECT loan_id, member_id, last_payment_pts FROM pay_rows"))(
    over_stages(lambda s: score.payment_points(s.loans, s.repayments)
                      .select("loan_id", "member_id", "last_payment_pts")))
register("pts_total_payment", with_ctes("SELECT loan_id, member_id, total_payment_pts FROM pay_rows"))(
    over_stages(lambda s: score.payment_points(s.loans, s.repayments)
                      .select("loan_id", "member_id", "total_payment_pts")))
register("pts_delinq", with_ctes(
    f"SELECT member_id, delinq_2yrs, {oracle.count_points('delinq', 'delinq_2yrs')} AS delinq_pts FROM delinq_new"))(
    lambda spark, d: stages(spark, d).delinq_new.select(
        "member_id", "delinq_2yrs", bands.delinq_pts().alias("delinq_pts")))
register("pts_public_records", with_ctes(
    f"SELECT member_id, pub_rec, {oracle.count_points('record', 'pub_rec')} AS public_records_pts FROM records_new"))(
    lambda spark, d: stages(spark, d).records_new.select(
        "member_id", "pub_rec", bands.public_records_pts().alias("public_records_pts")))
register("pts_bankruptcies", with_ctes(
    f"SELECT member_id, pub_rec_bankruptcies, {oracle.count_points('record', 'pub_rec_bankruptcies')} "
    "AS public_bankruptcies_pts FROM records_new"))(
    lambda spark, d: stages(spark, d).records_new.select(
        "member_id", "pub_rec_bankruptcies", bands.bankruptcies_pts().alias("public_bankruptcies_pts")))
register("pts_inquiries", with_ctes(
    f"SELECT member_id, inq_last_6mths, {oracle.count_points('inquiry', 'inq_last_6mths')} AS enq_pts FROM records_new"))(
    lambda spark, d: stages(spark, d).records_new.select(
        "member_id", "inq_last_6mths", bands.inquiries_pts().alias("enq_pts")))
register("pts_loan_status", with_ctes(
    f"SELECT loan_id, loan_status, {oracle.status_points('loan_status')} AS loan_status_pts FROM loans_clean"))(
    lambda spark, d: stages(spark, d).loans.select(
        "loan_id", "loan_status", bands.loan_status_pts().alias("loan_status_pts")))
register("pts_home", with_ctes(
    f"SELECT member_id, home_ownership, {oracle.home_points('home_ownership')} AS home_pts FROM customers_new"))(
    lambda spark, d: stages(spark, d).customers_new.select(
        "member_id", "home_ownership", bands.home_pts().alias("home_pts")))
register("pts_credit_limit", with_ctes(
    f"SELECT loan_id, member_id, {oracle.limit_points('funded_amount', 'total_high_credit_limit')} AS credit_limit_pts "
    "FROM customers_new JOIN loans_clean USING (member_id)"))(
    over_stages(lambda s: s.loans.select("loan_id", "member_id", "funded_amount")
                .join(s.customers_new.select("member_id", "total_high_credit_limit"), "member_id")
                .select("loan_id", "member_id", bands.credit_limit_pts().alias("credit_limit_pts"))))
register("pts_grade", with_ctes(
    f"SELECT member_id, grade, sub_grade, CAST({oracle.grade_points('grade', 'sub_grade')} AS DOUBLE) AS grade_pts "
    "FROM customers_new"))(
    lambda spark, d: stages(spark, d).customers_new.select(
        "member_id", "grade", "sub_grade", bands.grade_pts().cast("double").alias("grade_pts")))

# ---------------------------------------------------------------- score (weighted reference grain)

_W = "CAST(count(*) AS DECIMAL(38,0)) AS n_rows"


def _regroup(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy("member_id", *cols).agg(F.sum("n_rows").cast(score.MULTIPLICITY).alias("n_rows"))


register("payment_history", with_ctes("SELECT * FROM ph"))(
    lambda spark, d: stages(spark, d).payment_history)
register("default_history", with_ctes(
    f"SELECT member_id, last_payment_pts, total_payment_pts, delinq_pts, public_records_pts, "
    f"public_bankruptcies_pts, enq_pts, {_W} FROM ldh GROUP BY ALL"))(
    lambda spark, d: stages(spark, d).default_history)
register("financial_health", with_ctes(
    f"SELECT member_id, last_payment_pts, total_payment_pts, delinq_pts, public_records_pts, "
    f"public_bankruptcies_pts, enq_pts, loan_status_pts, home_pts, credit_limit_pts, "
    f"CAST(grade_pts AS DOUBLE) AS grade_pts, {_W} FROM fh GROUP BY ALL"))(
    lambda spark, d: stages(spark, d).financial_health.withColumn(
        "grade_pts", F.col("grade_pts").cast("double")))

_FINAL_SQL = (f"SELECT member_id, payment_history_pts, defaulters_history_pts, financial_health_pts, "
              f"loan_score, loan_final_grade, {_W} FROM loan_score_rows GROUP BY ALL")

register("loan_score_final", with_ctes(_FINAL_SQL))(
    lambda spark, d: stages(spark, d).loan_score)
register("score_params", with_ctes(_FINAL_SQL, worst_delinq=0))(
    lambda spark, d: stages(spark, d, params=OVERRIDE_PARAMS).loan_score)
register("score_components", with_ctes(
    f"SELECT member_id, payment_history_pts, defaulters_history_pts, financial_health_pts, {_W} "
    "FROM loan_score_rows GROUP BY ALL"))(
    lambda spark, d: _regroup(stages(spark, d).loan_score, "payment_history_pts",
                              "defaulters_history_pts", "financial_health_pts"))
register("score_projection", with_ctes(
    f"SELECT member_id, payment_history_pts, defaulters_history_pts, financial_health_pts, {_W} "
    "FROM loan_score_rows GROUP BY ALL"))(
    lambda spark, d: stages(spark, d).loan_score.select(
        "member_id", "payment_history_pts", "defaulters_history_pts", "financial_health_pts", "n_rows"))
register("loan_score", with_ctes(f"SELECT member_id, loan_score, {_W} FROM loan_score_rows GROUP BY ALL"))(
    lambda spark, d: _regroup(stages(spark, d).loan_score, "loan_score"))
register("loan_grade", with_ctes(
    f"SELECT member_id, loan_score, loan_final_grade, {_W} FROM loan_score_rows GROUP BY ALL"))(
    lambda spark, d: _regroup(stages(spark, d).loan_score, "loan_score", "loan_final_grade"))
register("score_components_raw", with_ctes(
    f"SELECT member_id, paymentHistory, defaultHistory, financialHealth, {_W} "
    "FROM loan_score_rows GROUP BY ALL", NOTEBOOK))(
    lambda spark, d: _regroup(stages(spark, d, variant=NOTEBOOK).loan_score,
                              "paymentHistory", "defaultHistory", "financialHealth"))
register("loan_score_notebook", with_ctes(
    f"SELECT member_id, paymentHistory, defaultHistory, financialHealth, loanScore, "
    f"loan_final_grade, {_W} FROM loan_score_rows GROUP BY ALL", NOTEBOOK))(
    lambda spark, d: stages(spark, d, variant=NOTEBOOK).loan_score)

register("loan_score_by_loan", with_ctes(f"""
, worst AS (
  SELECT member_id, max(delinq_2yrs) AS late, max(pub_rec) AS rec, max(pub_rec_bankruptcies) AS bank, max(inq_last_6mths) AS inq
  FROM delinq_new JOIN records_new USING (member_id) WHERE member_id NOT IN (FROM bad) GROUP BY member_id),
rated AS (
  SELECT loan_id, member_id, last_payment_pts + total_payment_pts AS pay,
         {oracle.count_points('delinq', 'late')} + {oracle.count_points('record', 'rec')}
           + {oracle.count_points('record', 'bank')} + {oracle.count_points('inquiry', 'inq')} AS def,
         {oracle.status_points('loan_status')} + {oracle.home_points('home_ownership')}
           + {oracle.limit_points('funded_amount', 'total_high_credit_limit')} + {oracle.grade_points('grade', 'sub_grade')} AS fin
  FROM pay_rows JOIN loans_clean USING (loan_id, member_id) JOIN customers_new USING (member_id) JOIN worst USING (member_id))
SELECT loan_id, member_id, CAST(pay * 0.20 AS DOUBLE) AS payment_history_pts, CAST(def * 0.45 AS DOUBLE) AS defaulters_history_pts,
       CAST(fin * 0.35 AS DOUBLE) AS financial_health_pts, CAST(total AS DOUBLE) AS loan_score,
       {oracle.letter_of('total')} AS loan_final_grade
FROM (SELECT *, pay * 0.20 + def * 0.45 + fin * 0.35 AS total FROM rated)""".lstrip()))(
    lambda spark, d: stages(spark, d).loan_score_by_loan)

# ---------------------------------------------------------------- sources, sinks, catalog
# Each writes its input to a fresh folder under the shared root
# (spark.checkpoint.dir), then returns the lazy read-back.

import uuid  # noqa: E402
from contextlib import contextmanager  # noqa: E402

from lendwise import schemas  # noqa: E402
from lendwise.session import scratch_path  # noqa: E402
from lendwise.sources import io  # noqa: E402


@contextmanager
def _database(spark: SparkSession):
    """A database that is in use inside and gone afterwards.  What is read
    from its tables is analysed by then and reads the files."""
    name, before = "lendwise_" + uuid.uuid4().hex[:12], spark.catalog.currentDatabase()
    io.create_database(spark, name, scratch_path(spark, "catalog", name))
    io.use_database(spark, name)
    try:
        yield name
    finally:
        io.use_database(spark, before)
        io.drop_database(spark, name)


# CSV writing trims leading/trailing spaces of values (Spark's writer default),
# so the loan term text reads back without its leading space.
_LOANS_CSV_SQL = ("SELECT loan_id, member_id, loan_amount, funded_amount, ltrim(loan_term_months) AS "
                  "loan_term_months, interest_rate, monthly_installment, issue_date, loan_status, "
                  "loan_purpose, loan_title FROM loans_raw")


@register("scan_csv_inferred", with_ctes(
    "SELECT CAST(id AS INTEGER) AS loan_id, member_id, loan_amnt, funded_amnt, ltrim(term) AS term, "
    "int_rate, installment, issue_d, loan_status, purpose, title FROM keyed"))
def _scan_csv_inferred(spark, d):
    path = io.write_csv(split.split_loans(stages(spark, d).keyed), scratch_path(spark, "raw", "loans_csv"))
    return io.read_csv_inferred(spark, path)


@register("scan_csv_schema", with_ctes("SELECT * FROM cust_raw"))
def _scan_csv_schema(spark, d):
    path = io.write_csv(split.split_customers(stages(spark, d).keyed),
                        scratch_path(spark, "raw", "customers_csv"))
    return io.read_csv_schema(spark, path, schemas.CUSTOMERS_RAW)


@register("scan_csv_headerless", with_ctes(
    "SELECT * FROM def_raw UNION ALL SELECT 'member_id', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"))
def _scan_csv_headerless(spark, d):
    path = io.write_csv_one_header(split.split_defaulters(stages(spark, d).keyed),
                                   scratch_path(spark, "raw", "def_csv"))
    return io.read_csv_headerless(spark, path, schemas.DEFAULTERS_RAW)


def _lines_with_faults(df: DataFrame, path: str) -> str:
    """``df`` as header-less CSV lines in four folders by its first column, a
    number: one line in ten has text for its fourth cell, a number, one in 25 a
    field too many, and one in 25 only two fields."""
    number = F.col(df.columns[0]).cast("long")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    spoilt = [F.when(number % 10 == 3, "n/a").otherwise(c) if i == _SPOILT else c for i, c in enumerate(cells)]
    line = (F.when(number % 25 == 9, F.concat_ws(",", *spoilt[:2]))
            .when(number % 25 == 4, F.concat_ws(",", *spoilt, F.lit("surplus"))).otherwise(F.concat_ws(",", *spoilt)))
    df.select(line.alias("value"), (number % 4).alias("folder")).write.partitionBy("folder").text(path)
    return path + "/folder=*"


# The column whose cells are spoilt, counted from 0, a number in both splits:
# the late fee received of repayments, the amount funded of loans.
_SPOILT = 3


def _faulty(spark: SparkSession, d: str) -> str:
    return _lines_with_faults(split.split_repayments(stages(spark, d).keyed), scratch_path(spark, "raw", "rep_faulty"))


@register("scan_csv_permissive", with_ctes("""
SELECT loan_id, total_principal_received,
       CASE WHEN j % 25 <> 9 THEN total_interest_received END AS total_interest_received,
       CASE WHEN j % 25 <> 9 AND j % 10 <> 3 THEN total_late_fee_received END AS total_late_fee_received,
       CASE WHEN j % 25 <> 9 THEN total_payment_received END AS total_payment_received,
       CASE WHEN j % 25 <> 9 THEN last_payment_amount END AS last_payment_amount,
       CASE WHEN j % 25 <> 9 THEN last_payment_date END AS last_payment_date,
       CASE WHEN j % 25 <> 9 THEN next_payment_date END AS next_payment_date
FROM (SELECT *, CAST(loan_id AS BIGINT) AS j FROM rep_raw)"""))
def _scan_csv_permissive(spark, d):
    """Every row of a file with malformed lines, null for what cannot be read."""
    return io.read_csv_captured(spark, _faulty(spark, d), schemas.REPAYMENTS_RAW, header=False).lenient


@register("scan_csv_bad_rows", with_ctes("""
SELECT loan_id, CASE WHEN j % 25 = 9 THEN 2 WHEN j % 25 = 4 THEN 9 ELSE 8 END AS n_fields,
       CASE WHEN j % 10 = 3 THEN 'n/a' END AS unreadable,
       CASE WHEN j % 25 <> 9 THEN last_payment_amount END AS last_payment_amount
FROM (SELECT *, CAST(loan_id AS BIGINT) AS j FROM rep_raw) WHERE j % 10 = 3 OR j % 25 IN (4, 9)"""))
def _scan_csv_bad_rows(spark, d):
    """The malformed lines set aside: what was read of them, and from their
    text the number of fields and the cell that could not be read."""
    bad = io.read_csv_captured(spark, _faulty(spark, d), schemas.REPAYMENTS_RAW, header=False).bad
    fields = F.split("line", ",", -1)
    cell = F.get(fields, F.lit(_SPOILT))
    return bad.select("loan_id", F.size(fields).alias("n_fields"), F.when(cell == "n/a", cell).alias("unreadable"), "last_payment_amount")


@register("scan_csv_bad_counts", with_ctes("""
SELECT 'folder=' || (j % 4) AS folder, count(*) AS n_rows, count(*) FILTER (j % 10 = 3 OR j % 25 IN (4, 9)) AS n_bad,
       count(*) FILTER (loan_id IS NULL) AS n_without_key
FROM (SELECT *, CAST(loan_id AS BIGINT) AS j FROM rep_raw) GROUP BY ALL"""))
def _scan_csv_bad_counts(spark, d):
    """The counts per file, added up by folder as file names are Spark's."""
    counts = io.read_csv_captured(spark, _faulty(spark, d), schemas.REPAYMENTS_RAW, header=False).counts
    folder = F.regexp_extract("source", r"(folder=\d+)/[^/]+$", 1).alias("folder")
    return counts.groupBy(folder).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"),
                                      F.sum("n_without_key").alias("n_without_key"))


@register("scan_csv_failfast", with_ctes(
    _LOANS_CSV_SQL + " WHERE CAST(loan_id AS BIGINT) % 10 <> 3 AND NOT (CAST(loan_id AS BIGINT) % 25 IN (4, 9))"))
def _scan_csv_failfast(spark, d):
    """FAILFAST ends on the loans' file with malformed lines; the good rows of
    that file, written again, pass it."""
    faulty = _lines_with_faults(split.split_loans(stages(spark, d).keyed), scratch_path(spark, "raw", "loans_faulty"))
    if not io.raises_on_malformed(spark, faulty, schemas.LOANS_RAW, header=False):
        raise RuntimeError("a malformed file passed FAILFAST")
    good = io.read_csv_captured(spark, faulty, schemas.LOANS_RAW, header=False).good
    return io.read_csv_schema(spark, io.write_csv(good, scratch_path(spark, "raw", "loans_csv")), schemas.LOANS_RAW, mode="FAILFAST")


@register("scan_parquet", with_ctes("SELECT * FROM loans_clean"))
def _scan_parquet(spark, d):
    path = io.write_default(stages(spark, d).loans, scratch_path(spark, "cleaned", "loans"))
    return no_audit(io.read_default(spark, path))


@register("scan_table", with_ctes(f"SELECT {CUST_COLS} FROM cust_clean"))
def _scan_table(spark, d):
    path = io.write_parquet(stages(spark, d).customers, scratch_path(spark, "cleaned", "customers"))
    with _database(spark):
        return no_audit(io.read_table(spark, io.external_table(spark, "customers", schemas.CUSTOMERS_TABLE, path)))


@register("temp_view", with_ctes("SELECT * FROM dup_cust"))
def _temp_view(spark, d):
    view = io.temp_view(stages(spark, d).customers, "customers_" + uuid.uuid4().hex[:12])
    return spark.sql(f"SELECT member_id FROM (SELECT member_id, count(*) AS total FROM {view} "
                     "GROUP BY member_id HAVING total > 1)")


@register("sink_csv", with_ctes("SELECT * FROM cust_raw"))
def _sink_csv(spark, d):
    path = io.write_csv(split.split_customers(stages(spark, d).keyed),
                        scratch_path(spark, "raw", "customers_csv"))
    return io.read_csv_schema(spark, path, schemas.CUSTOMERS_RAW)


@register("sink_parquet", with_ctes(f"SELECT {CUST_COLS} FROM cust_clean"))
def _sink_parquet(spark, d):
    path = io.write_parquet(stages(spark, d).customers, scratch_path(spark, "cleaned", "customers"))
    return no_audit(spark.read.parquet(path))


@register("sink_default", with_ctes("SELECT * FROM delinq"))
def _sink_default(spark, d):
    path = io.write_default(stages(spark, d).delinq, scratch_path(spark, "cleaned", "delinq"))
    return spark.read.parquet(path)


@register("sink_errorifexists", with_ctes("SELECT * FROM rec_all"))
def _sink_errorifexists(spark, d):
    path = io.write_new(stages(spark, d).records, scratch_path(spark, "cleaned", "records"))
    return spark.read.parquet(path)


@register("sink_managed_table", with_ctes("SELECT * FROM dup_cust"))
def _sink_managed_table(spark, d):
    # A managed table's files go with its database, so its rows are read out
    # to the shared folder first.
    bad = stages(spark, d).bad
    with _database(spark):
        table = io.read_table(spark, io.save_table(bad, "bad_customer_data"))
        return spark.read.parquet(io.write_parquet(table, scratch_path(spark, "gold", "bad_customer_data")))


@register("external_table", with_ctes("SELECT * FROM delinq_new"))
def _external_table(spark, d):
    path = io.write_default(stages(spark, d).delinq_new, scratch_path(spark, "gold", "delinq"))
    with _database(spark):
        return io.read_table(spark, io.external_table(spark, "loans_defaulters_delinq_new", schemas.DELINQ_TABLE, path))


@register("catalog_admin", with_ctes("""
SELECT 'customers_new' AS table_name, count(*) AS n_rows FROM customers_new
UNION ALL SELECT 'loans_defaulters_delinq_new', count(*) FROM delinq_new
UNION ALL SELECT 'loans_defaulters_detail_rec_enq_new', count(*) FROM records_new"""))
def _catalog_admin(spark, d):
    # Customers and the list are written before what is made of them, so that
    # neither is computed again for each table.
    s = stages(spark, d)
    customers, delinq, records = map(pack, (_kept_customers(spark, s), s.delinq, s.records))
    with _database(spark) as db:
        path = io.write_default(unpack(quarantine.bad_members(customers, delinq, records, s.variant)), scratch_path(spark, "gold", "scratch"))
        bad = pack(io.read_table(spark, io.external_table(spark, "scratch", "member_id string", path)))
        new = quarantine.quarantine(customers, delinq, records, bad, s.variant)
        names = ("customers_new", "loans_defaulters_delinq_new", "loans_defaulters_detail_rec_enq_new")
        for name, df, ddl in zip(names, new, (schemas.CUSTOMERS_TABLE, schemas.DELINQ_TABLE, schemas.RECORDS_TABLE)):
            io.external_table(spark, name, ddl, io.write_default(unpack(df), scratch_path(spark, "gold", name)))
        io.drop_table(spark, "scratch")
        names = io.list_tables(spark, db)  # catalog metadata: three names
        parts = [spark.table(n).agg(F.count(F.lit(1)).alias("n_rows"))
                 .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
        return reduce(DataFrame.unionByName, parts)


def _registered_view(slim: bool) -> QueryFn:
    def fn(spark: SparkSession, d: str) -> DataFrame:
        s = stages(spark, d)
        with _database(spark) as db:
            for name, df, ddl in (("customers", s.customers, schemas.CUSTOMERS_TABLE),
                                  ("loans", s.loans, schemas.LOANS_TABLE),
                                  ("loans_repayments", s.repayments, schemas.REPAYMENTS_TABLE),
                                  ("delinq", s.delinq, schemas.DELINQ_TABLE),
                                  ("records", s.records, schemas.RECORDS_TABLE)):
                io.external_table(spark, f"{db}.{name}", ddl, io.write_default(df, scratch_path(spark, "gold", name)))
            view = io.persistent_view(spark, f"{db}.customers_loan_v", views.consolidated_view_sql(
                f"{db}.customers", f"{db}.loans", f"{db}.loans_repayments", f"{db}.delinq", f"{db}.records", slim=slim))
            return io.read_table(spark, view)
    return fn


register("persistent_view", with_ctes(_FULL_VIEW))(_registered_view(slim=False))
register("persistent_view_slim", with_ctes(_SLIM_VIEW))(_registered_view(slim=True))


@register("quarantine_csv", with_ctes("""
SELECT 'customers' AS list, member_id FROM dup_cust UNION ALL SELECT 'delinq', member_id FROM dup_delinq
UNION ALL SELECT 'records', member_id FROM dup_rec UNION ALL SELECT 'all', member_id FROM bad""", NOTEBOOK))
def _quarantine_csv(spark, d):
    """The three duplicate lists and their union, each written as CSV; the
    union is built from the lists as read back."""
    s = stages(spark, d, variant=NOTEBOOK)
    lists = _quarantine_lists(spark, s)
    union = quarantine.union_distinct(*lists.values())
    lists["all"] = io.read_csv_inferred(spark, io.write_csv(union, scratch_path(spark, "bad", "bad_customer_data_final")))
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("list"), "member_id") for name, df in lists.items()])


def _quarantine_lists(spark: SparkSession, s: Stages) -> dict[str, DataFrame]:
    lists = {"customers": s.customers, "delinq": s.delinq, "records": s.records}
    return {name: io.read_csv_schema(spark, io.write_csv(quarantine.dup_members(df), scratch_path(spark, "bad", name)), "member_id string")
            for name, df in lists.items()}


@register("quarantine_csv_used", with_ctes("""
SELECT 'customers' AS kept, member_id, count(*) AS n FROM customers_new GROUP BY ALL
UNION ALL SELECT 'delinq', member_id, count(*) FROM delinq_new GROUP BY ALL
UNION ALL SELECT 'records', member_id, count(*) FROM records_new GROUP BY ALL""", NOTEBOOK))
def _quarantine_csv_used(spark, d):
    """The three tables without the members of the lists as read back."""
    s = stages(spark, d, variant=NOTEBOOK)
    lists = _quarantine_lists(spark, s)
    kept = {"customers": quarantine.not_in(s.customers, quarantine.union_distinct(*lists.values())),
            "delinq": quarantine.not_in(s.delinq, lists["delinq"]), "records": quarantine.not_in(s.records, lists["records"])}
    return reduce(DataFrame.unionByName, [df.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
                                          .select(F.lit(name).alias("kept"), "member_id", "n") for name, df in kept.items()])


def _gold(attr: str, ddl: str):
    def fn(spark, d):
        df = getattr(stages(spark, d), attr)
        path = io.write_parquet(df, scratch_path(spark, "gold", attr))
        return no_audit(spark.read.schema(ddl).parquet(path))
    return fn


register("gold_customers_sink", with_ctes(f"SELECT {CUST_COLS} FROM customers_new"))(
    _gold("customers_new", schemas.CUSTOMERS_TABLE))
register("gold_delinq_sink", with_ctes("SELECT * FROM delinq_new"))(
    _gold("delinq_new", schemas.DELINQ_TABLE))
register("gold_records_sink", with_ctes("SELECT * FROM records_new"))(
    _gold("records_new", schemas.RECORDS_TABLE))

# ---------------------------------------------------------------- streaming ingest
from lendwise.streaming import ingest  # noqa: E402
from lendwise.streaming import lists as stream_lists  # noqa: E402


@register("stream_split_loans", with_ctes(
    "SELECT id AS loan_id, member_id, loan_amnt, funded_amnt, ltrim(term) AS term, int_rate, "
    "installment, issue_d, loan_status, purpose, title FROM keyed"))
def _stream_split_loans(spark, d):
    """Raw rows arrive as CSV files; the stream keys and splits them."""
    src = scratch_path(spark, "incoming")
    io.write_csv(stages(spark, d).keyed.drop("member_id"), src, compression="gzip")
    out = scratch_path(spark, "stream-zones")
    q = ingest.start_split_stream(spark, src, out)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ingest.read_split(spark, out, "loans")


@register("stream_dup_members", with_ctes("""
SELECT 'customers' AS list, member_id FROM dup_cust UNION ALL SELECT 'delinq', member_id FROM dup_delinq
UNION ALL SELECT 'records', member_id FROM dup_rec UNION ALL SELECT 'all', member_id FROM bad""", NOTEBOOK))
def _stream_dup_members(spark, d):
    """Raw rows arrive in four lots of files, a batch each; the duplicate
    lists come from the batches' counts."""
    src, out = scratch_path(spark, "incoming"), scratch_path(spark, "stream-zones")
    keyed = stages(spark, d).keyed.drop("member_id")
    lots = [io.write_csv(keyed.where(F.col("id").cast("long") % 4 == lot), f"{src}/lot{lot}", compression="gzip") for lot in range(4)]
    # As many files a batch as a lot has: more rows make larger batches, not
    # more of them, as each batch has its own writes and state commit.
    files = max(len(spark.read.text(lot).inputFiles()) for lot in lots)
    split_stream = ingest.start_split_stream(
        spark, f"{src}/*", out, max_files_per_trigger=files,
        also=lambda rows, batch_id: stream_lists.write_default_counts(rows, out, batch_id, NOTEBOOK))
    split_stream.awaitTermination()
    customers = stream_lists.start_customer_stream(spark, f"{src}/*", out, max_files_per_trigger=files)
    customers.awaitTermination()
    for q in (split_stream, customers):
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    lists = stream_lists.duplicate_lists(spark, out)
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("list"), "member_id") for name, df in lists.items()])


# ---------------------------------------------------------------- the job's zones
from lendwise.plans import incremental, job  # noqa: E402
from lendwise.sources.published import Published  # noqa: E402


@register("published_score", with_ctes(_FINAL_SQL))
def _published_score(spark, d):
    """The score zone of the version that a whole run has published."""
    root = scratch_path(spark, "published")
    job.run(spark, keyed_raw_plan(spark, d), root=root, raw_is_keyed=True)
    return job.read_zone(spark, root, "gold/loan_score")


_OBSERVED_SQL = with_ctes("""
SELECT 'rows_customers_raw' AS check_name, count(*) AS n FROM cust_raw
UNION ALL SELECT 'rows_loans_raw', count(*) FROM loans_raw
UNION ALL SELECT 'rows_repayments_raw', count(*) FROM rep_raw
UNION ALL SELECT 'rows_defaulters_raw', count(*) FROM def_raw
UNION ALL SELECT 'rows_customers_clean', count(*) FROM cust_clean
UNION ALL SELECT 'rows_loans_clean', count(*) FROM loans_clean
UNION ALL SELECT 'rows_repayments_clean', count(*) FROM rep_clean
UNION ALL SELECT 'rows_delinq', count(*) FROM delinq
UNION ALL SELECT 'rows_records', count(*) FROM records
UNION ALL SELECT 'rows_customers_new', count(*) FROM customers_new
UNION ALL SELECT 'emp_length_null_raw', count(*) FILTER (WHERE emp_length IS NULL) FROM cust_raw
UNION ALL SELECT 'emp_length_null_clean', count(*) FILTER (WHERE emp_length IS NULL) FROM cust_clean
UNION ALL SELECT 'principal_null_raw', count(*) FILTER (WHERE total_principal_received IS NULL) FROM rep_raw
UNION ALL SELECT 'last_date_sentinel_raw', count(*) FILTER (WHERE last_payment_date = '0.0') FROM rep_raw
UNION ALL SELECT 'next_date_sentinel_raw', count(*) FILTER (WHERE next_payment_date = '0.0') FROM rep_raw
UNION ALL SELECT 'principal_null_clean', count(*) FILTER (WHERE total_principal_received IS NULL) FROM rep_clean
UNION ALL SELECT 'last_date_sentinel_clean', count(*) FILTER (WHERE last_payment_date = '0.0') FROM rep_clean
UNION ALL SELECT 'next_date_sentinel_clean', count(*) FILTER (WHERE next_payment_date = '0.0') FROM rep_clean
UNION ALL SELECT 'delinq_zero_rows', count(*) FILTER (WHERE delinq_2yrs = 0) FROM def_base""")


@register("audit_observed", _OBSERVED_SQL)
def _audit_observed(spark, d):
    """F19 and F20 as observed by the jobs that wrote the zones."""
    published = Published(spark, scratch_path(spark, "observed"))
    zones = job.Zones(published.path(published.begin()))
    job.stage_split(spark, keyed_raw_plan(spark, d), zones, raw_is_keyed=True)
    job.stage_clean(spark, zones)
    job.stage_quarantine(spark, zones)
    return spark.read.parquet(f"{zones.root}/audit/checks").select(F.col("check").alias("check_name"), "n")


@register("join_loan_repayment_bucketed", ORACLE["join_loan_repayment"])
def _join_bucketed(spark, d):
    """J1 over tables bucketed by loan: neither side is shuffled."""
    s = stages(spark, d)
    with _database(spark) as db:
        tables = [spark.table(io.save_bucketed(df, f"{db}.{name}", scratch_path(spark, "bucketed", name), "loan_id", LOAN_BUCKETS))
                  for name, df in (("loans_by_id", s.loans), ("repayments_by_id", s.repayments))]
    loans, repayments = tables
    return (repayments.join(loans.select("loan_id", "member_id", "monthly_installment", "funded_amount"), "loan_id")
            .select("loan_id", "member_id", "monthly_installment", "funded_amount", "last_payment_amount", "total_payment_received"))


# Buckets of the loan tables here; a production table has about one for each
# 128 MB.
LOAN_BUCKETS = 8


@register("table_statistics", with_ctes("""
SELECT 'customers_new' AS table_name, 'rows' AS statistic, count(*) AS n FROM customers_new
UNION ALL SELECT 'customers_new', 'home_ownership', count(*) FILTER (home_ownership IS NULL) FROM customers_new
UNION ALL SELECT 'customers_new', 'total_high_credit_limit', count(*) FILTER (total_high_credit_limit IS NULL) FROM customers_new
UNION ALL SELECT 'loans', 'rows', count(*) FROM loans_clean
UNION ALL SELECT 'loans', 'loan_status', count(*) FILTER (loan_status IS NULL) FROM loans_clean
UNION ALL SELECT 'loans_repayments', 'rows', count(*) FROM rep_clean
UNION ALL SELECT 'loans_repayments', 'next_payment_date', count(*) FILTER (next_payment_date IS NULL) FROM rep_clean"""))
def _table_statistics(spark, d):
    """What the catalog knows of registered tables once they are analysed:
    rows, and nulls by column."""
    s = stages(spark, d)
    tables = {"customers_new": (s.customers_new, schemas.CUSTOMERS_TABLE, ("home_ownership", "total_high_credit_limit")),
              "loans": (s.loans, schemas.LOANS_TABLE, ("loan_status",)),
              "loans_repayments": (s.repayments, schemas.REPAYMENTS_TABLE, ("next_payment_date",))}
    found = []
    with _database(spark):
        for name, (df, ddl, columns) in tables.items():
            io.external_table(spark, name, ddl, io.write_default(df, scratch_path(spark, "gold", name)))
            io.analyze_table(spark, name, columns)
            found += [(name, statistic, n) for statistic, n in io.table_statistics(spark, name, columns).items()]
    return spark.createDataFrame(found, "table_name string, statistic string, n long")  # catalog metadata


@register("loan_score_incremental", with_ctes(_FINAL_SQL))
def _loan_score_incremental(spark, d):
    """The score kept up through three batches: the first scored whole, the
    others by re-scoring the members they touch."""
    keyed = stages(spark, d).keyed
    lot = F.col("id").cast("long") % 10
    batches = [keyed.where(lot < 8), keyed.where(lot == 8), keyed.where(lot == 9)]
    so_far = batches[0]
    stored = _written(spark, unpack(Stages(pack(so_far), raw_is_keyed=True).loan_score))
    for batch in batches[1:]:
        so_far = so_far.unionByName(batch)
        stored = _written(spark, incremental.rescore(so_far, batch, stored))
    return stored


def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.read.parquet(io.write_parquet(df, scratch_path(spark, "gold", "loan_score")))
