"""Cleaning rules F1–F21, A1, A2 and the composite cleaning jobs.

Every rule is a narrow transformation except the whole-row dedupe (A1, a
hash aggregate with map-side partial dedupe, so a hot duplicated row is
collapsed before the shuffle) and the mean used for imputation (A2), which
is a one-row global aggregate used as a scalar subquery: Spark computes it
once and inlines the value, so nothing crosses the driver and no join is
needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.functions import rules
from lendwise.functions.keys import is_packed, pack, unpack
from lendwise.params import DEFAULT_VARIANT, Variant

# Fixed values that must equal the reference's: business names of the customer
# columns, the fields a loan and a repayment must have, and the counters.
CUSTOMER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}
LOAN_REQUIRED = ("loan_amount", "funded_amount", "loan_term_months",
                 "interest_rate", "monthly_installment", "issue_date",
                 "loan_status", "loan_purpose")
REPAYMENT_REQUIRED = ("total_principal_received", "total_interest_received",
                      "total_late_fee_received", "total_payment_received",
                      "last_payment_amount")
RECORD_COUNTERS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")


def rename_strict(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename, failing on a missing source (a silent no-op caused D1)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(mapping)


def with_ingest_date(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Audit column (one value per query, so a later dedupe still works)."""
    return df.withColumn("ingest_date", ts if ts is not None else F.current_timestamp())


def dedupe_rows(df: DataFrame) -> DataFrame:
    """A1: whole-row distinct."""
    return df.dropDuplicates()


def require(df: DataFrame, cols) -> DataFrame:
    """drop rows with a null in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """drop rows whose every column is null."""
    return df.dropna(how="all")


def mean_floor(df: DataFrame, col: str) -> Column:
    """A2: floor of the global mean as a scalar subquery column (int)."""
    return df.agg(F.floor(F.avg(col)).cast("int")).scalar()


def impute_mean_floor(df: DataFrame, col: str) -> DataFrame:
    """nulls in ``col`` take the floor of the column's mean.

    On an empty or all-null input the mean is null and nulls stay null (the
    reference raised instead).
    """
    return df.withColumn(col, F.coalesce(F.col(col), mean_floor(df, col)))


def customers_clean(customers_raw: DataFrame, ingest: Column | None = None) -> DataFrame:
    """P6 -> P8 -> A1 -> F1 -> F5 -> F6 -> F7."""
    df = rename_strict(customers_raw, CUSTOMER_RENAMES)
    was_packed = is_packed(df)
    df = dedupe_rows(pack(df))  # same rows as deduping after the constant audit column
    df = df if was_packed else unpack(df)
    df = require(df, ["annual_income"])
    df = df.withColumn("emp_length", rules.digits_to_int("emp_length"))
    df = impute_mean_floor(df, "emp_length")
    df = df.withColumn("address_state", rules.state_or_na("address_state"))
    return with_ingest_date(df, ingest)


def loans_clean(loans_raw: DataFrame, variant: Variant = DEFAULT_VARIANT,
                ingest: Column | None = None) -> DataFrame:
    """F2 -> P8 -> F3 -> F8/P7 -> F9."""
    df = drop_all_null_rows(loans_raw)
    df = require(df, LOAN_REQUIRED)
    df = df.withColumn("loan_term_months",
                       rules.term_years("loan_term_months", variant.term_parse))
    df = df.withColumnRenamed("loan_term_months", "loan_term_years")
    df = df.withColumn("loan_purpose", rules.purpose_or_other("loan_purpose"))
    return with_ingest_date(df, ingest)


def repayments_clean(repayments_raw: DataFrame, variant: Variant = DEFAULT_VARIANT,
                     ingest: Column | None = None) -> DataFrame:
    """P8 -> F4 -> F10 (or F11 -> F12) -> F13."""
    df = require(repayments_raw, REPAYMENT_REQUIRED)
    parts = ("total_principal_received", "total_interest_received",
             "total_late_fee_received")
    if variant.total_payment == "recompute":
        df = df.withColumn("total_payment_received", rules.recomputed_total(*parts))
        df = df.filter(F.col("total_payment_received") != 0.0)
    else:
        df = df.withColumn("total_payment_received",
                           rules.repaired_total(*parts, "total_payment_received"))
    df = df.withColumns({
        "last_payment_date": rules.null_if_sentinel("last_payment_date"),
        "next_payment_date": rules.null_if_sentinel("next_payment_date"),
    })
    return with_ingest_date(df, ingest)


def defaulters_base(defaulters_raw: DataFrame) -> DataFrame:
    """delinquency counter to int with null -> 0."""
    return defaulters_raw.withColumn("delinq_2yrs", rules.int_or_zero("delinq_2yrs"))


def delinq_members(base: DataFrame, variant: Variant = DEFAULT_VARIANT) -> DataFrame:
    """members with recent delinquency, four columns.

    ``float`` (reference lib) filters on the float months, so 0.5 passes;
    ``int`` casts first, as the notebook does.
    """
    months = F.col("mths_since_last_delinq")
    if variant.delinq_filter_on == "int":
        df = base.withColumn("mths_since_last_delinq", rules.int_or_null(months))
        df = df.filter((F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0))
    else:
        df = base.filter((F.col("delinq_2yrs") > 0) | (months > 0))
        df = df.withColumn("mths_since_last_delinq", rules.int_or_null(months))
    return df.select("member_id", "delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")


def _any_record() -> Column:
    return (F.col("pub_rec") > 0.0) | (F.col("pub_rec_bankruptcies") > 0.0) | \
           (F.col("inq_last_6mths") > 0.0)


def record_members(base: DataFrame) -> DataFrame:
    """F16: member ids with any public record, bankruptcy or inquiry (not distinct)."""
    return base.filter(_any_record()).select("member_id")


def record_detail(base: DataFrame, variant: Variant = DEFAULT_VARIANT) -> DataFrame:
    """F17 (all members) or F18 (members with a positive counter)."""
    df = base.withColumns({c: rules.int_or_zero(c) for c in RECORD_COUNTERS})
    if variant.record_detail == "filtered":
        df = df.filter(_any_record())
    return df.select("member_id", *RECORD_COUNTERS)


def months_since_delinq_zero(base: DataFrame) -> DataFrame:
    """months since last delinquency to int with null -> 0."""
    return base.withColumn("mths_since_last_delinq",
                           rules.int_or_zero("mths_since_last_delinq"))
