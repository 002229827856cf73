"""Split the keyed raw relation into four narrow relations.

The column lists are fixed values: names and order of the four split files.
Each split is a projection; Catalyst prunes the raw scan to the columns it
needs.  ``conform`` then binds a split to its declared schema the way a
positional CSV read with a DDL schema would (names by position, types by
cast), so the cleaning jobs see the reference's types without a CSV round
trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwise import schemas
from lendwise.functions.keys import is_packed
from lendwise.params import CUSTOMER_COUNTRY


def split_customers(keyed: DataFrame) -> DataFrame:
    """15 customer columns with the constant country."""
    return keyed.select(
        F.col("member_id"), "emp_title", "emp_length", "home_ownership",
        "annual_inc", "addr_state", "zip_code",
        F.lit(CUSTOMER_COUNTRY).alias("country"), "grade", "sub_grade",
        "verification_status", "tot_hi_cred_lim", "application_type",
        "annual_inc_joint", "verification_status_joint")


def split_loans(keyed: DataFrame) -> DataFrame:
    """11 loan columns, ``id`` renamed to ``loan_id``."""
    return keyed.select(
        F.col("id").alias("loan_id"), "member_id", "loan_amnt", "funded_amnt",
        "term", "int_rate", "installment", "issue_d", "loan_status",
        "purpose", "title")


def split_repayments(keyed: DataFrame) -> DataFrame:
    """8 repayment columns."""
    return keyed.select(
        F.col("id").alias("loan_id"), "total_rec_prncp", "total_rec_int",
        "total_rec_late_fee", "total_pymnt", "last_pymnt_amnt",
        "last_pymnt_d", "next_pymnt_d")


def split_defaulters(keyed: DataFrame) -> DataFrame:
    """P5: 9 defaulter columns keyed by member only (the loan id is dropped)."""
    return keyed.select(
        "member_id", "delinq_2yrs", "delinq_amnt", "pub_rec",
        "pub_rec_bankruptcies", "inq_last_6mths", "total_rec_late_fee",
        "mths_since_last_delinq", "mths_since_last_record")


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Bind columns by position to a DDL column list (rename + cast); packed
    member ids stay bytes."""
    fields = [f.strip().split() for f in ddl.split(",")]
    if len(fields) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns cannot bind to {len(fields)} declared")
    packed = "member_id" in df.columns and is_packed(df)
    return df.select(*[F.col(src).cast("binary" if packed and src == "member_id" else typ).alias(name)
                       for src, (name, typ) in zip(df.columns, fields)])


def customers_raw(keyed: DataFrame) -> DataFrame:
    return conform(split_customers(keyed), schemas.CUSTOMERS_RAW)


def loans_raw(keyed: DataFrame) -> DataFrame:
    return conform(split_loans(keyed), schemas.LOANS_RAW)


def repayments_raw(keyed: DataFrame) -> DataFrame:
    return conform(split_repayments(keyed), schemas.REPAYMENTS_RAW)


def defaulters_raw(keyed: DataFrame) -> DataFrame:
    return conform(split_defaulters(keyed), schemas.DEFAULTERS_RAW)
