"""Raw wide loan relation derived from the TPC-H-style test tables.

The reference consumes one wide CSV of accepted loans; no such file ships
with it.  This module maps the driver's tables onto that relation with a
deterministic rule per column, so every operator can be checked against an
independent SQL oracle (the same rules are written as SQL in
``lendwise.plans.oracle``).

Grain: one row per order (``j`` = o_orderkey, ``k`` = c_custkey).  Inputs are
orders ⋈ customer ⋈ nation, left-joined to a per-order lineitem aggregate.
At scale the lineitem aggregate is a partial+final hash aggregate keyed by
order, and the orders/lineitem join is a co-partitioned sort-merge join on
the same key; customer and nation joins are left to AQE (nation is tiny and
is broadcast by Spark's own size check).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md §2), in natural order.
EMP_LENGTHS = ("< 1 year", "1 year", "2 years", "3 years", "4 years",
               "5 years", "6 years", "7 years", "8 years", "9 years",
               "10+ years", "n/a", None)
HOME_OWNERSHIP = ("OWN", "RENT", "MORTGAGE", "ANY", None, "OTHER", "MORTGAGE")
GRADES = "ABCDEFG"
LOAN_STATUSES = ("Fully Paid", "Current", "In Grace Period",
                 "Late (16-30 days)", "Late (31-120 days)", "Charged Off",
                 "Default",
                 "Does not meet the credit policy. Status:Fully Paid")
PURPOSES = ("debt_consolidation", "credit_card", "home_improvement", "other",
            "major_purchase", "medical", "small_business", "car", "vacation",
            "moving", "house", "wedding", "renewable_energy", "educational",
            "yoga", None)
LAST_PAYMENT_FACTORS = (0.25, 0.75, 1.0, 1.25, 2.0, 0.0)
MONTH_FORMAT = "MMM-yyyy"


def _pick(index: Column, values) -> Column:
    """values[index] as a CASE expression (index is a non-negative int)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v)
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


def _idiv(c: Column, d: int) -> Column:
    return F.floor(c / F.lit(d)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str) -> Column:
    """Money with at most two decimals as exact integer cents."""
    return F.floor(F.col(c) * F.lit(100.0) + F.lit(0.5)).cast("long")


def lineitem_per_order(lineitem: DataFrame) -> DataFrame:
    """Principal, interest and last ship date per order.

    Sums are exact and independent of row order: integer cents summed as
    long, divided once at the end (the same double as a decimal(…,2) sum for
    inputs with at most two decimals, which all test tables have), without
    the wide-decimal arithmetic a ``decimal(18,2)`` sum falls back to.
    """
    return (lineitem
            .groupBy("l_orderkey")
            .agg((F.sum(_cents("l_extendedprice")) / F.lit(100.0)).alias("li_prncp"),
                 (F.sum(_cents("l_quantity")) / F.lit(100.0)).alias("li_int"),
                 F.max("l_shipdate").alias("li_last_ship")))


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw wide relation, one row per order (types as a CSV scan infers)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = lineitem_per_order(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_quantity", "l_shipdate"))

    # Orders meet the lineitem aggregate first: both sides are shuffled by
    # order key, once.  Customers and nations come after that, by broadcast
    # only where Spark's size check allows.
    # The one shuffle of orders is asked for, not left to the join: where the
    # aggregate is broadcast, the projection, the key and the write would
    # else run in as few tasks as orders has files.
    base = (orders.repartition("o_orderkey").join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .join(customer, F.col("o_custkey") == customer.c_custkey, "inner")
            .join(nation, F.col("c_nationkey") == nation.n_nationkey, "inner"))

    j = F.col("o_orderkey")
    k = F.col("c_custkey")
    grade = F.substring(F.lit(GRADES), (_idiv(k, 7) % 7 + 1).cast("int"), 1)
    annual_inc = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    joint = (k % 11) == 0
    installment = F.col("o_totalprice") / F.lit(36)
    has_lines = F.col("l_orderkey").isNotNull()
    zero_parts = has_lines & ((j % 50) == 0)
    prncp = F.when(zero_parts, F.lit(0.0)).otherwise(F.col("li_prncp"))
    intr = F.when(zero_parts, F.lit(0.0)).otherwise(F.col("li_int"))
    fee = F.when(zero_parts, F.lit(0.0)).when((j % 19) == 0, F.lit(15.0)).otherwise(F.lit(0.0))
    last_ship = F.date_format(F.col("li_last_ship"), MONTH_FORMAT)
    purpose = _pick(j % 16, PURPOSES)
    mths_delinq = F.when((j % 4) == 0, F.lit(None).cast("double")) \
                   .when((j % 90) == 0, F.lit(0.5)) \
                   .otherwise((j % 90).cast("double"))

    def counter(div: int) -> Column:
        v = _idiv(j, div) % 8
        return F.when(v == 7, F.lit(None).cast("double")).otherwise(v.cast("double"))

    return base.select(
        j.cast("string").alias("id"),
        F.concat_ws("/", "c_name", "o_orderstatus", "o_orderpriority").alias("emp_title"),
        _pick(k % 13, EMP_LENGTHS).cast("string").alias("emp_length"),
        _pick(k % 7, HOME_OWNERSHIP).cast("string").alias("home_ownership"),
        annual_inc.alias("annual_inc"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit("xx")).alias("zip_code"),
        F.when((k % 10) == 0, F.col("n_name"))
         .otherwise(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("addr_state"),
        grade.alias("grade"),
        F.when((k % 53) == 0, F.lit("Z9"))
         .otherwise(F.concat(grade, (_idiv(k, 49) % 5 + 1).cast("string"))).alias("sub_grade"),
        F.lit("Verified").alias("verification_status"),
        F.when((k % 23) == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(100000) * (1 + k % 20)
                     + F.when((k % 9) == 0, j % 2).otherwise(F.lit(0))).cast("double"))
         .alias("tot_hi_cred_lim"),
        F.when(joint, F.lit("Joint App")).otherwise(F.lit("Individual")).alias("application_type"),
        F.when(joint, annual_inc * 2).alias("annual_inc_joint"),
        F.when(joint, F.lit("Verified")).alias("verification_status_joint"),
        F.when((j % 211) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("loan_amnt"),
        F.col("o_totalprice").alias("funded_amnt"),
        F.when((j % 2) == 0, F.lit(" 36 months")).otherwise(F.lit(" 60 months")).alias("term"),
        (F.lit(5.0) + (j % 200).cast("double") / F.lit(10.0)).alias("int_rate"),
        installment.alias("installment"),
        F.date_format(F.col("o_orderdate"), MONTH_FORMAT).alias("issue_d"),
        _pick(j % 8, LOAN_STATUSES).alias("loan_status"),
        purpose.alias("purpose"),
        F.regexp_replace(purpose, "_", " ").alias("title"),
        prncp.alias("total_rec_prncp"),
        intr.alias("total_rec_int"),
        fee.alias("total_rec_late_fee"),
        F.when((j % 5) == 0, F.lit(0.0)).otherwise(prncp + intr + fee).alias("total_pymnt"),
        F.when((j % 37) == 0, F.lit(None).cast("double"))
         .otherwise(installment * _pick(j % 6, LAST_PAYMENT_FACTORS)).alias("last_pymnt_amnt"),
        F.when((j % 11) == 0, F.lit("0.0")).otherwise(last_ship).alias("last_pymnt_d"),
        F.when((j % 13) == 0, F.lit("0.0"))
         .when((j % 3) == 0, F.lit(None).cast("string"))
         .otherwise(last_ship).alias("next_pymnt_d"),
        F.when((j % 9) == 8, F.lit(None).cast("double"))
         .otherwise((j % 9).cast("double")).alias("delinq_2yrs"),
        ((j % 50) * 10).cast("double").alias("delinq_amnt"),
        counter(3).alias("pub_rec"),
        counter(5).alias("pub_rec_bankruptcies"),
        counter(7).alias("inq_last_6mths"),
        mths_delinq.alias("mths_since_last_delinq"),
        F.when((j % 2) == 0, F.lit(None).cast("double"))
         .otherwise((j % 120).cast("double")).alias("mths_since_last_record"),
    )
