"""Consolidated views (J7, J8) without the product of a member's rows.

The plain view left-joins customers to loans, repayments, delinquency and
public records all by member, so a member with *c* customer rows, *l* loans,
*d* delinquency and *r* record rows yields ``c * l * d * r`` rows.  Here every
source row of a member in ``customers`` stands once, under the same columns,
and ``part`` tells which it is:

* ``loan``: a loan with its repayment, and the customer's columns where the
  member has one customer row;
* ``customer``: a customer row that no loan row carries (the member has
  several, or no loan);
* ``delinquency`` and ``record``: the distinct rows of the two default
  tables, ``n_rows`` times each.

``n_customers``, ``n_loans``, ``n_delinq_rows`` and ``n_record_rows`` count
the member's rows, so the plain view's rows and their multiplicities follow,
and the ``worst_`` columns hold the member's worst values of the default
tables on every row, those of loans included.

The four parts are united under their tag, and one aggregate over the same
tags gives everything per member: the counts, the worst values, and the
columns of an only customer row.  One join puts the two together; its right
side is unique per member, so a hot member can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.functions.keys import is_packed, pack, packed_sql, unpack, unpacked_sql

KEY = "member_id"

# The columns of the view, in its order.
CUSTOMER_COLS = ("emp_title", "emp_length", "home_ownership", "annual_income", "address_state",
                 "address_zipcode", "address_country", "grade", "sub_grade", "verification_status",
                 "total_high_credit_limit", "application_type", "join_annual_income",
                 "verification_status_joint")
LOAN_COLS = ("loan_amount", "funded_amount", "loan_term_years", "interest_rate",
             "monthly_installment", "issue_date", "loan_status", "loan_purpose")
REPAYMENT_COLS = ("total_principal_received", "total_interest_received",
                  "total_late_fee_received", "last_payment_date", "next_payment_date")
DELINQ_COLS = ("delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")
RECORD_COLS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
VIEW_COLS = ("loan_id", KEY, *CUSTOMER_COLS, *LOAN_COLS, *REPAYMENT_COLS, *DELINQ_COLS, *RECORD_COLS)
COUNT_COLS = ("n_rows", "n_customers", "n_loans", "n_delinq_rows", "n_record_rows")
WORST_OF = {"delinquency": ("delinq_2yrs",), "record": RECORD_COLS}
WORST_COLS = tuple(f"worst_{c}" for columns in WORST_OF.values() for c in columns)
SLIM_COLS = (KEY, "address_state", "total_payment_received", "delinq_2yrs")
_REPAID = (*REPAYMENT_COLS, "total_payment_received")


def _members(customers: DataFrame, loans: DataFrame, delinq: DataFrame, records: DataFrame,
             customer_cols: list[str]) -> DataFrame:
    """One row per member of ``customers``: its counts and worst values, and
    ``own_`` columns, the customer's where the member has one customer row."""
    sources = {"customer": customers.select(KEY, *customer_cols), "loan": loans.select(KEY),
               "delinquency": delinq.select(KEY, *WORST_OF["delinquency"]), "record": records.select(KEY, *WORST_OF["record"])}
    tagged = _united({part: df.withColumn("part", F.lit(part)) for part, df in sources.items()})

    def of(part: str) -> Column:
        return F.col("part") == part

    counts = [F.count_if(of(part)).alias(name) for part, name in zip(sources, COUNT_COLS[1:])]
    worst = [F.max(c).alias(f"worst_{c}") for columns in WORST_OF.values() for c in columns]
    own = [F.first(F.when(of("customer"), F.col(c)), ignorenulls=True).alias(f"own_{c}") for c in customer_cols]
    return tagged.groupBy(KEY).agg(*counts, *worst, *own).where("n_customers > 0")


def _united(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())


def _view(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinq: DataFrame, records: DataFrame,
          columns: tuple[str, ...], worst: tuple[str, ...], with_records: bool = True) -> DataFrame:
    customer_cols = [c for c in CUSTOMER_COLS if c in columns]
    was_packed = is_packed(customers)
    customers, loans, delinq, records = map(pack, (customers, loans, delinq, records))
    members = _members(customers, loans, delinq, records, customer_cols)

    def distinct_rows(df: DataFrame, kept: tuple[str, ...]) -> DataFrame:
        return df.groupBy(KEY, *kept).agg(F.count(F.lit(1)).alias("n_rows"))

    one = F.lit(1).cast("long").alias("n_rows")
    loan = loans.select("loan_id", KEY, *LOAN_COLS).join(repayments.select("loan_id", *_REPAID), "loan_id", "left")
    parts = {"loan": loan.select("*", one), "customer": customers.select(KEY, *customer_cols, one),
             "delinquency": distinct_rows(delinq, tuple(c for c in DELINQ_COLS if c in columns))}
    if with_records:
        parts["record"] = distinct_rows(records, RECORD_COLS)
    rows = _united({part: df.withColumn("part", F.lit(part)) for part, df in parts.items()})
    # A customer row that a loan row carries does not stand by itself.
    rows = rows.join(members, KEY).where("part != 'customer' or n_customers > 1 or n_loans = 0")
    carried = (F.col("part") == "loan") & (F.col("n_customers") == 1)
    shown = [F.when(carried, F.col(f"own_{c}")).otherwise(F.col(c)).alias(c) if c in customer_cols else F.col(c) for c in columns]
    view = rows.select("part", *shown, *COUNT_COLS, *worst)
    return view if was_packed else unpack(view)


def consolidated_view(customers: DataFrame, loans: DataFrame, repayments: DataFrame,
                      delinq: DataFrame, records: DataFrame) -> DataFrame:
    """``part``, the 35 columns, the counts and the worst values."""
    return _view(customers, loans, repayments, delinq, records, VIEW_COLS, WORST_COLS)


def consolidated_view_slim(customers: DataFrame, loans: DataFrame, repayments: DataFrame,
                           delinq: DataFrame, records: DataFrame) -> DataFrame:
    """Member, state, total payment and delinquency count, and the worst
    count; public records have none of these columns, so their rows are left
    to their count."""
    return _view(customers, loans, repayments, delinq, records, SLIM_COLS, WORST_COLS[:1], with_records=False)


def consolidated_view_sql(customers: str, loans: str, repayments: str, delinq: str,
                          records: str, slim: bool = False) -> str:
    """The view as SQL text over catalog tables (for ``CREATE VIEW``)."""
    columns, worst = (SLIM_COLS, WORST_COLS[:1]) if slim else (VIEW_COLS, WORST_COLS)
    customer_cols = [c for c in CUSTOMER_COLS if c in columns]
    late = [c for c in DELINQ_COLS if c in columns]

    def select(part: str, has: list[str], wanted: list[str], source: str, key: str = packed_sql(KEY)) -> str:
        shown = ", ".join(c if c in has else f"NULL AS {c}" for c in wanted)
        return f"SELECT '{part}' AS part, {key} AS {KEY}, {shown} FROM {source}"

    told = [*customer_cols, *WORST_OF["delinquency"], *WORST_OF["record"]]
    tagged = " UNION ALL ".join([
        select("customer", customer_cols, told, customers), select("loan", [], told, loans),
        select("delinquency", list(WORST_OF["delinquency"]), told, delinq), select("record", list(WORST_OF["record"]), told, records)])
    counts = ", ".join(f"count_if(part = '{part}') AS {name}" for part, name in zip(
        ("customer", "loan", "delinquency", "record"), COUNT_COLS[1:]))
    worst_of = ", ".join(f"max({c.removeprefix('worst_')}) AS {c}" for c in worst)
    own = ", ".join(f"first(CASE WHEN part = 'customer' THEN {c} END, true) AS own_{c}" for c in customer_cols)

    def grouped(table: str, names: list[str]) -> str:
        listed = ", ".join((KEY, *names))
        source = f"(SELECT {packed_sql(KEY)} AS {KEY}, {', '.join(names)} FROM {table})"
        return f"(SELECT {listed}, count(*) AS n_rows FROM {source} GROUP BY {listed})"

    wanted = [*(c for c in columns if c != KEY), "n_rows"]
    own_loan = ["loan_id", *LOAN_COLS, *_REPAID, "n_rows"]
    packed_loans = f"(SELECT loan_id, {packed_sql(KEY)} AS {KEY}, {', '.join(LOAN_COLS)} FROM {loans})"
    loan_rows = (f"(SELECT l.*, {', '.join(_REPAID)}, 1L AS n_rows FROM {packed_loans} l "
                 f"LEFT JOIN (SELECT loan_id AS id, {', '.join(_REPAID)} FROM {repayments}) p ON p.id = l.loan_id)")
    rows = [select("loan", own_loan, wanted, loan_rows, KEY),
            select("customer", [*customer_cols, "n_rows"], wanted, f"(SELECT *, 1L AS n_rows FROM {customers})"),
            select("delinquency", [*late, "n_rows"], wanted, grouped(delinq, late), KEY)]
    if not slim:
        rows.append(select("record", [*RECORD_COLS, "n_rows"], wanted, grouped(records, list(RECORD_COLS)), KEY))
    named = {KEY: f"{unpacked_sql(KEY)} AS {KEY}"}
    shown = ", ".join(f"CASE WHEN part = 'loan' AND n_customers = 1 THEN own_{c} ELSE {c} END AS {c}" if c in customer_cols else named.get(c, c)
                      for c in columns)
    return (f"WITH members AS (SELECT {KEY}, {counts}, {worst_of}, {own} FROM ({tagged}) GROUP BY {KEY} HAVING count_if(part = 'customer') > 0), "
            f"united AS ({' UNION ALL '.join(rows)}) "
            f"SELECT part, {shown}, {', '.join((*COUNT_COLS, *worst))} FROM united JOIN members USING ({KEY}) "
            "WHERE part <> 'customer' OR n_customers > 1 OR n_loans = 0")
