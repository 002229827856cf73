"""Audits (F19, F20, A6, A8): the notebooks' eyeball checks as data.

Each audit is one global aggregate pass per table (partial aggregation per
task, one final row), unpivoted to ``(check, n)`` rows so several tables can
be reported together with a union instead of a join.  ``Observed`` takes the
same numbers from the jobs that write the tables anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lendwise.params import DATE_SENTINEL


def _long(df: DataFrame, checks: dict[str, Column], name: str = "check",
          value: str = "n") -> DataFrame:
    wide = df.agg(*[c.cast("long").alias(k) for k, c in checks.items()])
    return wide.unpivot([], list(checks), name, value)


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def null_checks(named: dict[str, str] | None = None) -> dict[str, dict[str, Column]]:
    """F19's checks by table; ``named`` gives the names that columns go by
    where they are not the declared ones."""
    def col(name: str) -> Column:
        return F.col((named or {}).get(name, name))

    def repayments(stage: str) -> dict[str, Column]:
        return {f"principal_null_{stage}": count_if(col("total_principal_received").isNull()),
                f"last_date_sentinel_{stage}": count_if(col("last_payment_date") == F.lit(DATE_SENTINEL)),
                f"next_date_sentinel_{stage}": count_if(col("next_payment_date") == F.lit(DATE_SENTINEL))}

    return {"customers_raw": {"emp_length_null_raw": count_if(col("emp_length").isNull())},
            "customers_clean": {"emp_length_null_clean": count_if(col("emp_length").isNull())},
            "repayments_raw": repayments("raw"), "repayments_clean": repayments("clean"),
            "defaulters": {"delinq_zero_rows": count_if(col("delinq_2yrs") == 0)}}


class Observed:
    """F19/F20 read off the passes that write: checks ride along with the
    rows of a table as observed metrics, no job of their own."""

    def __init__(self) -> None:
        self._observations: list[Observation] = []

    def watch(self, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        """``df``; the job that runs it also takes ``checks``.  It has to run
        whole and once: a limit above it would cut the counts."""
        observation = Observation()
        self._observations.append(observation)
        return df.observe(observation, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in checks.items()])

    def counts(self) -> dict[str, int]:
        """All numbers; waits for jobs that have not ended."""
        return {name: n for o in self._observations for name, n in o.get.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(check, n), one row a check."""
        return spark.createDataFrame(sorted(self.counts().items()), "check string, n long")


def row_check(stage: str) -> dict[str, Column]:
    """F20 of one table."""
    return {f"rows_{stage}": F.count(F.lit(1))}


def null_counts(customers_raw: DataFrame, customers: DataFrame,
                repayments_raw: DataFrame, repayments: DataFrame,
                defaulters_base: DataFrame) -> DataFrame:
    """nulls and sentinels before and after the cleaning rules."""
    tables = {"customers_raw": customers_raw, "customers_clean": customers, "repayments_raw": repayments_raw,
              "repayments_clean": repayments, "defaulters": defaulters_base}
    parts = [_long(df, null_checks()[name]) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """rows per named stage."""
    out = None
    for name, df in stages.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def value_counts(df: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """Non-null count per value, largest first."""
    return df.groupBy(col).agg(F.count(col).alias(alias)).orderBy(F.desc(alias))


def distinct_count(df: DataFrame, col: str, alias: str) -> DataFrame:
    """Exact distinct count of one column (a two-phase aggregate)."""
    return df.agg(F.count_distinct(col).alias(alias))
