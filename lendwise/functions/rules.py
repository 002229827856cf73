"""Cleaning expressions, each a native Column.

Spark 4 runs with ANSI mode on, where a plain cast of ``''`` to int raises;
the reference relied on the lenient cast, so text-to-number steps use
``try_cast`` instead of turning ANSI off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendwise.params import DATE_SENTINEL, LOAN_PURPOSES


def digits_to_int(c: Column | str) -> Column:
    """keep digits only, then int; empty text becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"\D", "").try_cast("int")


def term_years(c: Column | str, parse: str = "digits") -> Column:
    """F8: ``' 36 months'`` -> 3; months divided by 12, truncated."""
    c = F.col(c) if isinstance(c, str) else c
    if parse == "suffix":
        months = F.regexp_replace(c, " months", "").try_cast("int")
    else:
        months = digits_to_int(c)
    return (months / F.lit(12)).cast("int")


def state_or_na(c: Column | str) -> Column:
    """a state longer than two characters becomes ``NA``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > 2, F.lit("NA")).otherwise(c)


def purpose_or_other(c: Column | str, allowed=LOAN_PURPOSES) -> Column:
    """values outside the enum (and null) become ``other``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit("other"))


def null_if_sentinel(c: Column | str, sentinel: str = DATE_SENTINEL) -> Column:
    """the text sentinel becomes null (compared as text, ANSI-safe)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == F.lit(sentinel), F.lit(None).cast("string")).otherwise(c)


def int_or_zero(c: Column | str) -> Column:
    """float counter -> int (truncating), null and NaN -> 0."""
    return F.coalesce(int_or_null(c), F.lit(0))


def int_or_null(c: Column | str) -> Column:
    """Float -> int, truncating, as the lenient cast does: what an int cannot
    hold becomes its largest or least value (an infinite count rates worst,
    not best); NaN is no number and becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(F.isnan(c), F.lit(None).cast("int"))
            .when(c >= F.lit(2.0 ** 31), F.lit(2 ** 31 - 1))
            .when(c <= F.lit(-2.0 ** 31), F.lit(-2 ** 31))
            .otherwise(c.try_cast("int")))


def repaired_total(principal: str, interest: str, fee: str, total: str) -> Column:
    """a zero total with non-zero principal is rebuilt from its parts."""
    p, i, f, t = (F.col(x) for x in (principal, interest, fee, total))
    return F.when((p != 0.0) & (t == 0.0), p + i + f).otherwise(t)


def recomputed_total(principal: str, interest: str, fee: str) -> Column:
    """the total is always the sum of its parts."""
    return F.col(principal) + F.col(interest) + F.col(fee)
