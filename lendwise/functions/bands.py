"""Point bands: ordered (predicate, points) arms, first match wins.

A band spec is data; ``compile_bands`` turns it into one native ``CASE WHEN``
so every rule stays inside whole-stage codegen.  With ``otherwise=None`` an
unmatched row gets null, which is reference behaviour for several rules.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendwise.params import DEFAULT_PARAMS, SUB_GRADE_STEPS, ScoreParams

_NO_ELSE = object()


@dataclass(frozen=True)
class Arm:
    predicate: Column
    points: object


def compile_bands(arms: Sequence[Arm], otherwise=_NO_ELSE) -> Column:
    out = None
    for arm in arms:
        value = arm.points if isinstance(arm.points, Column) else F.lit(arm.points)
        out = F.when(arm.predicate, value) if out is None else out.when(arm.predicate, value)
    if otherwise is not _NO_ELSE:
        out = out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return out


def _memo(fn):
    """Reuse a compiled rule when called with column names and params.

    Columns are immutable unresolved expressions, so one compiled CASE chain
    can serve every DataFrame; this keeps plan construction off the py4j
    round trips of rebuilding 30-arm chains per query.
    """
    cached = functools.lru_cache(maxsize=256)(fn)

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        try:
            return cached(*args, **kwargs)
        except TypeError:  # a Column argument: not hashable, build fresh
            return fn(*args, **kwargs)
    return wrapper


def _c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def count_bands(c: Column, p: ScoreParams, worst: int) -> list[Arm]:
    """Shared shape of G3–G6: 0 / 1-2 / 3-5 / above 5 or null."""
    return [Arm(c == 0, p.excellent_rated_pts),
            Arm(c.between(1, 2), p.bad_rated_pts),
            Arm(c.between(3, 5), p.very_bad_rated_pts),
            Arm((c > 5) | c.isNull(), worst)]


@_memo
def last_payment_pts(last_amount="last_payment_amount", installment="monthly_installment",
                     p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """G1: last payment against the monthly installment."""
    a, i = _c(last_amount), _c(installment)
    # One end per band: the other is the arm before it.
    return compile_bands([
        Arm(a < i * 0.5, p.below_half_installment),
        Arm(a < i, p.very_bad_rated_pts),
        Arm(a == i, p.good_rated_pts),
        Arm(a <= i * 1.5, p.very_good_rated_pts),
        Arm(a > i * 1.5, p.excellent_rated_pts),
    ], otherwise=p.unacceptable_rated_pts)


@_memo
def total_payment_pts(total="total_payment_received", funded="funded_amount",
                      p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Total received against half the funded amount (no else arm)."""
    t, f = _c(total), _c(funded)
    return compile_bands([
        Arm(t >= f * 0.5, p.very_good_rated_pts),
        Arm((t < f * 0.5) & (t > 0), p.good_rated_pts),
        Arm((t == 0) | t.isNull(), p.unacceptable_rated_pts),
    ])


@_memo
def delinq_pts(c="delinq_2yrs", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """G3 (worst band uses ``ScoreParams.worst_delinq``, 750 by default: D8)."""
    return compile_bands(count_bands(_c(c), p, p.worst_delinq))


@_memo
def public_records_pts(c="pub_rec", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """G4."""
    return compile_bands(count_bands(_c(c), p, p.very_bad_rated_pts))


@_memo
def bankruptcies_pts(c="pub_rec_bankruptcies", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """G5."""
    return compile_bands(count_bands(_c(c), p, p.very_bad_rated_pts))


@_memo
def inquiries_pts(c="inq_last_6mths", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """G6."""
    return compile_bands(count_bands(_c(c), p, p.unacceptable_rated_pts))


@_memo
def loan_status_pts(c="loan_status", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Lower-cased status contains a phrase."""
    s = F.lower(_c(c))
    return compile_bands([
        Arm(s.contains("fully paid"), p.excellent_rated_pts),
        Arm(s.contains("current"), p.good_rated_pts),
        Arm(s.contains("in grace period"), p.bad_rated_pts),
        Arm(s.contains("late (16-30 days)") | s.contains("late (31-120 days)"), p.very_bad_rated_pts),
        Arm(s.contains("charged off"), p.unacceptable_rated_pts),
    ], otherwise=p.unacceptable_rated_pts)


@_memo
def home_pts(c="home_ownership", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Lower-cased ownership ends with a word; OTHER/NONE match nothing."""
    s = F.lower(_c(c))
    return compile_bands([
        Arm(s.endswith("own"), p.excellent_rated_pts),
        Arm(s.endswith("rent"), p.good_rated_pts),
        Arm(s.endswith("mortgage"), p.bad_rated_pts),
        Arm(s.endswith("any") | s.isNull(), p.very_bad_rated_pts),
    ])


# Credit-limit usage thresholds (share of the limit) with the
# points for usage at or below each, highest points first.
CREDIT_LIMIT_SHARES = (0.10, 0.20, 0.30, 0.50, 0.70)


@_memo
def credit_limit_pts(funded="funded_amount", limit="total_high_credit_limit",
                     p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Funded amount as a share of the total high credit limit.

    The reference tests both ends of each band; with first-match-wins the
    lower end is implied by the failed arm before it, so one comparison per
    arm gives the same result, nulls included.
    """
    f, h = _c(funded), _c(limit)
    points = (p.excellent_rated_pts, p.very_good_rated_pts, p.good_rated_pts,
              p.bad_rated_pts, p.very_bad_rated_pts)
    arms = [Arm(f <= h * share, pts) for share, pts in zip(CREDIT_LIMIT_SHARES, points)]
    arms.append(Arm(f > h * CREDIT_LIMIT_SHARES[-1], p.unacceptable_rated_pts))
    return compile_bands(arms, otherwise=p.unacceptable_rated_pts)


@_memo
def grade_pts(grade="grade", sub_grade="sub_grade", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Base points of the grade scaled by the sub-grade step.

    Generated from the rule (five grades x five steps); grade and sub-grade
    must agree, F and G score the unacceptable value, anything else is null.
    Result is decimal(…,2), as in the reference's ``int * 0.95`` arithmetic.
    """
    g, s = _c(grade), _c(sub_grade)
    arms = []
    for letter, base in p.grade_base().items():
        for level, step in enumerate(SUB_GRADE_STEPS, start=1):
            value = (Decimal(base) * step).quantize(Decimal("0.01"))
            arms.append(Arm((g == letter) & (s == f"{letter}{level}"),
                            F.lit(value).cast("decimal(12,2)")))
    arms.append(Arm(g.isin("F", "G"),
                    F.lit(Decimal(p.unacceptable_rated_pts)).cast("decimal(12,2)")))
    return compile_bands(arms)


@_memo
def loan_grade(score="loan_score", p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Letter grade from the score; null score -> null grade."""
    x = _c(score)
    floors = (p.very_good_grade_pts, p.good_grade_pts, p.bad_grade_pts, p.very_bad_grade_pts, p.unacceptable_grade_pts)
    arms = [Arm(x > floor, letter) for letter, floor in zip("ABCDE", floors)]
    return compile_bands([*arms, Arm(x.isNotNull(), "F")])
