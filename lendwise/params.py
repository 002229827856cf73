"""Scoring constants (G19) and pipeline variants.

Constants are plain Python values turned into literal columns, so an unset
name fails at import time instead of producing broken SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


# Fixed values that must equal the reference's results.
# Points per rating: unacceptable 0, very_bad 100, bad 250, good 500,
# very_good 650, excellent 800.
# Grade cut-offs: unacceptable 750, very_bad 1000, bad 1500, good 2000,
# very_good 2500.
# Component weights: payment history 0.20, default history 0.45,
# financial health 0.35.
# Loan purposes kept as is (anything else becomes "other"):
# debt_consolidation, credit_card, home_improvement, other, major_purchase,
# medical, small_business, car, vacation, moving, house, wedding,
# renewable_energy, educational.
LOAN_PURPOSES = (
    "debt_consolidation", "credit_card", "home_improvement", "other",
    "major_purchase", "medical", "small_business", "car", "vacation",
    "moving", "house", "wedding", "renewable_energy", "educational",
)
# Sub-grade steps 1..5 scale a grade's base points by 1, .95, .90, .85, .80.
SUB_GRADE_STEPS = (Decimal("1"), Decimal("0.95"), Decimal("0.90"),
                   Decimal("0.85"), Decimal("0.80"))
# Sentinel that marks a missing payment date in the raw file.
DATE_SENTINEL = "0.0"
# Country written for every customer by the raw split.
CUSTOMER_COUNTRY = "USA"


@dataclass(frozen=True)
class ScoreParams:
    unacceptable_rated_pts: int = 0
    very_bad_rated_pts: int = 100
    bad_rated_pts: int = 250
    good_rated_pts: int = 500
    very_good_rated_pts: int = 650
    excellent_rated_pts: int = 800
    unacceptable_grade_pts: int = 750
    very_bad_grade_pts: int = 1000
    bad_grade_pts: int = 1500
    good_grade_pts: int = 2000
    very_good_grade_pts: int = 2500
    payment_weight: Decimal = Decimal("0.20")
    default_weight: Decimal = Decimal("0.45")
    health_weight: Decimal = Decimal("0.35")
    # Both reference copies give the worst delinquency band the 750
    # grade cut-off instead of a point value; kept, but overridable.
    worst_delinq_pts: int | None = None
    # The two lowest last-payment bands give the same points.
    below_half_installment_pts: int | None = None

    @property
    def worst_delinq(self) -> int:
        return (self.unacceptable_grade_pts if self.worst_delinq_pts is None
                else self.worst_delinq_pts)

    @property
    def below_half_installment(self) -> int:
        return (self.very_bad_rated_pts if self.below_half_installment_pts is None
                else self.below_half_installment_pts)

    def grade_base(self) -> dict[str, int]:
        """Base points per credit grade; F and G score the unacceptable value."""
        return {"A": self.excellent_rated_pts, "B": self.very_good_rated_pts,
                "C": self.good_rated_pts, "D": self.bad_rated_pts,
                "E": self.very_bad_rated_pts}


@dataclass(frozen=True)
class Variant:
    """Switches between the two reference implementations."""

    # V1: "repair" fills a zero total from its parts; "recompute" always sums
    # the parts and drops zero totals.
    total_payment: str = "repair"
    # V2: "all" keeps every member's record detail, "filtered" only members
    # with a positive counter.
    record_detail: str = "all"
    # V3: delinquency filter on the float months ("float") or after the int
    # cast ("int").
    delinq_filter_on: str = "float"
    # V4: bad members from duplicated customers only ("customers") or the
    # distinct union of all three duplicate lists ("all").
    bad_scope: str = "customers"
    # V5: quarantine every table by the one bad list ("shared") or each table
    # by its own duplicate list ("per_table").
    quarantine_lists: str = "shared"
    # V6: payment history keeps members IN customers_new ("known") or NOT IN
    # the bad list ("not_bad").
    payment_membership: str = "known"
    # V7: weighted components ("weighted") or raw sums ("raw").
    components: str = "weighted"
    # V8: term text -> digits by stripping " months" ("suffix") or every
    # non-digit ("digits").
    term_parse: str = "digits"
    # Also quarantine the key of rows whose nine identity attributes are all
    # null (they all hash the empty text, so that key gathers unrelated
    # customers and is the natural hot key).
    quarantine_empty_key: bool = False

    @classmethod
    def notebook(cls) -> "Variant":
        return cls(total_payment="recompute", record_detail="filtered",
                   delinq_filter_on="int", bad_scope="all",
                   quarantine_lists="per_table", payment_membership="not_bad",
                   components="raw")


DEFAULT_PARAMS = ScoreParams()
DEFAULT_VARIANT = Variant()
