"""lendwise — a Spark-native loan-scoring pipeline.

Raw wide loan rows are keyed by a hashed member id, split into customers,
loans, repayments and defaulter history, cleaned with declarative rules,
quarantined for ambiguous members and scored with configurable point bands.
Every step is a pure ``DataFrame -> DataFrame`` function built from native
Spark expressions, so Catalyst prunes, pushes down and code-generates it.
"""

from lendwise.params import ScoreParams, Variant

__all__ = ["ScoreParams", "Variant"]
