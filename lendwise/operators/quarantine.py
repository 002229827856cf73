"""Duplicate-member lists and quarantine.

Counting members is a hash aggregate with a map-side partial count, so a hot
member id contributes one row per map task to the shuffle.  The quarantine
is an equi ``left_anti`` join, which Spark runs as a shuffled sort-merge
join (AQE turns it into a broadcast only when the measured list is small,
and splits skewed partitions), instead of the null-aware anti join that
``NOT IN`` plans to, which must broadcast the whole list.  Customers need no
join at all: their own duplicates fall out of the aggregate that counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwise.functions.keys import EMPTY_MEMBER_KEY, is_packed, packed_sql
from lendwise.params import DEFAULT_VARIANT, Variant

KEY = "member_id"


def dup_members(df: DataFrame, key: str = KEY) -> DataFrame:
    """A3/A4/A5: ids that occur on more than one row."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
              .filter(F.col("total") > 1).select(key))


def single_row_members(df: DataFrame, key: str = KEY) -> DataFrame:
    """Ids that occur on exactly one row: the members left in a table after
    removing its own duplicate list (same aggregate as ``dup_members``, so
    Spark shares its shuffle)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
              .filter(F.col("total") == 1).select(key))


def single_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    """The whole rows of ids that occur on exactly one row, in one
    aggregate that carries the row along: one shuffle, no list and no join.

    Each column is taken by itself, so that those a query does not read are
    pruned; of a group of one they come from the same row.  A hot id becomes
    one row per map task.  Rows without an id go, as with NOT IN.
    """
    others = [c for c in df.columns if c != key]
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in others])
    return one.where("_n = 1").select(*df.columns)


def member_multiplicity(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows per member, most first; equal counts by member, so that the
    many members of one count spread over the range partitions of the sort."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), key)


def union_distinct(*lists: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct union of id lists."""
    out = lists[0].select(key)
    for other in lists[1:]:
        out = out.unionByName(other.select(key))
    return out.distinct()


def not_in(df: DataFrame, ids: DataFrame, key: str = KEY,
           list_may_hold_null: bool = False) -> DataFrame:
    """``key NOT IN (ids)`` as an equi anti join.

    NOT IN drops rows whose own key is null, and returns nothing at all when
    the list holds a null.  Member lists are SHA-256 keys, which are never
    null (``concat_ws`` never returns null), so the second rule only needs
    checking for arbitrary lists: ``list_may_hold_null=True`` adds an
    uncorrelated EXISTS that Spark evaluates once.
    """
    ids = ids.select(key)
    kept = df.where(F.col(key).isNotNull())
    if list_may_hold_null:
        kept = kept.where(~ids.where(F.col(key).isNull()).exists())
    return kept.join(ids.where(F.col(key).isNotNull()), on=key, how="left_anti")


def keep_known(df: DataFrame, known: DataFrame, key: str = KEY) -> DataFrame:
    """``key IN (known)`` as a left semi join."""
    return df.join(known.select(key), on=key, how="left_semi")


def _empty_key(df: DataFrame) -> Column:
    return F.expr(packed_sql(f"'{EMPTY_MEMBER_KEY}'")) if is_packed(df) else F.lit(EMPTY_MEMBER_KEY)


def bad_members(customers: DataFrame, delinq: DataFrame, records: DataFrame,
                variant: Variant = DEFAULT_VARIANT) -> DataFrame:
    """The list the score excludes: customer duplicates, or the union (V4);
    optionally also the all-null identity key."""
    if variant.bad_scope == "all":
        out = union_distinct(dup_members(customers), dup_members(delinq), dup_members(records))
    else:
        out = dup_members(customers)
    if variant.quarantine_empty_key:
        empty = customers.where(F.col(KEY) == _empty_key(customers)).select(KEY)
        out = union_distinct(out, empty)
    return out


def quarantine(customers: DataFrame, delinq: DataFrame, records: DataFrame,
               bad: DataFrame, variant: Variant = DEFAULT_VARIANT
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """customers_new, delinq_new, records_new.

    Customers always lose the ``bad`` list; where it is their own duplicate
    list, what stays is read off the aggregate that counts them.  ``shared``
    (reference lib) also removes it from both default tables; ``per_table``
    (notebook) removes each default table's own duplicate list instead.
    """
    if variant.bad_scope == "customers":
        customers_new = single_rows(customers)
        if variant.quarantine_empty_key:
            customers_new = customers_new.where(F.col(KEY) != _empty_key(customers))
    else:
        customers_new = not_in(customers, bad)
    if variant.quarantine_lists == "per_table":
        return (customers_new, not_in(delinq, dup_members(delinq)),
                not_in(records, dup_members(records)))
    return customers_new, not_in(delinq, bad), not_in(records, bad)
