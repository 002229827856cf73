"""Rows that cannot be among a set of ids, told without a shuffle.

A set of ids of any size is reduced to words of 64 bits: an id's hash names a
word and three bits in it, which the id sets.  The words are bounded
(``WORDS``), so every task can hold them, and a row whose bits are not all set
has none of the ids.  A row whose bits are set may have one (ids share bits),
so an exact join on those rows follows.  Only they are shuffled, whole rows as
well as ids; the more ids there are for ``WORDS``, the more other rows go with
them (1 in 100 at five ids a word), which costs shuffle but no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, StringType

from lendwise.functions.keys import is_packed, pack, unpack

KEY = "member_id"
# Words of 64 bits, a power of two: at most so many rows (slot, bits), 16 MB.
WORDS = 1 << 20

_SLOT, _BITS = "_slot", "_bits"


def _slot(key: str) -> str:
    return f"xxhash64({key}) & {WORDS - 1}L"


def _bits(key: str) -> str:
    """Three bits, named by parts of the hash that name no slot."""
    return " | ".join(f"shiftleft(1L, CAST(shiftright(xxhash64({key}), {at}) & 63 AS INT))" for at in (32, 40, 48))


def marks(ids: DataFrame, key: str) -> DataFrame:
    """(slot, bits) of the ids; at most ``WORDS`` rows."""
    return (ids.where(F.col(key).isNotNull()).groupBy(F.expr(_slot(key)).alias(_SLOT))
              .agg(F.expr(f"bit_or({_bits(key)})").alias(_BITS)))


def split_by_marks(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have one of ``ids``, and rows that have none
    (those without an id among them).  Where equal ids need not have equal
    hashes, as keys of two types, any row may."""
    mine, theirs = df.schema[key].dataType, ids.schema[key].dataType
    if mine != theirs or not isinstance(mine, (StringType, BinaryType, IntegralType)):
        return df, df.where("false")
    at = df.withColumn(_SLOT, F.expr(_slot(key))).join(F.broadcast(marks(ids, key)), _SLOT, "left")
    maybe = F.expr(f"{key} IS NOT NULL AND coalesce({_BITS} & ({_bits(key)}) = ({_bits(key)}), false)")
    return at.where(maybe).select(*df.columns), at.where(~maybe).select(*df.columns)


def keep_marked(df: DataFrame, ids: DataFrame, key: str, member: str = KEY) -> DataFrame:
    """``df`` with an id among ``ids`` (a left semi join); rows that cannot
    match are not shuffled, and member ids are shuffled as bytes."""
    maybe, _ = split_by_marks(df, ids, key)
    if member not in df.columns:
        return maybe.join(ids.select(key), key, "left_semi").select(*df.columns)
    ids = pack(ids.select(key), key) if key == member else ids.select(key)
    kept = pack(maybe, member).join(ids, key, "left_semi").select(*df.columns)
    return kept if is_packed(df, member) else unpack(kept, member)


def drop_marked(df: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` without the ids among ``ids`` (a left anti join on member ids);
    rows that cannot match are not shuffled."""
    maybe, never = split_by_marks(df, ids, key)
    kept = pack(maybe, key).join(pack(ids.select(key), key), key, "left_anti").select(*df.columns)
    return never.unionByName(kept if is_packed(df, key) else unpack(kept, key))
