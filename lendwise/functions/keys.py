"""The hashed member key."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# The nine attributes that identify a member, in hash order,
# and the separator they are joined with.
MEMBER_KEY_COLUMNS = ("emp_title", "emp_length", "home_ownership",
                      "annual_inc", "zip_code", "addr_state", "grade",
                      "sub_grade", "verification_status")
MEMBER_KEY_SEPARATOR = "||"
# The key every row without identity attributes gets (SHA-256 of "").
EMPTY_MEMBER_KEY = hashlib.sha256(b"").hexdigest()


def member_key(*cols: str) -> Column:
    """SHA-256 (lower-case hex) of the attributes joined by ``||``.

    ``concat_ws`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` collide
    and an all-null row hashes the empty string; numbers hash by their Spark
    text form.  Both are reference behaviour.
    """
    cols = cols or MEMBER_KEY_COLUMNS
    return F.sha2(F.concat_ws(MEMBER_KEY_SEPARATOR,
                              *[F.col(c).cast("string") for c in cols]), 256)


def with_member_key(raw: DataFrame, name: str = "member_id") -> DataFrame:
    """Append the member key to the raw wide relation (a narrow projection)."""
    return raw.withColumn(name, member_key())


# In shuffles a member id goes as bytes, half as long as its hex digits: 1 and
# the 32 bytes of a digest, or 0 and the text of any other id.
_DIGEST, _OTHER = "X'01'", "X'00'"


def packed_sql(key: str = "member_id") -> str:
    """The id as bytes; equal ids, and only they, have equal bytes."""
    return (f"CASE WHEN length({key}) = 64 AND lower(hex(unhex({key}))) = {key} THEN concat({_DIGEST}, unhex({key})) "
            f"WHEN {key} IS NOT NULL THEN concat({_OTHER}, CAST({key} AS BINARY)) END")


def unpacked_sql(key: str = "member_id") -> str:
    """The id as it was before ``packed_sql``."""
    return (f"CASE WHEN substring({key}, 1, 1) = {_DIGEST} THEN lower(hex(substring({key}, 2))) "
            f"ELSE CAST(substring({key}, 2) AS STRING) END")


def is_packed(df: DataFrame, key: str = "member_id") -> bool:
    return isinstance(df.schema[key].dataType, BinaryType)


def pack(df: DataFrame, key: str = "member_id") -> DataFrame:
    """``df`` with its member id as bytes.  Pack before a run of joins and
    aggregates and unpack after it, as each change of form costs a shuffle."""
    text = isinstance(df.schema[key].dataType, StringType)
    return df.withColumn(key, F.expr(packed_sql(key))) if text else df


def unpack(df: DataFrame, key: str = "member_id") -> DataFrame:
    """``df`` with its member id as text again."""
    return df.withColumn(key, F.expr(unpacked_sql(key))) if is_packed(df, key) else df
