"""Quarantine lists kept up to date by the raw stream.

Two streams over the same incoming files:

* the raw split (``ingest``) writes, besides its zones, per batch how many
  delinquency and record rows each member has;
* the customer stream removes repeated customer rows by a keyed state of row
  digests, so that a row which comes again in a later batch, or after a
  restart, is not counted twice, and writes the distinct rows and their
  counts per member.

Counts of batches add up: a member is on a list when its counts over all
batches come to more than one.  No list rereads the rows.  Every output is a
folder named by its batch and written in overwrite mode, so a replayed batch
replaces its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, FloatType

from lendwise.functions.keys import pack, unpack, with_member_key
from lendwise.operators import clean, quarantine, split
from lendwise.params import DEFAULT_VARIANT, Variant
from lendwise.session import scratch_path
from lendwise.sources import io
from lendwise.streaming import ingest

KEY = "member_id"
LISTS = ("customers", "delinq", "records")
DIGEST = "row_digest"


def with_row_digest(df: DataFrame, name: str = DIGEST) -> DataFrame:
    """SHA-256 (32 bytes) of a row's columns by name; rows that are equal to
    ``distinct`` have equal digests (nulls are left out, -0.0 counts as 0.0)."""
    cells = [(F.col(f.name) + F.lit(0.0)).cast(f.dataType).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
             for f in df.schema]
    return df.withColumn(name, F.unhex(F.sha2(F.to_json(F.struct(*cells)), 256)))


def member_counts(df: DataFrame) -> DataFrame:
    """(member_id, n): mergeable, by adding up."""
    return unpack(pack(df.select(KEY)).groupBy(KEY).agg(F.count(F.lit(1)).alias("n")))


def write_default_counts(keyed: DataFrame, out_root: str, batch_id: int, variant: Variant = DEFAULT_VARIANT) -> None:
    """The delinquency and record counts of one batch of keyed raw rows."""
    base = clean.defaulters_base(split.defaulters_raw(keyed))
    for name, df in (("delinq", clean.delinq_members(base, variant)), ("records", clean.record_detail(base, variant))):
        io.write_parquet(member_counts(df), f"{out_root}/counts/{name}/batch_id={batch_id}")


def start_customer_stream(spark: SparkSession, source_dir: str, out_root: str, checkpoint: str | None = None,
                          max_files_per_trigger: int = 1000) -> StreamingQuery:
    """A1 and F1 across batches: distinct customer rows with an income, to
    ``customers_distinct``, and their counts per member; drains what is there
    and stops.

    The state holds one digest a distinct row, partitioned by it, so no key
    of it is hot; rows go to it with their ids as bytes.  It lives in the session's state store; for large ones set
    the RocksDB provider."""
    keyed = with_member_key(ingest.raw_stream(spark, source_dir, max_files_per_trigger))
    renamed = clean.rename_strict(split.customers_raw(keyed), clean.CUSTOMER_RENAMES)
    rows = pack(clean.require(with_row_digest(renamed), ["annual_income"])).dropDuplicates([DIGEST])
    out_root = out_root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Written first: the state hands a row out once.
        path = f"{out_root}/customers_distinct/batch_id={batch_id}"
        io.write_parquet(unpack(batch.drop(DIGEST)), path)
        stored = batch.sparkSession.read.parquet(path)
        io.write_parquet(member_counts(stored), f"{out_root}/counts/customers/batch_id={batch_id}")

    return (rows.writeStream.foreachBatch(write_batch).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "customers-ckpt")).start())


def _packed_counts(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    parts = spark.read.parquet(f"{out_root.rstrip('/')}/counts/{name}")
    return pack(parts).groupBy(KEY).agg(F.sum("n").alias("n"))


def read_counts(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """(member_id, n) over all batches so far."""
    return unpack(_packed_counts(spark, out_root, name))


def compact_counts(spark: SparkSession, out_root: str, name: str, target: str) -> DataFrame:
    """Merge all batches' counts into one table at ``target``; later batches
    add to it."""
    io.write_parquet(read_counts(spark, out_root, name), target)
    return spark.read.parquet(target)


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Counts of several sources added up, e.g. a compacted table and later
    batches."""
    every = parts[0].select(KEY, "n")
    for part in parts[1:]:
        every = every.unionByName(part.select(KEY, "n"))
    return unpack(pack(every).groupBy(KEY).agg(F.sum("n").alias("n")))


def duplicate_list(counts: DataFrame) -> DataFrame:
    """A3–A5 from counts."""
    return counts.where("n > 1").select(KEY)


def duplicate_lists(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """A3–A5 and, as ``all``, U1: the lists as of the last batch."""
    lists = {name: duplicate_list(_packed_counts(spark, out_root, name)) for name in LISTS}
    return {name: unpack(df) for name, df in (lists | {"all": quarantine.union_distinct(*lists.values())}).items()}
