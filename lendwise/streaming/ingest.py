"""Continuous raw split: new raw CSV files -> member key -> four split zones.

Keying and splitting are per-row and stateless, so they run unchanged on a
stream.  Each micro-batch is keyed once, written to the shared folder and
split from there into the four zones with ``foreachBatch``; every output goes
to a folder named by the batch id and is written in overwrite mode, so a batch replayed after a failure
replaces its own output instead of duplicating it (the checkpoint makes the
source offsets exactly-once).  The downstream cleaning and scoring stages
need all rows of a member and stay batch jobs over the zones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lendwise import schemas
from lendwise.functions.keys import with_member_key
from lendwise.operators import split
from lendwise.session import scratch_path
from lendwise.sources import io

SPLITS = {
    "customers": split.split_customers,
    "loans": split.split_loans,
    "repayments": split.split_repayments,
    "defaulters": split.split_defaulters,
}


def raw_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.RAW).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def start_split_stream(spark: SparkSession, source_dir: str, out_root: str,
                       checkpoint: str | None = None, available_now: bool = True,
                       processing_time: str | None = None,
                       max_files_per_trigger: int = 1000,
                       also: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start the ingest; ``available_now`` drains what is there and stops.

    ``max_files_per_trigger`` bounds a micro-batch, whatever the backlog.
    ``also`` is called with each batch's keyed rows, as stored, and its id;
    what it writes must be replaceable by batch as well."""
    keyed = with_member_key(raw_stream(spark, source_dir, max_files_per_trigger))
    out_root = out_root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        staged = f"{out_root}/keyed/batch_id={batch_id}"
        io.write_parquet(batch, staged)
        stored = batch.sparkSession.read.parquet(staged)
        for name, fn in SPLITS.items():
            io.write_parquet(fn(stored), f"{out_root}/{name}/batch_id={batch_id}")
        if also is not None:
            also(stored, batch_id)

    writer = (keyed.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_split(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """All batches of one split zone (the batch id is a partition column)."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/{name}").drop("batch_id")
