"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendwise.session import scratch_path

# The words of the contracts are maximal runs outside these six characters.
WORD_SPACES = " \t\n\x0b\x0c\r"
# Text handed to one step of vectorised work inside a task; the arrays made
# from it take some tens of times as much.
SLICE_BYTES = 1 << 20
# Bytes of rows that pass between Spark and a task at a time; a longer row
# passes alone.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage with a durable copy: a lost executor costs only the
    tasks that were running, never the steps before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str,
                null_as_empty: bool = True) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that no
    extra column of the input can clash with one the operator makes."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("id"),
                     (F.coalesce(text, F.lit("")) if null_as_empty else text).alias("text"))


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that no slice holds more than ``limit`` bytes of
    text, unless a single text is longer; whole rows, in order."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        offsets = _offsets(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = start + 1
            while end < batch.num_rows and offsets[end + 1] - offsets[start] <= limit:
                end += 1
            yield batch.slice(start, end - start)
            start = end
        # What the slices took goes back before the next batch is read.
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker is used again by later
    stages, and would hold on to the most that any of them took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not the GNU allocator
    _trim = None


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of a column of texts laid end to end, without a copy, and
    where each text begins; there are no nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    size = int(places[-1] - places[0])
    raw = np.frombuffer(data, np.uint8, size, int(places[0])) if size else np.empty(0, np.uint8)
    return raw, places[:-1] - places[0]


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or the next like it that no column of ``df`` bears."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _offsets(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).tolist()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed:
    Spark hands its files out with the job.  Also bounds the session's Arrow
    batches by ``BATCH_BYTES``: Spark's own bound, 64 MB, takes several times
    that in the executor and its worker."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(bound, None)
    if now is None or not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))
    import os
    import shutil
    import tempfile

    import lendwise
    sc = spark.sparkContext
    if getattr(sc, "_lendwise_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(lendwise.__file__)))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="lendwise-pkg-"), "lendwise"), "zip", root, "lendwise")
    sc.addPyFile(made)
    sc._lendwise_shipped = True


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """At most ``rows`` rows in each Arrow batch of the jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Rows up to which a written table of ids, hashes or short lists is broadcast.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, a written one, marked for broadcast if it has at most
    ``rows`` rows; beyond it Spark joins by a shuffle."""
    return F.broadcast(table) if table.count() <= rows else table


def arrow_schema(df: DataFrame) -> str:
    """The columns of ``df`` as a schema for a function that passes its rows on."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
