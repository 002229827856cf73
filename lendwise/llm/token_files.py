"""Token ids in files, coded by a static range asymmetric numeral system.

One job counts the ids of all documents and fixes the table of frequencies;
a second one writes the ids, in order of the documents, as files of
independent interleaved blocks with checkpoints.  Beside every file stand an
index of its segments and a list of its documents, so that tasks decode any
segments by themselves.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .rans import Layout, Segment, Table, decode, encode, quantise, shifted_crc
from .shared import column, id_and_text, ship_package, text_bytes, text_slices
from .warc import open_fs
from .word_ids import WordEncoder

# Ids coded and segments decoded at a time.
IDS_AT_ONCE = 1 << 21
SEGMENTS_AT_ONCE = 64


@dataclass(frozen=True)
class FileParams:
    """``end_id`` is appended to every document."""
    end_id: int = 2
    layout: Layout = field(default_factory=Layout)


@lru_cache(maxsize=1)
def _worker_encoder(path: str) -> WordEncoder:
    """One per worker process, kept from task to task and job to job."""
    return WordEncoder(path)


def count_ids(docs: DataFrame, tokenizer: str, params: FileParams, text_col: str) -> np.ndarray:
    """How often each id stands in all documents, end ids included.  Tasks sum
    their rows before the shuffle; the driver gets one row per id."""
    vocabulary = WordEncoder(tokenizer).vocabulary

    def count(batches):
        encoder, total = _worker_encoder(tokenizer), np.zeros(vocabulary, np.int64)
        for batch in text_slices(batches):
            ids, _ = encoder.encode(*text_bytes(column(batch, "text")))
            total += np.bincount(ids, minlength=vocabulary)
            total[params.end_id] += batch.num_rows
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["symbol", "n"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    summed = docs.select(text.alias("text")).mapInArrow(count, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[summed["symbol"].to_numpy()] = summed["n"].to_numpy()
    return counts


class _Writer:
    """One file of segments and its index, under names of this attempt until
    both are complete: a retried or doubled task replaces them by equal
    files and readers never see a part."""

    def __init__(self, folder: str, name: str, table: Table, layout: Layout):
        self.fs, self.folder = open_fs(folder)
        self.name, self.attempt, self.table, self.layout = name, uuid.uuid4().hex, table, layout
        self.data = self.fs.open_output_stream(self._path("rans"), compression=None)
        self.index: list[str] = []
        self.held, self.n_held, self.first, self.offset = [], 0, 0, 0

    def _path(self, kind: str) -> str:
        return f"{self.folder}/{self.name}.{kind}.{self.attempt}"

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= IDS_AT_ONCE:
            self._code(IDS_AT_ONCE // self.layout.block_ids * self.layout.block_ids or self.layout.block_ids)

    def _code(self, n: int) -> None:
        """Code the first ``n`` of the ids held, whole blocks but for the last."""
        ids = np.concatenate(self.held)
        ids, rest = ids[:n], ids[n:]
        self.held, self.n_held = [rest], len(rest)
        for segment in encode(ids, self.table, self.layout):
            record = segment.pack(self.table)
            self.data.write(record)
            self.index.append(f"{self.offset}\t{len(record)}\t{self.first}\t{segment.n_ids}\n")
            self.offset += len(record)
            self.first += segment.n_ids

    def close(self) -> None:
        if self.n_held:
            self._code(self.n_held)
        self.data.close()
        with self.fs.open_output_stream(self._path("idx"), compression=None) as listing:
            listing.write("".join(self.index).encode())
        for kind in ("rans", "idx"):
            self.fs.move(self._path(kind), f"{self.folder}/{self.name}.{kind}")


_DOCUMENTS = pa.schema([("file", pa.string()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def write_token_files(docs: DataFrame, tokenizer: str, path: str, params: FileParams = FileParams(), id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Write the ids of all documents under ``path``: ``table`` (the
    frequencies), ``ids`` (files of segments and their indexes, ascending by
    document id with the file names) and ``documents`` (id, file, place and
    number of its ids).

    Null and empty texts have the end id alone.  Null ids come first; rows
    that share an id follow each other by their text.  Other columns are
    ignored; an empty table writes no file.  Each text is tokenised twice, for
    the table and for the files, which costs less than keeping all ids.  A
    task holds one slice of text and one run of blocks, whatever its rows; a
    single long text takes some 20 times its bytes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    frequencies, bits = quantise(count_ids(docs, tokenizer, params, text_col))
    used = np.flatnonzero(frequencies)  # at most the vocabulary
    stored = spark.createDataFrame([(int(s), int(frequencies[s]), bits, len(frequencies)) for s in used],
                                   "symbol int, frequency long, bits int, vocabulary int")
    stored.coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((frequencies, bits))
    folder = f"{path}/ids"
    files, where = open_fs(folder)
    files.create_dir(where, recursive=True)

    def write(batches):
        encoder, table, writer = _worker_encoder(tokenizer), Table(*shared.value), None
        for batch in text_slices(batches):
            writer = writer or _Writer(folder, f"part-{TaskContext.get().partitionId():05d}", table, params.layout)
            ids, starts = encoder.encode(*text_bytes(column(batch, "text")))
            first = writer.first + writer.n_held
            # Before the next document's ids stands the end id of this one.
            writer.add(np.insert(ids, starts[1:], params.end_id))
            sizes = np.diff(starts) + 1
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array([writer.name] * batch.num_rows, pa.string()),
                 pa.array(first + np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int64())],
                names=["id", *_DOCUMENTS.names])
        if writer is not None:
            writer.close()

    rows = id_and_text(docs, id_col, text_col)
    # The row's own number spreads equal rows over the files.
    rows = rows.withColumns({"digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = ("id", "digest", "row")
    kind = rows.schema["id"].dataType.simpleString()
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    ordered.mapInArrow(write, f"id {kind}, file string, first long, n_tokens long").write.parquet(f"{path}/documents")


def read_table(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    rows = spark.read.parquet(f"{path}/table").collect()  # at most the vocabulary
    frequencies = np.zeros(rows[0].vocabulary if rows else 0, np.int64)
    for row in rows:
        frequencies[row.symbol] = row.frequency
    return frequencies, rows[0].bits if rows else 16


def read_pieces(spark: SparkSession, path: str, params: FileParams = FileParams(), with_ids: bool = False) -> DataFrame:
    """(id, file, first, n_tokens, n, crc) and, if asked for, ``at`` and
    ``ids``: the documents as the files give them, in pieces where they cross
    a run of segments.  ``n`` ids are in the piece, ``crc`` is what they add
    to the CRC-32 of the document's ids as little-endian numbers of 32 bits,
    ``at`` the first one's place in the document.

    A task is dealt runs of ``SEGMENTS_AT_ONCE`` segments, whatever the size
    of a file, and reads and decodes them by themselves; each is checked.
    """
    shared = spark.sparkContext.broadcast(read_table(spark, path))
    folder = f"{path}/ids"
    run = params.layout.segment_ids * SEGMENTS_AT_ONCE
    documents = spark.read.parquet(f"{path}/documents")
    kind = documents.schema["id"].dataType.simpleString()
    index = spark.read.schema("offset long, length long, first long, n long").option("sep", "\t").option(
        "pathGlobFilter", "*.idx").csv(folder)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.idx$", 1)
    segments = index.select(name.alias("file"), F.floor(F.col("first") / run).alias("run"), F.lit(0).alias("kind"), "first", "n",
                            F.col("offset"), F.col("length"), F.lit(None).cast(kind).alias("id"))
    last = F.floor((F.col("first") + F.col("n_tokens") - 1) / run)
    parts = documents.select("file", F.explode(F.sequence(F.floor(F.col("first") / run), last)).alias("run"), F.lit(1).alias("kind"),
                             "first", F.col("n_tokens").alias("n"), F.lit(None).cast("long").alias("offset"),
                             F.lit(None).cast("long").alias("length"), "id")
    # The rows are small, the ids behind them are not: tasks by runs of ids,
    # not by bytes of rows.
    total = documents.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // run))
    dealt = segments.unionByName(parts).repartition(int(tasks), "file", "run").sortWithinPartitions("file", "run", "kind", "first")
    names = ["id", "file", "first", "n_tokens", "n", "crc"] + (["at", "ids"] if with_ids else [])

    def work(batches):
        table = Table(*shared.value)
        here, held, ids, base = None, [], None, 0
        for batch in batches:
            rows = zip(*(column(batch, c).to_pylist() for c in ("file", "run", "kind", "first", "n", "offset", "length")))
            out, picked = [], []
            for k, (file, number, is_document, first, n, offset, length) in enumerate(rows):
                if (file, number) != here:
                    here, held, ids = (file, number), [], None
                if not is_document:
                    held.append((first, offset, length))
                    continue
                if ids is None:
                    ids, base = _read_run(folder, file, held, table), held[0][0]
                    raw = memoryview(ids.astype("<u4").tobytes())
                a, b = max(first, base), min(first + n, base + len(ids))
                crc = zlib.crc32(raw[4 * (a - base):4 * (b - base)])
                if b < first + n:
                    crc = shifted_crc(crc, 4 * (first + n - b))
                out.append((file, first, n, b - a, crc, a - first, ids[a - base:b - base] if with_ids else None))
                picked.append(k)
            columns = list(zip(*out)) if out else [[]] * 7
            arrays = [column(batch, "id").take(pa.array(picked, pa.int64())), pa.array(columns[0], pa.string()),
                      *(pa.array(c, pa.int64()) for c in columns[1:5])]
            if with_ids:
                arrays += [pa.array(columns[5], pa.int64()), pa.array(columns[6], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"id {kind}, file string, first long, n_tokens long, n long, crc long" + (", at long, ids array<int>" if with_ids else "")
    return dealt.mapInArrow(work, schema)


def _read_run(folder: str, file: str, held: list[tuple[int, int, int]], table: Table) -> np.ndarray:
    """The ids of neighbouring segments (first, offset, length) of a file."""
    file_system, where = open_fs(folder)
    with file_system.open_input_file(f"{where}/{file}.rans") as handle:
        handle.seek(held[0][1])
        raw = handle.read(held[-1][1] + held[-1][2] - held[0][1])
    start = held[0][1]
    return decode([Segment.unpack(raw[at - start:at - start + size], table) for _, at, size in held], table)


def read_documents(spark: SparkSession, path: str, params: FileParams = FileParams()) -> DataFrame:
    """Per document: ``id, start, n_tokens, ids_crc32``, all read from the
    files; ``start`` counts the ids of all documents before it."""
    pieces = read_pieces(spark, path, params)
    summed = pieces.groupBy("file", "first").agg(F.first("id").alias("id"), F.first("n_tokens").alias("n_tokens"), F.sum("n").alias("n"),
                                                 F.bit_xor("crc").alias("ids_crc32"))
    whole = F.when(F.col("n") == F.col("n_tokens"), F.col("n")).otherwise(
        F.raise_error(F.lit("a document is not whole in its file")).cast("long"))
    files = spark.read.parquet(f"{path}/documents").groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    before, at = [], 0
    for row in files:  # one row a file
        before.append((row.file, at))
        at += row.n
    starts = spark.createDataFrame(before, "name string, before long")
    return (summed.join(F.broadcast(starts), F.col("file") == F.col("name"))
            .select("id", (F.col("before") + F.col("first")).alias("start"), whole.alias("n_tokens"), "ids_crc32"))
