"""WARC archives: deduplicated writing, gzip normalising, reading by index.

``write_archives`` writes whole-file gzip streams (one member per file), the
form a naive compressor leaves behind.  ``normalise_archives`` inflates each
such stream once, rewrites every record as a gzip member of its own and puts
a sidecar offset index beside it, after which ``read_records`` fetches any
record by seeking.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import column, materialise, ship_package

# Fixed values of the WARC 1.1 and HTTP framing.
CRLF = b"\r\n"
RECORD_END = b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 20


# ---------------------------------------------------------------- writing

def base32(sha1_hex: str) -> Column:
    """Bare upper-case base32 of a column of SHA-1 in hex: five hex digits
    give four letters."""
    def letters(i: Column) -> Column:
        v = F.conv(F.substr(F.col(sha1_hex), i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)])
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def _header(*fields: Column) -> Column:
    return F.concat_ws("\r\n", *fields)


def decide_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id",
                    url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, sha1, n_bytes, refers_to): of the pages with equal
    payloads of at least ``min_bytes`` bytes the smallest id stays a
    response (refers_to null) and the others revisit it.

    The payload is addressed by its SHA-1 and length.  The first ids are
    pre-aggregated map-side; only repeated payloads are kept for the join,
    whose right side is unique per payload, so a hot payload can be split.
    A null payload is empty.  A page without an id revisits an equal one that
    has an id and else stays a response; rows that repeat the smallest id all
    stay responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"),
                             "n_bytes": F.octet_length("payload").cast("long")})
    firsts = (rows.where(F.col("n_bytes") >= min_bytes).groupBy("sha1", "n_bytes")
              .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").drop("copies"))
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return (rows.join(firsts, ["sha1", "n_bytes"], "left")
            .withColumn("refers_to", F.when(other, F.col("first"))).drop("first"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write ``decide_revisits`` rows as WARC files, each one whole gzip
    stream, with Spark's text sink: a record is a line and the blank lines
    that end a record are the separator, so any file system Spark can write
    will do.  One file per partition."""
    safe_url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("payload")))
    head = _header(
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), safe_url),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("n_bytes").cast("string")),
        # concat_ws leaves out nulls, so a response has neither of these.
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
        F.lit(""), F.col("block"))
    lines = records.withColumns({"block": block, "digest": base32("sha1")}).select(head.alias("value"))
    (lines.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").text(path))


# ------------------------------------------------------------ normalising

def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``uri`` and the path in it."""
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _inflate(source) -> Iterator[bytes]:
    """The inflated bytes of a gzip stream of one or more members, in pieces
    of bounded size; a stream that ends inside a member raises."""
    engine, begun = zlib.decompressobj(31), False
    while data := source.read(CHUNK):
        while data:
            begun = True
            out = engine.decompress(data, CHUNK)
            if out:
                yield out
            data = engine.unconsumed_tail
            if engine.eof:
                data, engine, begun = engine.unused_data, zlib.decompressobj(31), False
    if begun:
        tail = engine.flush()
        if tail:
            yield tail
        if not engine.eof:
            raise ValueError("archive ends inside a gzip member")


class _Stream:
    """Reads heads and blocks from pieces; holds one head and one piece."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buffer = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.buffer += piece
        return True

    def head(self) -> bytes | None:
        """The next record's head with its blank line; None at the end."""
        start = 0
        while (at := self.buffer.find(RECORD_END, start)) < 0:
            start = max(0, len(self.buffer) - 3)
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a record head")
                return None
        head, self.buffer = self.buffer[:at + 4], self.buffer[at + 4:]
        return head

    def block(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.buffer and not self._more():
                raise ValueError("archive ends inside a record block")
            piece, self.buffer = self.buffer[:length], self.buffer[length:]
            length -= len(piece)
            yield piece


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record head: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def normalise_stream(source, target) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Copy a whole-file gzip WARC from ``source`` to ``target`` with a gzip
    member per record; yields (offset, length, head fields) of each.  Blocks
    pass through piece by piece, whatever their size."""
    stream, offset = _Stream(_inflate(source)), 0
    while (head := stream.head()) is not None:
        fields = parse_head(head)
        engine, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0

        def put(data: bytes) -> None:
            nonlocal size
            target.write(data)
            size += len(data)

        put(engine.compress(head))
        for piece in stream.block(int(fields["content-length"])):
            put(engine.compress(piece))
        for end in stream.block(len(RECORD_END)):
            if end.strip(CRLF):
                raise ValueError("record block is longer than its Content-Length")
            put(engine.compress(end))
        put(engine.flush())
        yield offset, size, fields
        offset += size


def _normalise_file(uri: str, out_dir: str) -> tuple[str, str, int, int]:
    """Normalise one archive.  Both outputs are written under names of this
    attempt and renamed when complete, the index last: a retried or doubled
    task replaces them by equal files and readers never see a part."""
    src_fs, src = open_fs(uri)
    out_fs, out = open_fs(out_dir)
    out_fs.create_dir(out, recursive=True)
    name = src.rsplit("/", 1)[-1].split(".")[0]
    data, index = f"{out}/{name}.warc.gz", f"{out}/{name}.idx"
    attempt = uuid.uuid4().hex
    count = size = 0
    with (src_fs.open_input_stream(src, compression=None) as source,
          out_fs.open_output_stream(f"{data}.{attempt}", compression=None) as target,
          out_fs.open_output_stream(f"{index}.{attempt}", compression=None) as listing):
        for offset, length, fields in normalise_stream(source, target):
            listing.write(f"{offset}\t{length}\t{fields['warc-record-id']}\n".encode())
            count, size = count + 1, offset + length
    out_fs.move(f"{data}.{attempt}", data)
    out_fs.move(f"{index}.{attempt}", index)
    return data, index, count, size


def normalise_archives(spark: SparkSession, path: str, out_dir: str) -> DataFrame:
    """Normalise every ``*.gz`` under ``path``, one task per file; returns
    (archive, index, records, bytes) per file, already written."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
             .select("path"))
    n = max(1, 2 * files.count())

    def work(batches):
        for batch in batches:
            done = [_normalise_file(uri, out_dir) for uri in column(batch, "path").to_pylist()]
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("archive", "index", "records", "bytes"),
                map(list, zip(*done)) if done else ([], [], [], []))),
                schema=pa.schema([("archive", pa.string()), ("index", pa.string()),
                                  ("records", pa.int64()), ("bytes", pa.int64())]))

    done = files.repartition(n, "path").mapInArrow(work, "archive string, index string, records long, bytes long")
    return materialise(done, "warc_normalised")


# ---------------------------------------------------------------- reading

RECORD_SCHEMA = ("record_id string, record_type string, refers_to string, url string, "
                 "payload_digest string, payload_bytes long")
_RECORD_ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                           ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Head fields and payload of one record's gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(RECORD_END)
    fields = parse_head(head)
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(RECORD_END)[2] if block else b""


def _record(member: bytes) -> tuple:
    fields, payload = parse_record(member)
    strip = lambda v: v[len("<urn:page:"):-1] if v else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    n_bytes = int(fields["x-payload-length"])
    if fields["warc-type"] == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own != digest or len(payload) != n_bytes:
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return (strip(fields["warc-record-id"]), fields["warc-type"], strip(fields.get("warc-refers-to")),
            fields.get("warc-target-uri"), digest, n_bytes)


def read_records(spark: SparkSession, out_dir: str, archives: DataFrame, block_bytes: int = 8 << 20) -> DataFrame:
    """Fetch every indexed record by its offset and check responses against
    their digests.  The index rows are dealt out by blocks of the archives,
    so the work of a task is bounded whatever the size of an archive."""
    index = spark.read.schema("offset long, length long, record_id string").option("sep", "\t").option(
        "quote", "").option("pathGlobFilter", "*.idx").csv(out_dir)
    stored = archives.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-stored // block_bytes))
    where = F.regexp_replace(F.col("_metadata.file_path"), r"\.idx$", ".warc.gz")
    index = index.select(where.alias("archive"), "offset", "length")
    index = (index.withColumn("block", F.floor(F.col("offset") / block_bytes))
             .repartition(int(tasks), "archive", "block").sortWithinPartitions("archive", "offset"))

    def fetch(batches):
        opened, handle = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(column(batch, c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    if handle is not None:
                        handle.close()
                    file_system, where_ = open_fs(archive)
                    opened, handle = archive, file_system.open_input_file(where_)
                handle.seek(offset)
                rows.append(_record(handle.read(length)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RECORD_ARROW)], schema=_RECORD_ARROW)
        if handle is not None:
            handle.close()

    return index.mapInArrow(fetch, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id",
                  url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC under ``path``/raw, normalise them into
    ``path``/normalised and read them back: one row per page, ids as text.

    An empty table gives an empty result; null payloads are empty payloads,
    null urls empty urls, a null id comes back null.
    """
    spark = pages.sparkSession
    ship_package(spark)
    write_archives(decide_revisits(pages, min_bytes, id_col, url_col, payload_col), f"{path}/raw")
    archives = normalise_archives(spark, f"{path}/raw", f"{path}/normalised")
    if archives.isEmpty():
        return spark.createDataFrame([], RECORD_SCHEMA)
    records = read_records(spark, f"{path}/normalised", archives)
    return records.withColumn("record_id", F.when(F.col("record_id") != "", F.col("record_id")))
