"""WARC archives: exact round trips, member layout, revisits."""

import base64
import gzip
import hashlib
import io
import zlib
from pathlib import Path

import pytest

from lendwise.llm import warc
from lendwise.session import scratch_path

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2 x", "<p>two</p>"), (3, "http://a/\r\nEvil: 1", "<p>one</p>"), (4, None, ""),
         (5, "u", None), (6, "u", "é日本\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (0, "u", "<p>one</p>"), (None, "u", "<p>two</p>"),
         (7, "u", "z" * 3_000_000), (8, "u", "\r\n\r\n"), (8, "u", "\r\n\r\n")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, digest string, id string")


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, pages):
    got = warc.archive_pages(pages, scratch_path(spark, "warc")).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    expected = sorted(((None if i is None else str(i), len((h or "").encode()), _digest(h),
                        "response" if first.get(h or "", i) == i else "revisit",
                        None if first.get(h or "", i) == i else str(first[h or ""])) for i, _, h in PAGES), key=repr)
    assert sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected


def test_small_payloads_stay_responses(spark, pages):
    kinds = {r.record_id: r.record_type for r in warc.archive_pages(pages, scratch_path(spark, "warc"), min_bytes=100).collect()}
    assert set(kinds.values()) == {"response"}


def test_every_record_is_its_own_member(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.decide_revisits(pages), f"{path}/raw")
    done = warc.normalise_archives(spark, f"{path}/raw", f"{path}/out").collect()
    assert sum(r.records for r in done) == len(PAGES)
    for r in done:
        data = Path(r.archive).read_bytes()
        raw, = Path(f"{path}/raw").glob(f"{Path(r.archive).name.split('.')[0]}*.gz")
        assert gzip.decompress(data) == gzip.decompress(raw.read_bytes())
        for line in Path(r["index"]).read_text().splitlines():
            offset, length, record = line.split("\t")
            engine = zlib.decompressobj(31)
            head = engine.decompress(data[int(offset):int(offset) + int(length)])
            assert engine.eof and not engine.unused_data and f"WARC-Record-ID: {record}".encode() in head
    # Running it again replaces the files by equal ones.
    again = warc.normalise_archives(spark, f"{path}/raw", f"{path}/out").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, done))


def test_stream_with_many_members_and_bad_ends():
    record = b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    source = io.BytesIO(gzip.compress(record % 1) + gzip.compress(record % 2 + record % 3))
    out = io.BytesIO()
    assert [f["warc-record-id"] for *_, f in warc.normalise_stream(source, out)] == [f"<urn:page:{i}>" for i in (1, 2, 3)]
    for broken in (record % 1 + b"WARC/1.1\r\nCon", (record % 1)[:-8], b"HTTP/1.1 x\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.normalise_stream(io.BytesIO(gzip.compress(broken)), io.BytesIO()))


def test_empty_table(spark, pages):
    assert warc.archive_pages(pages.limit(0), scratch_path(spark, "warc")).count() == 0


def test_an_archive_cut_short_is_refused():
    import gzip
    import io
    import zlib
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    whole = gzip.compress(record * 3) + gzip.compress(record)
    assert len(list(warc.normalise_stream(io.BytesIO(whole), io.BytesIO()))) == 4
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    at_a_record = engine.compress(record * 2) + engine.flush(zlib.Z_FULL_FLUSH)  # no end of the member
    for cut in (at_a_record, whole[:-4], whole[:-30]):
        with pytest.raises(ValueError, match="archive ends inside"):
            list(warc.normalise_stream(io.BytesIO(cut), io.BytesIO()))
