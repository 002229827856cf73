"""Token files: the coder's round trips, ids as the library gives them, reading by pieces, odd rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from lendwise.llm import rans, token_files as tf
from lendwise.llm.shared import text_bytes
from lendwise.llm.word_ids import WordEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = tf.FileParams(layout=rans.Layout(lanes=4, steps=4, segments=2))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def _table(ids, size=50):
    return rans.Table(*rans.quantise(np.bincount(ids, minlength=size)))


def test_round_trips():
    rng = np.random.default_rng(1)
    for layout in (rans.Layout(), rans.Layout(4, 3, 2), rans.Layout(1, 1, 1)):
        for n in (1, 3, 4, 11, 12, 13, 24, 25, 400):
            ids = (rng.zipf(1.3, n) % 50).astype(np.int32)
            table = _table(ids)
            segments = [rans.Segment.unpack(s.pack(table), table) for s in rans.encode(ids, table, layout)]
            assert rans.decode(segments, table).tolist() == ids.tolist()
            # Any segment by itself, in any company.
            parts = [ids[k:k + layout.segment_ids].tolist() for k in range(0, n, layout.segment_ids)]
            for k in (0, len(parts) // 2, len(parts) - 1):
                assert rans.decode([segments[k], segments[0]], table).tolist() == parts[k] + parts[0]
    assert rans.encode(np.empty(0, np.int32), _table(ids)) == []


def test_one_symbol_and_rare_symbols():
    ones = np.full(1000, 3, np.int32)
    assert (rans.decode(rans.encode(ones, _table(ones)), _table(ones)) == 3).all()
    counts = np.zeros(40_000, np.int64)
    counts[::2], counts[7] = 1, 10**15
    frequencies, bits = rans.quantise(counts)
    assert frequencies.sum() == 1 << bits and (frequencies[counts > 0] > 0).all() and (frequencies[counts == 0] == 0).all()
    with pytest.raises(ValueError, match="not in the table"):
        rans.encode(np.array([1]), rans.Table(frequencies, bits))


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(2)
    p = 1 / np.arange(1, 5001)
    ids = rng.choice(5000, 300_000, p=p / p.sum()).astype(np.int32)
    table, n = _table(ids, 5000), np.bincount(ids)
    entropy = -(n[n > 0] * np.log2(n[n > 0] / len(ids))).sum() / 8
    assert sum(len(s.pack(table)) for s in rans.encode(ids, table)) < 1.06 * entropy


def test_damage_is_found():
    ids = np.arange(200, dtype=np.int32) % 50
    table = _table(ids)
    record = bytearray(rans.encode(ids, table, rans.Layout(4, 50, 1))[0].pack(table))
    record[-3] ^= 1
    with pytest.raises(ValueError, match="checksum|ends before"):
        rans.decode([rans.Segment.unpack(bytes(record), table)], table)
    with pytest.raises(ValueError, match="not a segment"):
        rans.Segment.unpack(bytes(record[:-4]), table)
    with pytest.raises(ValueError, match="not a segment"):
        rans.Segment.unpack(bytes(record), _table(ids[:10]))


def test_shifted_checksums():
    for a, b, c in ((b"", b"x", b""), (b"hello", b"world" * 999, b"end"), (b"\0" * 7, b"", b"\xff")):
        whole = rans.shifted_crc(zlib.crc32(a), len(b) + len(c)) ^ rans.shifted_crc(zlib.crc32(b), len(c)) ^ zlib.crc32(c)
        assert whole == zlib.crc32(a + b + c)


PIECES = ["a", "b", "st", "re", "ve", "m", "ll", "d", "'", "''", " ", "  ", "\n", "\r\n", "\t", "\xa0", "　", "1", "23", "é", "日本", "😀",
          "<|endoftext|>", "<|endoftext", "|>", "!", "-", "A", "Ⅷ", "\x1c", "\x85", "ß", "́", "\x00", " '", "x" * 300, "#"]


def test_words_equal_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["", "", " ", "'s", "<|endoftext|>"]
    encoder = WordEncoder(PATH)
    for k in range(0, len(texts), 300):
        part = texts[k:k + 300]
        ids, starts = encoder.encode(*text_bytes(pa.array(part)))
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want
    assert encoder.encode(*text_bytes(pa.array(["", ""])))[1].tolist() == [0, 0, 0]


def _expected(rows, library):
    out, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("params", [tf.FileParams(), SMALL], ids=["files", "small blocks"])
def test_documents_come_back(spark, tmp_dir, library, params, monkeypatch):
    monkeypatch.setattr(tf, "SEGMENTS_AT_ONCE", 2)
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "", "#"]) if i % 9 == 0 else "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))) for i in range(300)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    tf.write_token_files(docs, PATH, f"{tmp_dir}/t", params)
    got = sorted(tuple(r) for r in tf.read_documents(spark, f"{tmp_dir}/t", params).collect())
    assert got == _expected(rows, library)
    pieces: dict = {}
    for r in sorted(tf.read_pieces(spark, f"{tmp_dir}/t", params, with_ids=True).collect(), key=lambda r: r.at):
        pieces.setdefault(r.id, []).extend(r.ids)
    assert pieces == {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}


def test_odd_rows(spark, tmp_dir, edge, empty, library):
    tf.write_token_files(edge, PATH, f"{tmp_dir}/t")
    got = tf.read_documents(spark, f"{tmp_dir}/t").collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = [r[2:] for r in _expected(rows, library)]
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    by_start = [r.id for r in sorted(got, key=lambda r: r.start)]
    assert by_start == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    tf.write_token_files(empty, PATH, f"{tmp_dir}/none")
    assert tf.read_documents(spark, f"{tmp_dir}/none").count() == 0


def test_query_equals_the_library(spark, library):
    from lendwise.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, sf).collect()) == _expected(rows, library)
