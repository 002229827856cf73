"""The SentencePiece codec against the library, exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lendwise.llm import piece_codec as pc
from lendwise.llm.queries import op4_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", "the ", " ", "  ", "\n", "\t", "é", "ß", "日本", "😀", "12", "!!", " ", "▁", "▁▁", "\x00", "aaaa", "<s>", "</s>",
         "<unk>", "<0x41>", "́", "\r\n", " " * 27, "x" * 400, "ą̈"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pc.Codec(pc.PieceModel(PATH))


def _texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 25))) for _ in range(n)]


def test_ids_spans_and_decoding(codec, library):
    texts = _texts(500, 2)
    ids, starts, begins, ends = codec.encode(texts)
    for i, text in enumerate(texts):
        own = ids[starts[i]:starts[i + 1]].tolist()
        assert own == library.encode(text)
        assert codec.decode(own) == library.decode(own) == text.replace("▁", " ")
        spans = list(zip(begins[starts[i]:starts[i + 1]].tolist(), ends[starts[i]:starts[i + 1]].tolist()))
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in spans) == raw
        for span, piece in zip(spans, library.encode(text, return_type="proto").pieces if text else []):
            shown = raw[span[0]:span[1]].decode("utf-8", "replace")
            assert not piece.surface or "�" in shown or shown == piece.surface


def test_decoding_any_ids(codec, library):
    rng = random.Random(4)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(1, 32000), rng.randrange(3, 259), rng.randrange(3, 259), 29871, 1, 2])
               for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_very_long_chunk(codec, library):
    text = "ab" * 3000 + "▁" * 3000 + "q" * 999
    assert codec.encode([text])[0].tolist() == library.encode(text)


@pytest.mark.parametrize("size", [1, 7, 60])
def test_long_texts_go_in_pieces(codec, library, monkeypatch, size):
    monkeypatch.setattr(pc, "PIECE", size)
    for text in [*_texts(200, 8), " lead", "▁ mark ", "no-space" * 40, "   ", "", "a  b\n c 😀 😀"]:
        pieces = list(codec.pieces_of(text))
        assert "".join(pieces) == text
        whole = codec.encode([text])
        ids, starts, begins, ends = codec.encode_long(text)
        assert ids.tolist() == library.encode(text) and starts.tolist() == [0, len(ids)]
        assert begins.tolist() == whole[2].tolist() and ends.tolist() == whole[3].tolist()
        assert codec.decode_long(ids) == library.decode(ids.tolist())
    assert len(list(codec.pieces_of("word " * 100))) > 5


def test_decoding_any_ids_in_pieces(codec, library, monkeypatch):
    monkeypatch.setattr(pc, "PIECE", 3)
    rng = random.Random(5)
    for _ in range(800):
        ids = [rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259), rng.randrange(3, 259), 29871, rng.choice([0, 1, 2, 300])])
               for _ in range(rng.randint(0, 20))]
        assert codec.decode_long(np.array(ids, np.int32)) == library.decode(ids), ids


class _Mapped(pc.PieceModel):
    """The model with another normalisation: a compiled character map."""

    @property
    def proto(self):
        if not hasattr(_Mapped, "_proto"):
            from sentencepiece import sentencepiece_model_pb2
            normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
            spec = sentencepiece_model_pb2.ModelProto.FromString(normaliser.serialized_model_proto())
            model = sentencepiece_model_pb2.ModelProto.FromString(open(self.path, "rb").read())
            model.normalizer_spec.CopyFrom(spec.normalizer_spec)
            _Mapped._proto = model
        return _Mapped._proto


def test_compiled_character_map():
    model = _Mapped(PATH)
    library = sentencepiece.SentencePieceNormalizer(model_proto=model.proto.SerializeToString())
    processor = sentencepiece.SentencePieceProcessor(model_proto=model.proto.SerializeToString())
    codec = pc.Codec(model)
    parts = [*PARTS, "Ａ", "ﬁ", "①", "㌔", "　", "é", "ｶﾞ", "​", "Å", "½"]
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12))).replace("\x00", "")
        normal, source = pc.normalise(model, text.encode())
        assert normal.decode() == library.normalize(text)
        assert len(source) == len(normal) + 1 and (source[1:] >= source[:-1]).all() and (len(text) == 0 or source[-1] <= len(text.encode()))
        ids = codec.encode([text])[0].tolist()
        assert ids == processor.encode(text), text
        assert codec.decode(ids) == processor.decode(ids), text


def test_query(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op4_sentencepiece(spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids)) and r.spans_cover


def test_odd_rows(edge, empty, library):
    got = pc.encode(edge, PATH, decoded=True).collect()
    texts = [r.text or "" for r in edge.collect()]
    assert sorted(r.ids for r in got) == sorted(map(library.encode, texts))
    assert sorted(r.decoded for r in got) == sorted(t.replace("▁", " ") for t in texts)
    assert pc.encode(empty, PATH).count() == 0
    again = pc.decode(pc.encode(edge, PATH), PATH).collect()
    assert sorted(r.decoded for r in again) == sorted(t.replace("▁", " ") for t in texts)
