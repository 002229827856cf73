"""Token counts against the library."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from lendwise.llm import token_counts as tc
from lendwise.llm.queries import op2_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", "the ", " ", "  ", "\n", "\t", "é", "ß", "日本", "😀", "'s", "'LL", "12", "!!", " ", " ", "\u0085",
         "\x1c", "\x00", "aaaa", "<|endoftext|>", "́", "٣", "Ⅷ", "½", "﻿", "x" * 700]


def _library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_random_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(600)] + ["ab" * 4000 + "z" * 3000]
    model = tc.ByteBpe(PATH)
    assert tc.Counter(model, model.proven_whole()).count(texts).tolist() == _library(texts)


def test_long_texts_go_in_runs(monkeypatch):
    monkeypatch.setattr(tc, "RUN", 3)
    monkeypatch.setattr(tc, "SLICE_BYTES", 20)
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(300)] + ["<|endoftext|>" * 5, " " * 90]
    model = tc.ByteBpe(PATH)
    counter = tc.Counter(model, model.proven_whole())
    expected = _library(texts)
    assert [counter.count_long(t) for t in texts] == expected
    assert [int(counter.count([t])[0]) for t in texts] == expected


def test_proven_strings_are_one_token():
    model, tokenizer = tc.ByteBpe(PATH), Tokenizer.from_file(PATH)
    proven = model.proven_whole()
    assert len(proven) > 40_000
    for word in random.Random(1).sample(proven, 500):
        assert len(tokenizer.model.tokenize("".join(tc.byte_letters()[b] for b in word.encode()))) == 1


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"zq{i} wordish{i * 7}" for i in range(50)]
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    model = tc.ByteBpe(PATH)
    counter = tc.Counter(model, model.proven_whole())
    assert [int(counter.count([t])[0]) for t in texts] == _library(texts)


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op2_token_counts(spark, SF).collect()
    expected = dict(zip(texts, _library(list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in got} == expected
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in got)


def test_odd_rows(edge, empty):
    got = tc.token_counts(edge, PATH, 100).collect()
    texts = [r.text or "" for r in edge.collect()]
    assert sorted(r.n_tokens for r in got) == sorted(_library(texts))
    assert tc.token_counts(empty, PATH, 100).count() == 0
