"""Mixture inference: plain EM as the model, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendwise.llm import language_mixture as lm

SF = "/root/testdata/sf0.01"
SMALL = lm.MixtureParams()


def _plain(table, texts, params):
    """One text at a time: EM over all its trigrams for each nested set."""
    out = []
    for text in texts:
        _, cells = lm.trigrams([text], params.bits)
        if not len(cells):
            out.append(np.zeros(len(table)))
            continue
        like = table[:, cells].astype(float)
        used, best, chosen = list(range(len(table))), -np.inf, None
        share = np.full(len(table), 1 / len(table))
        while used:
            steps = params.first_steps if len(used) == len(table) else params.later_steps
            if len(used) == 1:
                share = np.eye(len(table))[used[0]]
            else:
                for _ in range(steps):
                    part = share[:, None] * like
                    new = (part / part.sum(0)).mean(1)
                    change, share = np.abs(new - share).max(), new
                    if change < 1e-3:
                        break
                share = np.where(np.isin(np.arange(len(table)), used), np.maximum(share, 1e-9), 0)
                share /= share.sum()
            fit = np.log(share @ like).sum() / lm.GRAM - params.penalty * len(used) * np.log1p(len(cells) / lm.GRAM)
            if fit >= best:
                best, chosen = fit, share.copy()
            weakest = min(used, key=lambda j: share[j])
            used.remove(weakest)
            share[weakest] = 0
            if used:
                share /= share.sum()
        out.append(chosen)
    return np.array(out)


def test_blocks_equal_one_text_at_a_time():
    rng = np.random.default_rng(5)
    table = rng.dirichlet(np.full(1 << SMALL.bits, 0.05), 3).astype(np.float32) + np.float32(1e-9)
    texts = ["".join(rng.choice(list("abcdefgh  "), n)) for n in (3, 40, 400, 0, 7)] + ["123"]
    single = [lm.Mixture(table, SMALL).infer([t])[0] for t in texts]
    assert np.allclose(single, _plain(table, texts, SMALL), atol=1e-6)


def test_a_mixed_text_gets_both_languages():
    a, b = "alba canto dolce " * 40, "xyk wurq zhpt " * 40
    table = np.full((3, 1 << SMALL.bits), 0.5)
    for row, text in zip(table, (a, b, "mno pqr stu " * 40)):
        np.add.at(row, lm.trigrams([text], SMALL.bits)[1], 1)
    table = (table / table.sum(1, keepdims=True)).astype(np.float32)
    shares = lm.Mixture(table, SMALL).infer([a, b, a + b, "12 ?", ""])
    assert (shares[0] > 0).tolist() == [True, False, False]
    assert (shares[2] > 0).tolist() == [True, True, False] and abs(shares[2][0] - 0.5) < 0.2
    assert shares[3].sum() == 0 and shares[4].sum() == 0


def test_a_minority_language_enters_past_its_rivals_relatives():
    rng = np.random.default_rng(3)
    words = lambda letters, n: ["".join(rng.choice(list(letters), 4)) for _ in range(n)]
    major, minor = words("abcdefghijklm", 60), words("αβγδεζηθικ", 60)
    vocabularies = [major] + [major[:50 - i] + words("abcdefghijklm", 10 + i) for i in range(10)] + [minor]
    table = np.full((len(vocabularies), 1 << SMALL.bits), SMALL.smoothing)
    for row, vocabulary in zip(table, vocabularies):
        np.add.at(row, lm.trigrams([" ".join(rng.choice(vocabulary, 4000))], SMALL.bits)[1], 1)
    table = (table / table.sum(1, keepdims=True)).astype(np.float32)
    texts = [" ".join([*rng.choice(major, 140), *rng.choice(minor, 60)]) for _ in range(200)]
    shares = lm.Mixture(table, SMALL).infer(texts)
    single = [lm.Mixture(table, SMALL).infer([t])[0] for t in texts[:5]]
    assert np.allclose(single, _plain(table, texts[:5], SMALL), atol=1e-6)
    assert (shares[:, -1] > 0.2).all() and (shares[:, 0] > 0.5).mean() > 0.9


def test_held_out_accuracy(spark):
    from lendwise.llm import queries
    rows = queries.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    right = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_odd_rows(edge, empty):
    names, table = lm.learn(edge)
    got = lm.identify(edge, names, table).collect()
    assert names == ["en"] and len(got) == edge.count()
    by_id = {r.id: r for r in got if r.id is not None}
    assert {i for i, r in by_id.items() if r.lang_pred == "und"} == {4, 5, 6, 9}
    assert all((r.score == 0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in got)
    assert lm.identify(empty, names, table).count() == 0
    none, nothing = lm.learn(empty)
    assert none == [] and {r.lang_pred for r in lm.identify(edge, none, nothing).collect()} == {"und"}
    kept = lm.keep_identified(edge, names, table, 0.34)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 5


def test_many_languages(spark):
    rng = np.random.default_rng(7)
    vocabulary = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)) for _ in range(12)] for _ in range(300)]
    rows = [(i, " ".join(rng.choice(v, 60)), f"l{i:03d}") for i, v in enumerate(vocabulary)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, table = lm.learn(docs)
    assert len(names) == 300 and table.shape == (300, 1 << SMALL.bits)
    some = docs.where("doc_id % 60 = 7")
    got = {r.id: r for r in lm.identify(some, names, table).collect()}
    assert all(r.lang_pred == f"l{i:03d}" for i, r in got.items()) and len(got) == 5
    text = rows[7][1]
    assert np.allclose(lm.Mixture(table, SMALL).infer([text])[0], _plain(table, [text], SMALL)[0], atol=1e-6)


@pytest.mark.parametrize("size", (1, 5, 64))
def test_pieces_of_a_text_change_nothing(monkeypatch, size):
    rng = np.random.default_rng(size)
    texts = ["".join(rng.choice(list("abÇÉß İ日本1 ,.\n"), n)) for n in (0, 1, 2, 30, 200, 500)] + ["x" * 100, " " * 9]
    whole = [x.tolist() for x in lm.cell_counts(texts, SMALL.bits)]
    grams = sorted(zip(*(x.tolist() for x in lm.trigrams(texts, SMALL.bits))))
    monkeypatch.setattr(lm, "CHARS_AT_ONCE", size)
    assert [x.tolist() for x in lm.cell_counts(texts, SMALL.bits)] == whole
    assert sorted(zip(*(x.tolist() for x in lm.trigrams(texts, SMALL.bits)))) == grams


def test_kept_rows_without_a_language_get_one(spark):
    rows = [(1, "alba canto dolce " * 9, "it"), (2, "xyk wurq zhpt " * 9, "xx"), (3, "canto alba " * 5, None), (4, "12", None), (5, "wurq xyk " * 5, "it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, table = lm.learn(docs)
    kept = lm.keep_identified(docs, names, table, lang_col="lang")
    assert sorted((r.doc_id, r.lang) for r in kept.collect()) == [(1, "it"), (2, "xx"), (3, "it"), (5, "it")]
    assert {r.doc_id: r.lang for r in lm.keep_identified(docs, names, table).collect()}[3] is None
