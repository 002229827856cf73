"""The pipeline's stages, each against a brute-force version of itself."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SECRET = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})|AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}""", re.I | re.A)
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_order_and_columns(spark, docs):
    assert list(STAGES) == ["language_id", "near_duplicates", "benchmark_decontamination", "secret_scans", "sentencepiece"]
    for name, stage in list(STAGES.items())[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString(), name


def test_language_stage_keeps_clean_documents(spark, docs):
    odd = spark.createDataFrame([(-1, "12 34 !!", None, None, 8), (-2, "", None, None, 0), (-3, None, None, None, None)], docs.schema)
    kept = {r.doc_id for r in STAGES["language_id"](spark, docs.union(odd), SF).collect()}
    assert not kept & {-1, -2, -3} and len(kept) >= 0.99 * docs.count()


def test_language_stage_keeps_mixtures_and_tables_without_languages(spark, docs):
    alphabets = ("abcdefgh", "αβγδεζηθ", "абвгдежз", "אבגדהוזח")
    texts = [" ".join(a[i:] + a[:i] for i in range(8)) + " " for a in alphabets]
    rows = [(i, t * 40, f"l{i}", "s", 0) for i, t in enumerate(texts)]
    rows += [(10, "".join(texts) * 10, None, "s", 0), (11, "ԱԲԳԴ ԵԶԷԸ", None, "s", 0), (12, "12 34 !!", None, "s", 0), (13, None, None, "s", 0)]
    table = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in STAGES["language_id"](spark, table, SF).collect()} == {0, 1, 2, 3, 10}
    without = table.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    assert {r.doc_id for r in STAGES["language_id"](spark, without, SF).collect()} == {0, 1, 2, 3, 10, 11}


def test_one_of_each_group_stays(spark, docs):
    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    rows = {r.doc_id: grams(r.text) for r in docs.collect()}
    least = {i: i for i in rows}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x
    for i in rows:
        for j in rows:
            if i < j and rows[i] and 100 * len(rows[i] & rows[j]) >= 80 * len(rows[i] | rows[j]):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    kept = {r.doc_id for r in STAGES["near_duplicates"](spark, docs, SF).collect()}
    assert kept == {i for i in rows if find(i) == i}


def test_leaks_go_and_the_rest_stays(spark, docs):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in docs.collect() if any(t in r.text for t in items)}
    planted = spark.createDataFrame([(-1, "before " + items[0].upper() + " after", "en", "s", 1)], docs.schema)
    kept = {r.doc_id for r in STAGES["benchmark_decontamination"](spark, docs.union(planted), SF).collect()}
    assert leaks and kept == {r.doc_id for r in docs.collect()} - leaks


def test_secrets_are_masked(spark, docs):
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in STAGES["secret_scans"](spark, docs, SF).collect()}
    assert after.keys() == before.keys()
    assert all(r.n_chars == len(r.text) for r in after.values())
    changed = {i for i in before if before[i] != after[i].text}
    assert changed == {i for i, t in before.items() if SECRET.search(t)}
    assert not any(SECRET.search(r.text) for r in after.values())


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert rows and all(len(library.decode(r.ids).encode()) == r.n_bytes and r.n_tokens == len(r.ids) for r in rows)


def test_encoding_keeps_the_spans(spark):
    texts = {1: "Hello  wörld, 日本語 😀", 2: "", 3: "one two"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars int")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in STAGES["sentencepiece"](spark, docs, SF).collect():
        raw = texts[r.doc_id].encode()
        assert r.ids == library.encode(texts[r.doc_id]) and len(r.begins) == len(r.ends) == r.n_tokens
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw


def test_empty_table(spark, docs):
    for name, stage in STAGES.items():
        assert stage(spark, docs.limit(0), SF).count() == 0, name


@pytest.fixture(scope="module")
def odd(edge):
    """The odd rows as documents, with columns under names the stages use."""
    secret = "password = abcdefgh123 and more"
    rows = edge.selectExpr("*", "cast('s' as string) as source", "cast(length(text) as long) as n_chars")
    more = rows.where("doc_id = 11").withColumn("text", F.lit(secret)).withColumn("doc_id", F.lit(12).cast("long"))
    return rows.withColumn("lang", F.when(F.col("doc_id") != 7, F.col("lang"))).unionByName(more).unionByName(more)


def _ids(df):
    return sorted((-1 if r.doc_id is None else r.doc_id) for r in df.collect())


def test_odd_rows_in_every_stage(spark, odd):
    every = _ids(odd)
    out = {name: stage(spark, odd, SF) for name, stage in STAGES.items()}
    for name, df in list(out.items())[:-1]:
        assert df.columns == odd.columns, name
    # No letters: 4 (empty), 5 (null), 6 (blank), 9 (digits and signs), and a null text without an id.
    assert _ids(out["language_id"]) == sorted([i for i in every if i not in (4, 5, 6, 9, -1)] + [-1])
    assert {r.lang for r in out["language_id"].collect()} == {"en"}
    # 2 and 3 are 1 again, 12 comes twice; null ids and texts without words stay.
    assert _ids(out["near_duplicates"]) == sorted([i for i in set(every) if i not in (2, 3, -1)] + [-1, -1])
    assert _ids(out["benchmark_decontamination"]) == every
    masked = out["secret_scans"].collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in masked) == every
    assert all("abcdefgh123" not in (r.text or "") and r.n_chars == (None if r.text is None else len(r.text)) for r in masked)
    assert sum("[SECRET]" in (r.text or "") for r in masked) == 2 and sum(r.text is None for r in masked) == 2
    encoded = out["sentencepiece"].collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in encoded) == every
    assert all(r.n_tokens == len(r.ids) == len(r.begins) for r in encoded)


def test_edited_leaks_go_too(spark, docs):
    """Decontamination against plain alignment: passages with a few edits."""
    import random
    rng = random.Random(1)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:6]

    def edited(text, n):
        chars = list(text)
        for i in rng.sample(range(len(chars)), n):
            chars[i] = "#"
        return "".join(chars)
    rows = [(i, "before " + edited(t, len(t) // 20) + " after", "en", "s", 1) for i, t in enumerate(items)]
    rows += [(100 + i, "before " + edited(t, len(t) // 3) + " after", "en", "s", 1) for i, t in enumerate(items)]
    planted = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in STAGES["benchmark_decontamination"](spark, planted, SF).collect()}
    assert kept == {100 + i for i in range(len(items))}
