"""Quality rules: base statistics and distances against plain Python."""

import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendwise.llm import divergence as dv

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), len(lines) - len(set(lines)), len(covered))


def _classes(text):
    kinds = Counter()
    for c in text:
        kinds[0 if c in " \t\n\x0b\x0c\r" else 1 if c in "#*$%&|<>" else 2 if unicodedata.category(c) == "Lu" else 3 if c in "0123456789"
              else 4 if unicodedata.category(c)[0] == "P" or c in "^~`+=" else 5] += 1
    return [kinds[i] for i in range(6)]


def test_base_statistics(docs_of):
    rng = random.Random(8)
    words = ["the", "The", "a,", "cat", "#1", "x|y", "É", "日本", "b!", "$", "=", "@x", "~", "<p>"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t ", "\n\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
             for _ in range(150)] + ["x y z " * 500, " ".join(f"p{i} q{i} r{i} p{i} q{i} r{i}" for i in range(60)), None, "", "\n \n", " a"]
    got = {r.id: r for r in dv.base_statistics(docs_of(texts).withColumn("lang", F.lit("en"))).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(text), text
        assert list(r.classes) == _classes(text or ""), text


def test_js_distance(spark):
    rows = spark.createDataFrame([([0.5, 0.5, 0.0], [0.5, 0.5, 0.0]), ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0]),
                                  ([0.2, 0.3, 0.5], [0.1, 0.6, 0.3]), (None, [1.0, 0.0, 0.0])], "p array<double>, q array<double>")
    got = [r.d for r in rows.select(dv.js_distance(F.col("p"), F.col("q")).alias("d")).collect()]
    p, q = (0.2, 0.3, 0.5), (0.1, 0.6, 0.3)
    plain = sum(a * math.log2(2 * a / (a + b)) + b * math.log2(2 * b / (a + b)) for a, b in zip(p, q)) / 2
    assert got[0] == 0 and got[1] == 1 and abs(got[2] - math.sqrt(plain)) < 1e-12 and got[3] is None


def test_common_words_are_the_exact_top(spark, docs_of):
    rng = random.Random(2)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.15)), 400)}" for _ in range(200)) for _ in range(40)]
    docs = docs_of(texts).withColumn("lang", F.lit("xx"))
    limits = dv.Limits(common_words=8, tracked=256)
    proposed = dv.common_words(docs, limits, "text", "lang")
    counted = dv.document_counts(docs, proposed, limits, "doc_id", "text", "lang")
    ref = dv.references(counted, proposed, limits).first()
    every = Counter(w for t in texts for w in t.split())
    top = sorted(every, key=lambda w: (-every[w], w))[:8]
    words = proposed.first().words
    assert [words[i] for i in ref.ref_words] == top
    assert ref.ref_common[:8] == pytest.approx([every[w] / sum(every.values()) for w in top])
    assert sum(ref.ref_common) == pytest.approx(1) and sum(ref.ref_classes) == pytest.approx(1)


def test_flat_languages_are_counted_exactly(spark, docs_of):
    """Words used alike: the sketch cannot tell the commonest, the counts can."""
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(2000)]
    flat = [" ".join(rng.choice(pool) for _ in range(300)) for _ in range(40)]
    steep = [" ".join(f"v{min(int(rng.expovariate(0.4)), 400)}" for _ in range(300)) for _ in range(40)]
    docs = docs_of(flat).withColumn("lang", F.lit("flat")).unionByName(docs_of(steep, 100).withColumn("lang", F.lit("steep")))
    limits = dv.Limits(common_words=8, tracked=256)
    proposed = dv.common_words(docs, limits, "text", "lang")
    counted = dv.document_counts(docs, proposed, limits, "doc_id", "text", "lang")
    refs = {r.lang: r for r in dv.references(counted, proposed, limits).collect()}
    words = {r.lang: r.words for r in proposed.collect()}
    for lang, texts in (("flat", flat), ("steep", steep)):
        every = Counter(w for t in texts for w in t.split())
        assert [words[lang][i] for i in refs[lang].ref_words] == sorted(every, key=lambda w: (-every[w], w))[:8]
    assert len(words["flat"]) == len(words["steep"]) == 8  # both counted


def test_junk_goes_and_prose_stays(spark):
    from lendwise.llm import queries
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    good = rows.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = rows.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.99 and bad < 0.25


def test_odd_rows(edge, empty):
    got = dv.quality_rules(edge).collect()
    assert len(got) == edge.count()
    for r in got:
        if r.id in (4, 5, 6):
            assert r.n_words == 0 and r.base_failed and not r.kept and r.class_distance is None
    none = edge.withColumn("lang", F.lit(None).cast("string"))
    assert dv.quality_rules(none).count() == edge.count()
    assert dv.quality_rules(empty).count() == 0
