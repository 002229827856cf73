"""Histogram trees: traversal against a plain walk, fitting, accuracy."""

import numpy as np
from pyspark.sql import functions as F

from lendwise.llm import quality_trees as qt

SF = "/root/testdata/sf0.01"


def _walk(model, row):
    odds = model.start
    inner = model.feature.shape[1]
    for t in range(len(model.feature)):
        at = 0
        while at < inner:
            at = 2 * at + 1 + int(row[model.feature[t, at]] > model.cut[t, at])
        odds += model.leaf[t, at - inner]
    return 1 / (1 + np.exp(-odds))


def test_flat_traversal_equals_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    model = qt.grow(x, y, qt.TreeParams(trees=15))
    assert np.allclose(model.score(x), [_walk(model, r) for r in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_best_cut_equals_trying_all():
    rng = np.random.default_rng(1)
    params = qt.TreeParams(min_rows=3)
    binned, slope, curve = rng.integers(0, 8, (60, 3)), rng.normal(size=60), rng.random(60)
    at = rng.integers(0, 2, 60)
    gain, feature, cut = qt._best_cuts(binned, at, 2, slope, curve, params)
    value = lambda g, h: g * g / (h + params.ridge)
    for node in (0, 1):
        mine, best = at == node, 0.0
        for f in range(3):
            for c in range(8):
                left = mine & (binned[:, f] <= c)
                right = mine & ~left
                if min(left.sum(), right.sum()) >= 3:
                    best = max(best, value(slope[left].sum(), curve[left].sum()) + value(slope[right].sum(), curve[right].sum()) - value(slope[mine].sum(), curve[mine].sum()))
        assert np.isclose(gain[node], best)


def test_statistics_of_plain_texts():
    rows = dict(zip(qt.STATISTICS, qt.statistics(["ab AB 1\nab AB 1\nxx xx", "", "é"])[0]))
    assert np.isclose(rows["dup_lines"], 1 / 3) and np.isclose(rows["distinct_words"], 4 / 8) and np.isclose(rows["repeated_words"], 1 / 8)
    assert np.isclose(sum(v for k, v in rows.items() if k.startswith("share_")), 1)
    assert not qt.statistics([""]).any()


def test_held_out_accuracy(spark):
    from lendwise.llm.queries import op10_quality_classifier
    rows = op10_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    right = F.avg((F.col("quality") == F.col("predicted")).cast("int"))
    assert rows.where("held_out").agg(right).first()[0] > 0.95


def test_held_out_labels_are_not_learned(spark):
    from lendwise.llm.queries import id_remainder
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(id_remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (qt.fit(docs, t.where(id_remainder("doc_id", 5) != 0)) for t in (labels, flipped))
    assert np.array_equal(one.leaf, two.leaf) and np.array_equal(one.cut, two.cut)


def test_sample_bound(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "repeat('ab ', cast(id % 50 as int)) as text")
    labels = spark.range(200).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    seen = []
    grow = qt.grow
    qt.grow = lambda x, y, p: seen.append(len(y)) or grow(x, y, p)
    try:
        qt.fit(docs.union(docs), labels.union(labels), qt.TreeParams(sample=50, trees=2))
    finally:
        qt.grow = grow
    assert seen == [50]


def test_odd_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (None, 1), (7, None), (99, 1), (2, 7)], "doc_id long, quality int")
    model = qt.fit(edge, labels, qt.TreeParams(min_rows=1, trees=3))
    got = qt.classify(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert qt.classify(empty, model).count() == 0
    unlabelled = qt.fit(edge, labels.limit(0))
    assert {r.score for r in qt.classify(edge, unlabelled).collect()} == {0.5}
