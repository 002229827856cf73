"""Extendible hashing: limits, plain splitting, hot and repeated rows."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lendwise.llm import sharding as sh


def _plain(rows, limit):
    """Buckets by splitting a list: {bits: rows}."""
    def split(bits, part):
        if sum(n for _, n in part) <= limit or len({h for h, _ in part}) == 1:
            return {bits: part} if part else {}
        d = len(bits)
        out = {}
        for b in "01":
            out |= split(bits + b, [x for x in part if (x[0] >> (59 - d)) & 1 == int(b)])
        return out
    return split("", rows)


def _hash(i, text):
    return int(hashlib.md5(f"{'' if i is None else i}|{text or ''}".encode()).hexdigest()[:15], 16)


def test_equals_plain_splitting(docs_of):
    texts = ["x" * (i * 37 % 900) for i in range(400)] + ["big" * 2000, "", None]
    got = sh.assign_shards(docs_of(texts), 3000).collect()
    plain = _plain([(_hash(i, t), len(t or "")) for i, t in enumerate(texts)], 3000)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    assert {s: sum(r.n_bytes for r in rows) for s, rows in by_shard.items()} == {b: sum(n for _, n in p) for b, p in plain.items()}
    for rows in by_shard.values():
        assert rows[0].shard_rows == len(rows) and rows[0].shard_bytes == sum(r.n_bytes for r in rows)
        assert rows[0].shard_bytes <= 3000 or len(rows) == 1
    assert len({r.depth for r in got}) > 1  # only oversized buckets split


def test_hot_repeated_row_is_paged(spark):
    rows = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("y" * 100).alias("text"))
    got = sh.assign_shards(rows, 1000).collect()
    pages = defaultdict(int)
    for r in got:
        assert r.shard_bytes <= 1000
        pages[r.shard, r.page] += r.n_bytes
    assert len(got) == 5000 and len(pages) == 500 and set(pages.values()) == {1000}


def test_odd_rows(edge, empty):
    got = sh.assign_shards(edge, 500).collect()
    assert len(got) == edge.count()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard, r.page] += r.n_bytes
        assert r.shard_bytes <= 500 or r.shard_rows == 1
    assert sum(sizes.values()) == sum(len((r.text or "").encode()) for r in edge.collect())
    assert sh.assign_shards(empty, 500).count() == 0
    assert {r.shard for r in sh.assign_shards(edge, 1 << 40).collect()} == {""}


def test_written_shards(spark, docs_of, tmp_dir):
    docs = docs_of(["a" * 50] * 40)
    sh.write_shards(docs, sh.assign_shards(docs, 400), f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == 40 and back.groupBy("shard_page").agg(F.sum(F.length("text")).alias("b")).where("b > 400").isEmpty()


def test_written_shards_multiply_no_row(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "doc_id long, text string").withColumn("__id", F.lit("x"))
    sh.write_shards(rows, sh.assign_shards(rows, 1), f"{tmp_dir}/odd")
    back = spark.read.parquet(f"{tmp_dir}/odd")
    assert sorted((r.text, r.doc_id) for r in back.collect()) == [("a", 1), ("b", None), ("c", 2)]
    twice = rows.unionByName(rows)
    with pytest.raises(ValueError, match="ids repeat"):
        sh.write_shards(twice, sh.assign_shards(twice, 1), f"{tmp_dir}/twice")
