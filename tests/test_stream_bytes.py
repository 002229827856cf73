"""What the streams keep is compressed, and their ids are shuffled as bytes."""

import os

from pyspark.sql import functions as F

from lendwise.plans import registry
from lendwise.plans.stages import Stages
from lendwise.streaming import lists
from small_tables import SF_SMALL


def _files(root):
    return [f"{at}/{x}" for at, _, files in os.walk(root) for x in files if x.startswith("part-")]


def test_arriving_and_kept_files_are_compressed(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(registry, "scratch_path", lambda _, *parts: "/".join([tmp_dir, *parts]))
    keyed = Stages.from_testdata(spark, SF_SMALL).keyed
    got = registry.QUERIES["stream_dup_members"](spark, SF_SMALL)
    arrived, kept = _files(f"{tmp_dir}/incoming"), _files(f"{tmp_dir}/stream-zones")
    assert arrived and all(x.endswith(".csv.gz") for x in arrived)
    assert kept and all(x.endswith(".zstd.parquet") for x in kept)
    for zone in ("keyed", "customers", "loans", "repayments", "defaulters"):
        assert spark.read.parquet(f"{tmp_dir}/stream-zones/{zone}").count() == keyed.count()
    assert dict(got.dtypes) == {"list": "string", "member_id": "string"}
    assert got.where("list = 'all'").count() == got.select("member_id").distinct().count() > 0


def test_state_keys_are_bytes(spark):
    df = lists.with_row_digest(spark.createDataFrame([("a", 1.0), (None, None)], "x string, y double"))
    assert [len(r[lists.DIGEST]) for r in df.collect()] == [32, 32]


def test_counts_are_shuffled_by_bytes(spark, tmp_dir):
    """Odd ids and rows without one keep their own counts."""
    ids = [None, "", "a", "0123456789abcdef" * 4, "0123456789ABCDEF" * 4, "é"]
    df = spark.createDataFrame([(m, k) for k, m in enumerate(ids * 3 + ids[:2])], "member_id string, k int")
    counts = lists.member_counts(df)
    want = df.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
    for batch in range(2):
        counts.write.parquet(f"{tmp_dir}/counts/delinq/batch_id={batch}")
    every = lists.read_counts(spark, tmp_dir, "delinq")
    for got, times in ((counts, 1), (every, 2), (lists.merge_counts(counts, counts), 2)):
        assert got.dtypes == [("member_id", "string"), ("n", "bigint")]
        assert sorted(got.collect(), key=repr) == sorted(want.withColumn("n", F.col("n") * times).collect(), key=repr)
        assert "unhex" in got._jdf.queryExecution().executedPlan().toString()
