"""Versions behind a pointer: what a run that dies leaves, what readers see, what goes."""

import os

import pytest
from pyspark.sql import functions as F

from lendwise.plans import job
from lendwise.sources import fixture
from lendwise.sources.published import Published
from small_tables import SF_SMALL


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pointers_and_versions(spark, tmp_dir):
    p = Published(spark, tmp_dir + "/zones")
    assert p.current() is None and p.versions() == [] and p.draft() is None
    with pytest.raises(FileNotFoundError):
        p.current_path()
    first = p.begin()
    assert p.draft() == first and p.current() is None
    spark.range(3).write.parquet(p.path(first) + "/t")
    p.publish(first)
    assert p.current() == first and p.draft() is None
    second = p.begin()
    assert p.current() == first and p.versions() == [first, second]
    with pytest.raises(FileNotFoundError):
        p.publish("v999999-00000000")
    assert p.current() == first
    p.publish(second)
    assert Published(spark, tmp_dir + "/zones").current_path().endswith(second)


def test_prune_keeps_what_is_read_and_written(spark, tmp_dir):
    p = Published(spark, tmp_dir + "/zones")
    made = [p.publish(p.begin()) and p.current() for _ in range(4)]
    dead = p.begin()  # a run that never ended
    last = p.begin()
    assert p.prune(keep=2) == made[:2] and p.versions() == [*made[2:], dead, last]
    p.publish(last)
    assert p.prune(keep=1) == [*made[2:], dead] and p.versions() == [last]


def test_a_run_that_dies_leaves_the_published_version(spark, tmp_dir):
    root = tmp_dir + "/job"
    raw = fixture.raw_loans(spark, SF_SMALL)
    done = job.run(spark, raw, root=root, database="lendwise_published_test")
    before = _bag(job.read_zone(spark, root, "gold/loan_score"))
    # Dies while a zone is being written: some of its rows are, some are not.
    dying = raw.withColumn("purpose", F.when(F.col("id").cast("long") % 97 == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("purpose")))
    with pytest.raises(Exception, match="lost"):
        job.run(spark, dying, root=root, database="lendwise_published_test")
    p = Published(spark, root)
    assert p.current() == done.version and p.draft() not in (None, done.version)
    assert _bag(job.read_zone(spark, root, "gold/loan_score")) == before
    assert _bag(spark.table("lendwise_published_test.loan_score")) == before
    # The next run starts afresh and replaces the pointer.
    again = job.run(spark, raw.where("id % 2 = 0"), root=root, keep=1)
    assert p.current() == again.version and p.versions() == [again.version]
    assert _bag(job.read_zone(spark, root, "gold/loan_score")) != before


def test_stages_go_on_with_the_draft(spark, tmp_dir, monkeypatch, capsys):
    root = tmp_dir + "/cli"
    monkeypatch.setattr(job, "SparkSession", type("S", (), {"builder": _Builder(spark)}))
    for stage in ("split", "clean", "quarantine", "score"):
        job.main(["--stage", stage, "--root", root, "--testdata", SF_SMALL])
        assert Published(spark, root).current() is None
    job.main(["--stage", "publish", "--root", root])
    path = Published(spark, root).current_path()
    assert capsys.readouterr().out.split()[-1] == path
    assert os.path.isdir(path + "/gold/loan_score") and os.path.isdir(path + "/audit/checks")


class _Builder:
    def __init__(self, session):
        self.session = session

    def appName(self, _):
        return self

    def config(self, *_):
        return self

    def getOrCreate(self):
        return self.session
