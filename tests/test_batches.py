"""Lists, dedupe and scores kept up batch by batch equal those over all rows."""

import os

import pytest
from pyspark.sql import functions as F

from lendwise.functions.keys import with_member_key
from lendwise.operators import clean, quarantine
from lendwise.params import Variant
from lendwise.plans import incremental, job
from lendwise.plans.stages import Stages
from lendwise.sources import fixture, io
from lendwise.streaming import ingest, lists
from small_tables import SF_SMALL

VARIANTS = [Variant(), Variant.notebook()]


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _run(query):
    query.awaitTermination(300)
    assert query.exception() is None


@pytest.fixture(scope="module")
def raw(spark):
    return fixture.raw_loans(spark, SF_SMALL).where("cast(id as long) % 4 = 0").cache()


def _streams(spark, root, variant):
    src, out = os.path.join(root, "incoming", "*"), os.path.join(root, "zones")
    _run(ingest.start_split_stream(spark, src, out, checkpoint=os.path.join(root, "c1"),
                                   also=lambda rows, k: lists.write_default_counts(rows, out, k, variant)))
    _run(lists.start_customer_stream(spark, src, out, checkpoint=os.path.join(root, "c2")))
    return out


@pytest.mark.parametrize("variant", VARIANTS, ids=["lib", "notebook"])
def test_lists_after_every_batch(spark, raw, tmp_dir, variant):
    """The third lot repeats the rows of the first; every lot is a run of its
    own, so the state is read back after a restart."""
    lots = [raw.where("cast(id as long) % 3 = 0"), raw.where("cast(id as long) % 3 = 1"), raw.where("cast(id as long) % 3 = 0")]
    for k, lot in enumerate(lots):
        io.write_csv(lot, os.path.join(tmp_dir, "incoming", f"lot{k}"))
        out = _streams(spark, tmp_dir, variant)
        so_far = Stages(with_member_key(job.read_raw_csv(spark, os.path.join(tmp_dir, "incoming", "*"))), variant=variant, raw_is_keyed=True)
        got = lists.duplicate_lists(spark, out)
        want = {"customers": quarantine.dup_members(so_far.customers), "delinq": quarantine.dup_members(so_far.delinq),
                "records": quarantine.dup_members(so_far.records)}
        want["all"] = quarantine.union_distinct(*want.values())
        for name in want:
            assert _bag(got[name]) == _bag(want[name]), (k, name)
        distinct = clean.require(clean.dedupe_rows(clean.rename_strict(so_far.customers_raw, clean.CUSTOMER_RENAMES)), ["annual_income"])
        assert _bag(spark.read.parquet(f"{out}/customers_distinct").drop("batch_id")) == _bag(distinct), k
    # The third lot brought no new customer row.
    assert spark.read.parquet(f"{out}/customers_distinct").where("batch_id = 2").count() == 0


def test_counts_merge(spark, tmp_dir):
    def counts(*rows):
        return spark.createDataFrame(list(rows), "member_id string, n long")
    counts(("a", 1), ("b", 2)).write.parquet(f"{tmp_dir}/counts/delinq/batch_id=0")
    counts(("a", 1), ("c", 1)).write.parquet(f"{tmp_dir}/counts/delinq/batch_id=1")
    compact = lists.compact_counts(spark, tmp_dir, "delinq", f"{tmp_dir}/compact")
    assert _bag(compact) == [("a", 2), ("b", 2), ("c", 1)]
    later = lists.merge_counts(compact, counts(("c", 1), ("d", 1)))
    assert _bag(lists.duplicate_list(later)) == [("a",), ("b",), ("c",)]


def test_digests_tell_rows_apart_like_distinct(spark):
    rows = [(None, "a", 0.0), ("a", None, -0.0), (None, "a", -0.0), ("a", None, float("nan")), ("a", None, float("nan")), ("", "a", 0.0), (None, None, None)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    assert lists.with_row_digest(df).select(lists.DIGEST).distinct().count() == df.distinct().count() == 5


@pytest.mark.parametrize("variant", VARIANTS, ids=["lib", "notebook"])
def test_rescored_members_equal_the_whole_score(spark, raw, tmp_dir, variant):
    """Batches that bring new members, further rows of old ones, and a loan id
    that another member holds already."""
    keyed = with_member_key(raw)
    lots = [keyed.where("cast(id as long) % 3 != 1"), keyed.where("cast(id as long) % 3 = 1")]
    shared = lots[0].orderBy("id").limit(3).withColumns({"emp_title": F.lit("someone else"), "member_id": F.lit("f" * 64)})
    nameless = lots[0].orderBy("id").limit(1).withColumn("id", F.lit(None).cast("string"))
    lots += [shared.unionByName(nameless)]
    so_far = lots[0]
    so_far.write.parquet(f"{tmp_dir}/raw/lot=0")
    stored = io.write_parquet(Stages(so_far, variant=variant, raw_is_keyed=True).loan_score, f"{tmp_dir}/score0")
    for k, lot in enumerate(lots[1:], 1):
        lot.write.parquet(f"{tmp_dir}/raw/lot={k}")
        every = spark.read.parquet(f"{tmp_dir}/raw").drop("lot")
        new = incremental.rescore(every, spark.read.parquet(f"{tmp_dir}/raw/lot={k}"), spark.read.parquet(stored), variant)
        stored = io.write_parquet(new, f"{tmp_dir}/score{k}")
        assert _bag(spark.read.parquet(stored)) == _bag(Stages(every, variant=variant, raw_is_keyed=True).loan_score), k


def test_untouched_members_are_not_scored(spark, raw):
    keyed = with_member_key(raw)
    batch = keyed.orderBy("id").limit(1)
    touched = incremental.touched_members(keyed, batch)
    assert touched.count() == 1
    assert 0 < incremental.rows_for(keyed, touched).count() < keyed.count() / 10
