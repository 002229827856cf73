"""Member ids go through shuffles as bytes; whole rows are not computed again for each table."""

import os

from pyspark.sql import functions as F

from lendwise.functions.keys import pack, unpack
from lendwise.operators import quarantine
from lendwise.params import Variant
from lendwise.plans import incremental, registry
from lendwise.plans.stages import Stages
from lendwise.sources import io
from small_tables import SF_SMALL

# The last of the columns that whole customer rows are compared by.
WHOLE_ROW = "join_annual_income"


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "hashpartitioning" in x]


def test_packed_ids_come_back_and_stay_apart(spark):
    digest = "0123456789abcdef" * 4
    ids = [None, "", "a", "1", "01", digest, digest.upper(), digest[:63], digest + "0", "g" * 64, "é" * 64, bytes(range(32)).hex(), "\x01" + "a" * 32]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "member_id string, n int")
    packed = pack(df)
    assert dict(packed.dtypes)["member_id"] == "binary" and packed.columns == df.columns
    assert sorted(map(tuple, unpack(packed).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert packed.select("member_id").distinct().count() == len(ids)
    assert packed.where(F.length("member_id") == 33).count() >= 2
    # Nothing to do twice, and nothing for other ids.
    assert pack(packed).dtypes == packed.dtypes and unpack(df).dtypes == df.dtypes
    assert pack(spark.range(1).withColumnRenamed("id", "member_id")).dtypes == [("member_id", "bigint")]


def test_packed_stages_give_the_same_rows(spark):
    keyed = Stages.from_testdata(spark, SF_SMALL).keyed
    for variant in (Variant(), Variant(quarantine_empty_key=True)):
        # Rows without identity: the empty key.
        rows = keyed.withColumn("member_id", F.when(F.col("id").cast("long") % 50 == 1, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("member_id")))
        plain, packed = (Stages(df, variant=variant, raw_is_keyed=True) for df in (rows, pack(rows)))
        for got, want in ((packed.loan_score, plain.loan_score), (packed.customers_new.drop("ingest_date"), plain.customers_new.drop("ingest_date"))):
            assert dict(got.dtypes)["member_id"] == "binary"
            got = unpack(got)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_the_job_writes_the_raw_rows_once(spark, monkeypatch):
    def staged(*_):
        raise AssertionError("another copy of the raw rows")
    monkeypatch.setattr(registry, "staged_path", staged)
    for key in ("audit_observed", "published_score"):
        assert registry.QUERIES[key](spark, SF_SMALL).count() > 0


def test_tables_are_written_with_zstd(spark, tmp_dir):
    rows = spark.createDataFrame([("m",)], "member_id string")
    for k, write in enumerate((io.write_parquet, io.write_default, io.write_new)):
        write(rows, f"{tmp_dir}/{k}")
        assert any(x.endswith(".zstd.parquet") for x in os.listdir(f"{tmp_dir}/{k}"))


def test_rescored_ids_are_joined_as_bytes(spark, tmp_dir):
    keyed = Stages.from_testdata(spark, SF_SMALL).keyed
    batch = keyed.where("cast(id as long) % 20 = 0")
    stored = io.write_parquet(unpack(Stages(pack(keyed.exceptAll(batch)), raw_is_keyed=True).loan_score), f"{tmp_dir}/score")
    new = incremental.rescore(keyed, batch, spark.read.parquet(stored))
    assert "unhex" in new._jdf.queryExecution().executedPlan().toString()
    want = Stages(keyed, raw_is_keyed=True).loan_score
    assert new.dtypes == want.dtypes and new.exceptAll(want).isEmpty() and want.exceptAll(new).isEmpty()


def test_views_read_customers_that_are_distinct_already(spark):
    for key in ("consolidated_view", "consolidated_view_slim"):
        df = registry.QUERIES[key](spark, SF_SMALL)
        assert "unhex" in df._jdf.queryExecution().executedPlan().toString()
        assert not any(WHOLE_ROW in x and "emp_title" in x for x in _exchanges(df))


def test_catalog_tables_share_customers_and_list(spark, monkeypatch):
    written, write = [], io.write_default

    def watched(df, *rest):
        written.append([x for x in _exchanges(df) if WHOLE_ROW in x and "emp_title" in x and "any_value" not in x])
        return write(df, *rest)
    monkeypatch.setattr(io, "write_default", watched)
    assert registry.QUERIES["catalog_admin"](spark, SF_SMALL).count() == 3
    assert len(written) == 4 and not any(written)


def test_persistent_view_joins_packed_ids(spark):
    for key in ("persistent_view", "persistent_view_slim"):
        df = registry.QUERIES[key](spark, SF_SMALL)
        assert dict(df.dtypes)["member_id"] == "string"
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("unhex") >= 4


def test_packed_quarantine_equals_the_plain_one(spark):
    rows = [("a", 1), ("b", 2), ("b", 2), (None, 3), ("d", 4), ("d", 5)]
    df = spark.createDataFrame(rows, "member_id string, n int")
    plain = quarantine.quarantine(df, df, df, quarantine.bad_members(df, df, df))
    packed = pack(df)
    for got, want in zip(quarantine.quarantine(packed, packed, packed, quarantine.bad_members(packed, packed, packed)), plain):
        assert sorted(map(tuple, unpack(got).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
