"""CSV reader modes, save modes and catalog registration."""

import os

import pytest
from pyspark.sql.utils import AnalysisException

from lendwise import schemas
from lendwise.sources import io


def _write_text(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)
    return path


def test_header_read_as_data(spark, tmp_dir):
    p = _write_text(os.path.join(tmp_dir, "d"), "member_id,delinq_2yrs\nm1,2.0\n")
    rows = io.read_csv_headerless(spark, p, "member_id string, delinq_2yrs float").collect()
    assert [tuple(r) for r in rows] == [("member_id", None), ("m1", 2.0)]


def test_permissive_nulls_malformed_and_failfast_raises(spark, tmp_dir):
    p = _write_text(os.path.join(tmp_dir, "r"), "loan_id,amount\n1,abc\n2,3.5\n")
    rows = io.read_csv_schema(spark, p, "loan_id string, amount float").collect()
    assert [tuple(r) for r in rows] == [("1", None), ("2", 3.5)]
    with pytest.raises(Exception):
        io.read_csv_schema(spark, p, "loan_id string, amount float", mode="FAILFAST").collect()


def test_errorifexists_and_default_format(spark, tmp_dir):
    df = spark.createDataFrame([("a",)], "member_id string")
    path = os.path.join(tmp_dir, "once")
    io.write_new(df, path)
    with pytest.raises(AnalysisException):
        io.write_new(df, path)
    assert io.read_default(spark, path).count() == 1  # default source is parquet
    assert any(f.endswith(".parquet") for f in os.listdir(path))


def test_single_file_csv(spark, tmp_dir):
    df = spark.range(100).repartition(4)
    path = io.write_csv(df, os.path.join(tmp_dir, "one"), single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert io.read_csv_inferred(spark, path).count() == 100


def test_catalog_admin(spark, tmp_dir):
    db = "lendwise_test_catalog"
    io.create_database(spark, db, os.path.join(tmp_dir, "db"))
    df = spark.createDataFrame([("m", 1, 2, 3)], schemas.RECORDS_TABLE)
    loc = io.write_default(df, os.path.join(tmp_dir, "rec"))
    io.external_table(spark, f"{db}.rec", schemas.RECORDS_TABLE, loc)
    io.external_table(spark, f"{db}.rec", schemas.RECORDS_TABLE, loc)  # idempotent
    io.save_table(df, f"{db}.managed")
    assert io.list_tables(spark, db) == ["managed", "rec"]
    io.drop_table(spark, f"{db}.managed")
    assert io.list_tables(spark, db) == ["rec"]
    view = io.persistent_view(spark, f"{db}.v", f"SELECT member_id, pub_rec FROM {db}.rec")
    io.persistent_view(spark, f"{db}.v", f"SELECT member_id, pub_rec FROM {db}.rec")  # or replace
    assert [tuple(r) for r in spark.table(view).collect()] == [("m", 1)]
