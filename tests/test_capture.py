"""Malformed CSV lines: set aside with their file, counted, and fatal to FAILFAST."""

import os

import pytest

from lendwise.sources import io

DDL = "loan_id string, amount float, late int"
FILES = {"a.csv": "loan_id,amount,late\n1,1.5,0\n2,abc,1\n3,2.5\n,4.0,2\n",
         "b.csv": "loan_id,amount,late\n5,1.0,0,surplus\n6,,\n",
         "c.csv": "loan_id,amount,late\n7,7.0,7\n", "d.csv": "loan_id,amount,late\n"}


@pytest.fixture
def source(tmp_dir):
    for name, text in FILES.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    return tmp_dir


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lines_are_set_aside(spark, source):
    got = io.read_csv_captured(spark, source, DDL)
    assert _bag(got.good) == sorted([("1", 1.5, 0), (None, 4.0, 2), ("6", None, None), ("7", 7.0, 7)], key=repr)
    assert _bag(got.lenient) == sorted([("1", 1.5, 0), ("2", None, 1), ("3", 2.5, None), (None, 4.0, 2), ("5", 1.0, 0),
                                        ("6", None, None), ("7", 7.0, 7)], key=repr)
    bad = {(os.path.basename(r.source), r.line, r.loan_id) for r in got.bad.collect()}
    assert bad == {("a.csv", "2,abc,1", "2"), ("a.csv", "3,2.5", "3"), ("b.csv", "5,1.0,0,surplus", "5")}
    counts = {os.path.basename(r.source): (r.n_rows, r.n_bad, r.n_without_key) for r in got.counts.collect()}
    assert counts == {"a.csv": (4, 2, 1), "b.csv": (2, 1, 0), "c.csv": (1, 0, 0)}


def test_what_is_malformed_does_not_depend_on_the_columns_read(spark, source):
    got = io.read_csv_captured(spark, source, DDL)
    assert got.bad.select("line").count() == got.bad.select("loan_id").count() == 3
    assert got.good.select("loan_id").count() == 4


def test_failfast(spark, source):
    assert io.raises_on_malformed(spark, source, DDL)
    assert not io.raises_on_malformed(spark, os.path.join(source, "c.csv"), DDL)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        io.raises_on_malformed(spark, os.path.join(source, "none.csv"), DDL)
