"""NOT IN semantics, duplicate lists and the quarantine property."""

from pyspark.sql import functions as F

from lendwise.operators import quarantine


def test_not_in_semantics(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "member_id string")
    bad = spark.createDataFrame([("a",)], "member_id string")
    assert [r[0] for r in quarantine.not_in(df, bad).collect()] == ["b"]
    empty = spark.createDataFrame([], "member_id string")
    assert sorted(r[0] for r in quarantine.not_in(df, empty).collect()) == ["a", "b"]
    with_null = spark.createDataFrame([("a",), (None,)], "member_id string")
    # SQL NOT IN with a null in the list keeps nothing.
    assert quarantine.not_in(df, with_null, list_may_hold_null=True).collect() == []
    df.createOrReplaceTempView("t_probe")
    with_null.createOrReplaceTempView("t_list")
    sql = spark.sql("SELECT * FROM t_probe WHERE member_id NOT IN (SELECT member_id FROM t_list)")
    assert sql.collect() == []


def test_dup_members_and_union(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "member_id string")
    b = spark.createDataFrame([("y",), ("y",), ("x",), ("x",)], "member_id string")
    assert sorted(r[0] for r in quarantine.dup_members(a).collect()) == ["x"]
    u = quarantine.union_distinct(quarantine.dup_members(a), quarantine.dup_members(b))
    assert sorted(r[0] for r in u.collect()) == ["x", "y"]


def test_anti_join_is_not_a_broadcast_nested_loop(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("member_id"))
    bad = spark.range(0, 1000, 7).select(F.col("id").cast("string").alias("member_id"))
    out = quarantine.not_in(df, bad)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == 1000 - len(range(0, 1000, 7))


def test_quarantined_tables_hold_no_bad_member(spark):
    from small_tables import SF_SMALL
    from lendwise.plans.stages import Stages
    s = Stages.from_testdata(spark, SF_SMALL)
    for t in (s.customers_new, s.delinq_new, s.records_new):
        assert t.join(s.bad, "member_id", "left_semi").count() == 0
    # customers_new has one row per member (the fan-out invariant the score relies on)
    assert s.customers_new.groupBy("member_id").count().filter("count > 1").count() == 0


def test_empty_identity_key_can_be_quarantined(spark):
    from lendwise.functions.keys import EMPTY_MEMBER_KEY
    from lendwise.params import Variant
    cust = spark.createDataFrame([(EMPTY_MEMBER_KEY, "a"), ("k1", "b"), ("k2", "c"), ("k2", "d")],
                                 "member_id string, x string")
    empty = spark.createDataFrame([], "member_id string")
    base = {r[0] for r in quarantine.bad_members(cust, empty, empty).collect()}
    strict = {r[0] for r in quarantine.bad_members(cust, empty, empty,
                                                   Variant(quarantine_empty_key=True)).collect()}
    assert base == {"k2"} and strict == {"k2", EMPTY_MEMBER_KEY}
