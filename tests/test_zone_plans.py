"""Plans and metadata of the zones: one shuffle of customers, no shuffle of bucketed loans, observed checks, statistics."""

import uuid

import pytest
from pyspark.sql import functions as F

from lendwise import schemas
from lendwise.operators import audit, quarantine, score
from lendwise.plans.stages import Stages
from lendwise.sources import io
from small_tables import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark):
    return Stages.from_testdata(spark, SF_SMALL)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in zip(keys, before):
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    """The plan before adaptive changes, whether it has run or not."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.partition("== Initial Plan ==")[2] or plan


def test_single_rows_equal_the_anti_join(spark, no_broadcast):
    rows = [("a", 1, None), ("b", 2, "x"), ("b", 2, "x"), ("c", None, None), (None, 3, "y"), ("d", 4, "z"), ("d", 5, None)]
    df = spark.createDataFrame(rows, "member_id string, n int, t string")
    got = quarantine.single_rows(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        map(tuple, quarantine.not_in(df, quarantine.dup_members(df)).collect()), key=repr)
    assert _plan(got).count("Exchange") == 1 and "Join" not in _plan(got)


def test_customers_are_shuffled_once_for_the_quarantine(spark, stages, no_broadcast, tmp_dir):
    customers = spark.read.parquet(io.write_parquet(stages.customers, tmp_dir + "/customers"))
    new, _, _ = quarantine.quarantine(customers, stages.delinq, stages.records, stages.bad)
    assert _plan(new).count("Exchange") == 1
    # Columns that a query does not read are not carried.
    assert "emp_title" not in _plan(new.select("member_id", "grade")).split("ReadSchema")[1]


def test_hot_member_is_one_row_a_task(spark):
    hot = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("member_id"),
                                      F.col("id").alias("n"))
    assert quarantine.single_rows(hot).count() == 200_000 - len(range(0, 200_000, 3))


def test_bucketed_loans_join_without_a_shuffle(spark, stages, no_broadcast, tmp_dir):
    db = "lendwise_bucket_test"
    io.create_database(spark, db, tmp_dir + "/db")
    try:
        loans, repayments = (spark.table(io.save_bucketed(df, f"{db}.{name}", f"{tmp_dir}/{name}", "loan_id", 4))
                             for name, df in (("loans", stages.loans), ("repayments", stages.repayments)))
        points = score.payment_points(loans, repayments)
        assert "Exchange" not in _plan(points) and "SortMergeJoin" in _plan(points)
        want = score.payment_points(stages.loans, stages.repayments)
        assert points.exceptAll(want).isEmpty() and points.count() == want.count() > 0
        # One file a bucket.
        assert len(loans.inputFiles()) <= 4
    finally:
        io.drop_database(spark, db)


def _jobs(spark, run):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "")
    run()
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_observed_checks_take_no_job(spark, stages, tmp_dir):
    customers = spark.read.parquet(io.write_parquet(stages.customers, tmp_dir + "/customers"))
    observed = audit.Observed()
    plain = _jobs(spark, lambda: io.write_parquet(customers, tmp_dir + "/plain"))
    watched = _jobs(spark, lambda: io.write_parquet(observed.watch(customers, audit.row_check("c") | audit.null_checks()["customers_clean"]),
                                                    tmp_dir + "/watched"))
    assert watched == plain
    assert observed.counts() == {"rows_c": customers.count(), "emp_length_null_clean": customers.where("emp_length is null").count()}
    assert observed.table(spark).count() == 2


def test_observed_checks_of_an_empty_table(spark, stages, tmp_dir):
    observed = audit.Observed()
    io.write_parquet(observed.watch(stages.customers.limit(0), audit.row_check("c")), tmp_dir + "/none")
    assert observed.counts() == {"rows_c": 0}


def test_statistics_order_the_joins(spark, stages, tmp_dir, no_broadcast):
    """Loans join many delinquency rows and few customers: once the catalog
    knows the sizes, the small join comes first."""
    db = "lendwise_statistics_test"
    io.create_database(spark, db, tmp_dir + "/db")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    spark.conf.set("spark.sql.cbo.joinReorder.enabled", "true")
    try:
        few = stages.customers_new.orderBy("member_id").limit(5)
        for name, df, ddl in (("loans", stages.loans, schemas.LOANS_TABLE), ("delinq", stages.delinq, schemas.DELINQ_TABLE),
                              ("few", few, schemas.CUSTOMERS_TABLE)):
            io.external_table(spark, f"{db}.{name}", ddl, io.write_default(df, f"{tmp_dir}/{name}"))
        sql = (f"SELECT l.loan_id, d.delinq_2yrs, c.grade FROM {db}.loans l JOIN {db}.delinq d ON d.member_id = l.member_id "
               f"JOIN {db}.few c ON c.member_id = l.member_id")

        def innermost():
            plan = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString().splitlines()
            depth = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan if "Relation" in line]
            deepest = max(d for d, _ in depth)
            return {line.split("Relation ")[1].split("[")[0].split(".")[-1] for d, line in depth if d == deepest}

        assert innermost() == {"loans", "delinq"}
        assert io.table_statistics(spark, f"{db}.loans", ("member_id",)) == {}
        for name in ("loans", "delinq", "few"):
            io.analyze_table(spark, f"{db}.{name}", ("member_id",))
        assert "few" in innermost()
        assert io.table_statistics(spark, f"{db}.few", ("member_id",)) == {"rows": 5, "member_id": 0}
    finally:
        for k in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
            spark.conf.unset(k)
        io.drop_database(spark, db)
