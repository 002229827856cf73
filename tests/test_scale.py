"""Scale behaviour on hand-made skew and with broadcasts disabled."""

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from lendwise.plans.stages import Stages
from lendwise.sources import fixture


def _hot_member_raw(spark, n_hot: int, n_other: int):
    """Raw rows where one member (identical key attributes) owns ``n_hot`` loans."""
    usable = ("loan_amnt is not null and last_pymnt_amnt is not null and total_rec_prncp is not null "
              "and annual_inc is not null and purpose is not null and delinq_2yrs > 0")
    base = fixture.raw_loans(spark, SF_SMALL).where(usable).orderBy(F.col("id").cast("long")).limit(1)
    copies = F.explode(F.sequence(F.lit(0), F.lit(n_hot - 1))).alias("copy")
    hot = (base.select("*", copies)
               .withColumn("id", F.concat(F.lit("h"), F.col("copy").cast("string"))).drop("copy"))
    other = fixture.raw_loans(spark, SF_SMALL).orderBy(F.col("id").cast("long")).limit(n_other)
    cols = other.columns
    return hot.select(*cols).unionByName(other)


def test_hot_member_fanout_stays_bounded(spark):
    # One member with 3,000 loans: the reference fan-out would hold 3000^4 = 8.1e13
    # rows for that member alone; the weighted score keeps it to a few rows.
    n = 3000
    raw = _hot_member_raw(spark, n, 3000)
    s = Stages(raw)
    hot_key = s.keyed.filter(F.col("id") == "h0").select("member_id").first()[0]
    ls = s.loan_score.filter(F.col("member_id") == hot_key)
    rows = ls.collect()
    assert 0 < len(rows) <= 24 * 144 * 30
    total = sum(r.n_rows for r in rows)
    # every fan-out factor of the hot member, counted directly
    n_pay = s.payment_history.filter(F.col("member_id") == hot_key).count()
    n_del = s.delinq_new.filter(F.col("member_id") == hot_key).count()
    n_rec = s.records_new.filter(F.col("member_id") == hot_key).count()
    n_loans = s.loans.filter(F.col("member_id") == hot_key).count()
    assert total == n_pay * n_del * n_rec * n_loans > n ** 3


def test_results_equal_without_broadcast(spark):
    s = Stages.from_testdata(spark, SF_SMALL)
    with_bc = sorted(tuple(r) for r in s.loan_score.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        s2 = Stages.from_testdata(spark, SF_SMALL)
        df = s2.loan_score
        no_bc = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    assert with_bc == no_bc


def test_scans_are_pruned_and_filters_pushed(spark):
    s = Stages.from_testdata(spark, SF_SMALL)
    n_raw = len(s.keyed.columns)
    for df in (s.payment_history, s.loan_score, s.consolidated):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
        assert scans
        for line in scans:
            schema = line.split("ReadSchema: struct<")[1].split(">")[0]
            assert schema.count(":") < n_raw  # never the whole raw relation
            assert "PushedFilters: [IsNotNull(" in line or "PushedFilters: []" in line
    # the repayments branch reads only repayment columns
    plan = s.payment_history._jdf.queryExecution().executedPlan().toString()
    rep = [l for l in plan.splitlines() if "FileScan parquet" in l and "total_rec_prncp" in l]
    assert rep and all("emp_title" not in l for l in rep)


def test_multiplicities_are_exact_beyond_a_long(spark):
    """3e8 rows of one member in each of four factors: 8.1e33 joined rows."""
    from lendwise.operators import score
    n = 300_000_000
    factor = lambda name: spark.createDataFrame([("m", n)], "member_id string, n_rows long").withColumn(name, F.lit(1))
    rows = factor("a")
    for name in "bcd":
        rows = score._product_join(rows, factor(name))
    assert [int(r.n_rows) for r in rows.collect()] == [n ** 4]
    halves = rows.unionByName(rows).groupBy("member_id").agg(F.sum("n_rows").cast(score.MULTIPLICITY).alias("n_rows"))
    assert int(halves.first().n_rows) == 2 * n ** 4


def test_equal_counts_sort_in_many_partitions(spark):
    from pyspark.sql.functions import spark_partition_id
    from lendwise.operators.quarantine import member_multiplicity
    members = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("member_id"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in member_multiplicity(members).groupBy(spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) > 4 and max(sizes) < 100_000


def test_orders_are_shuffled_once_per_join_key(spark):
    """Without broadcasts: orders once by order key, then by customer, then
    by nation; no shuffle is thrown away by the next."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture.raw_loans(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [x for x in plan.splitlines() if "Exchange " in x]
    assert sum("o_orderkey" in x for x in exchanges) == 1
    assert sum("o_custkey" in x for x in exchanges) == 1 and sum("c_nationkey" in x for x in exchanges) == 1


def test_rewritten_input_is_staged_again(spark, tmp_dir):
    from lendwise.plans.stages import SOURCE_TABLES, stage_keyed_raw
    for t in SOURCE_TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_dir}/in/{t}.parquet")
    first = stage_keyed_raw(spark, f"{tmp_dir}/in").count()
    assert stage_keyed_raw(spark, f"{tmp_dir}/in").inputFiles() == stage_keyed_raw(spark, f"{tmp_dir}/in").inputFiles()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").limit(10)
    orders.write.mode("overwrite").parquet(f"{tmp_dir}/in/orders.parquet")
    assert stage_keyed_raw(spark, f"{tmp_dir}/in").count() == 10 < first


def test_no_database_is_left_behind(spark):
    from lendwise.plans import registry
    before = {d.name for d in spark.catalog.listDatabases()}
    for key in ("scan_table", "sink_managed_table", "external_table", "catalog_admin", "persistent_view"):
        assert registry.QUERIES[key](spark, SF_SMALL).count() > 0
    assert {d.name for d in spark.catalog.listDatabases()} == before
    assert spark.catalog.currentDatabase() == "default"
