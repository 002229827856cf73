"""The batch job: every zone materialised once, lineage cut between zones.

Zones (all in one version folder under the root, which by default is a fresh
folder under ``spark.checkpoint.dir``):

    bronze/keyed_raw         raw rows + member key (one scan of the source)
    raw/{customers,loans,repayments,defaulters}   the four splits
    cleaned/{customers,loans,repayments,delinq,records,record_members}
    gold/{bad_customer_data,customers_new,delinq_new,records_new}
    gold/payment_points      loans joined with repayments, rated, once for both scores
    gold/loan_score          weighted reference-grain score
    gold/loan_score_by_loan  one score per loan
    audit/checks             null, sentinel and row counts of the tables written

Stages talk only through the zones, so each can run on its own (as the
reference runs one script per stage) or all in one go.  Each zone is written
with overwrite semantics and read back before the next stage: a lost
executor only recomputes its own zone.  The version is published by one
pointer swap at the end (``lendwise.sources.published``), so a run that dies
leaves what was published before.  Tables and the consolidated view are
registered in the session catalog.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from lendwise import schemas
from lendwise.functions.keys import pack, unpack, with_member_key
from lendwise.operators import audit, clean, quarantine, score, split, views
from lendwise.params import DEFAULT_PARAMS, DEFAULT_VARIANT, ScoreParams, Variant
from lendwise.session import SCALE_CONF, scratch_path
from lendwise.sources import fixture, io
from lendwise.sources.published import Published

SPLIT_DDL = {"customers": schemas.CUSTOMERS_RAW, "loans": schemas.LOANS_RAW,
             "repayments": schemas.REPAYMENTS_RAW, "defaulters": schemas.DEFAULTERS_RAW}
SPLITS = {"customers": split.split_customers, "loans": split.split_loans,
          "repayments": split.split_repayments, "defaulters": split.split_defaulters}


@dataclass
class Zones:
    """Paths of every zone of one version, and the checks observed while
    its tables were written."""

    root: str
    split_format: str = "parquet"
    tables: dict[str, str] = field(default_factory=dict)
    observed: audit.Observed = field(default_factory=audit.Observed)

    def path(self, name: str) -> str:
        p = f"{self.root.rstrip('/')}/{name}"
        self.tables[name] = p
        return p

    def write(self, spark: SparkSession, name: str, df: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
        path = self.path(name)
        io.write_parquet(self.observed.watch(df, checks) if checks else df, path)
        return spark.read.parquet(path)

    def write_audit(self, spark: SparkSession, stage: str) -> None:
        """The checks of the stages run so far, few rows, from their writes."""
        self.write(spark, f"audit/checks/stage={stage}", self.observed.table(spark).coalesce(1))
        self.observed = audit.Observed()

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    # the raw splits may be CSV (the reference's raw zone) or parquet
    def write_split(self, spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
        path = self.path(f"raw/{name}")
        # The split's own names stand for the declared ones by position.
        named = dict(zip(schemas.names(SPLIT_DDL[name]), df.columns))
        checks = audit.row_check(f"{name}_raw") | audit.null_checks(named).get(f"{name}_raw", {})
        df = self.observed.watch(df, checks)
        if self.split_format == "csv":
            io.write_csv(df, path)
        else:
            io.write_parquet(df, path)
        return self.read_split(spark, name)

    def read_split(self, spark: SparkSession, name: str) -> DataFrame:
        """A split bound to its declared schema (positionally, like the CSV read)."""
        path = self.path(f"raw/{name}")
        if self.split_format == "csv":
            return io.read_csv_schema(spark, path, SPLIT_DDL[name])
        return split.conform(spark.read.parquet(path), SPLIT_DDL[name])


def stage_split(spark: SparkSession, raw: DataFrame, zones: Zones,
                raw_is_keyed: bool = False) -> None:
    """Key the raw rows once, then write the four splits from that zone."""
    keyed = zones.write(spark, "bronze/keyed_raw", raw if raw_is_keyed else with_member_key(raw))
    for name, fn in SPLITS.items():
        zones.write_split(spark, name, fn(keyed))
    zones.write_audit(spark, "split")


def stage_clean(spark: SparkSession, zones: Zones, variant: Variant = DEFAULT_VARIANT) -> None:
    """The four cleaning jobs, with F19 and F20 of their results."""
    nulls, rows = audit.null_checks(), audit.row_check
    zones.write(spark, "cleaned/customers", clean.customers_clean(zones.read_split(spark, "customers")),
                rows("customers_clean") | nulls["customers_clean"])
    zones.write(spark, "cleaned/loans", clean.loans_clean(zones.read_split(spark, "loans"), variant), rows("loans_clean"))
    zones.write(spark, "cleaned/repayments",
                clean.repayments_clean(zones.read_split(spark, "repayments"), variant),
                rows("repayments_clean") | nulls["repayments_clean"])
    base = clean.defaulters_base(zones.read_split(spark, "defaulters"))
    zones.write(spark, "cleaned/delinq", clean.delinq_members(base, variant), rows("delinq"))
    watched = zones.observed.watch(base, nulls["defaulters"])  # all rows pass here
    zones.write(spark, "cleaned/records", clean.record_detail(watched, variant), rows("records"))
    zones.write(spark, "cleaned/record_members", clean.record_members(base))
    zones.write_audit(spark, "clean")


def stage_quarantine(spark: SparkSession, zones: Zones, variant: Variant = DEFAULT_VARIANT) -> None:
    """Duplicate-member list and the quarantined gold tables."""
    customers = pack(zones.read(spark, "cleaned/customers"))
    delinq = pack(zones.read(spark, "cleaned/delinq"))
    records = pack(zones.read(spark, "cleaned/records"))
    bad = pack(zones.write(spark, "gold/bad_customer_data",
                           unpack(quarantine.bad_members(customers, delinq, records, variant))))
    c_new, d_new, r_new = quarantine.quarantine(customers, delinq, records, bad, variant)
    zones.write(spark, "gold/customers_new", unpack(c_new), audit.row_check("customers_new"))
    zones.write(spark, "gold/delinq_new", unpack(d_new))
    zones.write(spark, "gold/records_new", unpack(r_new))
    zones.write_audit(spark, "quarantine")


def stage_score(spark: SparkSession, zones: Zones, variant: Variant = DEFAULT_VARIANT,
                params: ScoreParams = DEFAULT_PARAMS, database: str | None = None) -> None:
    """Weighted reference-grain score and the per-loan score, both from the
    payment points written once.  With a ``database`` that holds the bucketed
    loan tables (``bucket_loan_tables``) those points need no shuffle."""
    if database:
        loans, repayments = (spark.table(f"{database}.{t}") for t in BUCKETED.values())
    else:
        loans, repayments = zones.read(spark, "cleaned/loans"), zones.read(spark, "cleaned/repayments")
    loans = pack(loans)
    bad = pack(zones.read(spark, "gold/bad_customer_data"))
    customers_new = pack(zones.read(spark, "gold/customers_new"))
    delinq_new = pack(zones.read(spark, "gold/delinq_new"))
    records_new = pack(zones.read(spark, "gold/records_new"))
    records_bad = None if variant.quarantine_lists == "shared" else bad
    points = pack(zones.write(spark, "gold/payment_points", unpack(
        score.payment_points(loans, repayments, params, carry=score.CARRIED))))
    ph = score.history_of_points(points, customers_new, bad, variant)
    zones.write(spark, "gold/loan_score", unpack(score.loan_score_final(
        ph, delinq_new, records_new, loans, customers_new, records_bad, variant, params)))
    zones.write(spark, "gold/loan_score_by_loan", unpack(score.score_loans(
        points, customers_new, delinq_new, records_new, bad, variant, params, records_bad)))


BUCKETED = {"loans": "loans_by_id", "repayments": "repayments_by_id"}


def bucket_loan_tables(spark: SparkSession, database: str, zones: Zones, buckets: int) -> None:
    """K6: cleaned loans and repayments as tables bucketed by ``loan_id``,
    which is unique and cannot be hot.  Worth its one shuffle where scores are
    computed again and again, for instance with other ``ScoreParams``."""
    io.create_database(spark, database)
    for name, table in BUCKETED.items():
        io.save_bucketed(zones.read(spark, f"cleaned/{name}"), f"{database}.{table}", zones.path(f"bucketed/{name}"), "loan_id", buckets)


TABLE_DDL = {
    "cleaned/customers": ("customers", schemas.CUSTOMERS_TABLE),
    "cleaned/loans": ("loans", schemas.LOANS_TABLE),
    "cleaned/repayments": ("loans_repayments", schemas.REPAYMENTS_TABLE),
    "cleaned/delinq": ("loans_defaulters_delinq", schemas.DELINQ_TABLE),
    "cleaned/records": ("loans_defaulters_detail_rec_enq", schemas.RECORDS_TABLE),
    "gold/bad_customer_data": ("bad_customer_data", "member_id string"),
    "gold/customers_new": ("customers_new", schemas.CUSTOMERS_TABLE),
    "gold/delinq_new": ("loans_defaulters_delinq_new", schemas.DELINQ_TABLE),
    "gold/records_new": ("loans_defaulters_detail_rec_enq_new", schemas.RECORDS_TABLE),
}


def register_tables(spark: SparkSession, database: str, zones: Zones) -> None:
    """K6/K7/K8: external tables over the zones and the consolidated view."""
    io.create_database(spark, database)
    for zone_name, (table, ddl) in TABLE_DDL.items():
        io.analyze_table(spark, io.external_table(spark, f"{database}.{table}", ddl, zones.path(zone_name), replace=True))
    for zone_name in ("gold/loan_score", "gold/loan_score_by_loan"):
        table = f"{database}.{zone_name.split('/')[1]}"
        io.drop_table(spark, table)
        spark.catalog.createTable(table, path=zones.path(zone_name), source="parquet")
        io.analyze_table(spark, table)
    db = database
    # A view holds SQL text: the same parts as the DataFrame view.
    io.persistent_view(spark, f"{db}.customers_loan_v", views.consolidated_view_sql(
        f"{db}.customers", f"{db}.loans", f"{db}.loans_repayments",
        f"{db}.loans_defaulters_delinq", f"{db}.loans_defaulters_detail_rec_enq"))


@dataclass
class JobResult:
    """``root``: the published version's folder; ``version``: its name."""

    root: str
    database: str | None
    tables: dict[str, str]
    version: str


def run(spark: SparkSession, raw: DataFrame, root: str | None = None,
        database: str | None = None, variant: Variant = DEFAULT_VARIANT,
        params: ScoreParams = DEFAULT_PARAMS, raw_is_keyed: bool = False,
        split_format: str = "parquet", keep: int | None = None) -> JobResult:
    """All stages in order, in a version of their own, published at the end.
    ``keep``: versions to keep afterwards, all by default."""
    published = Published(spark, root or scratch_path(spark, "job"))
    version = published.begin()
    zones = Zones(published.path(version), split_format)
    stage_split(spark, raw, zones, raw_is_keyed)
    stage_clean(spark, zones, variant)
    stage_quarantine(spark, zones, variant)
    stage_score(spark, zones, variant, params)
    published.publish(version)
    if database:
        register_tables(spark, database, zones)
    if keep is not None:
        published.prune(keep)
    return JobResult(zones.root, database, zones.tables, version)


def read_zone(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A zone of the published version under ``root``."""
    return spark.read.parquet(f"{Published(spark, root).current_path()}/{name}")


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw accepted-loans CSV with the declared raw schema (no inference pass)."""
    return io.read_csv_schema(spark, path, schemas.RAW)


STAGES = ("all", "split", "clean", "quarantine", "score", "publish", "register")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Run the loan-score job, or one stage of it.")
    ap.add_argument("--stage", choices=STAGES, default="all")
    ap.add_argument("--raw-csv", help="raw accepted-loans CSV with header (split/all)")
    ap.add_argument("--testdata", help="folder of the TPC-H-style test tables (split/all)")
    ap.add_argument("--root", help="root of the versions (default: fresh folder under spark.checkpoint.dir)")
    ap.add_argument("--split-format", choices=("parquet", "csv"), default="parquet")
    ap.add_argument("--database", default=None)
    ap.add_argument("--keep", type=int, default=None, help="versions to keep after publishing")
    ap.add_argument("--notebook-variant", action="store_true")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName(f"lendwise-{args.stage}")
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    variant = Variant.notebook() if args.notebook_variant else DEFAULT_VARIANT
    if args.stage != "all" and not args.root:
        ap.error("--root is required to run a single stage")
    published = Published(spark, args.root or scratch_path(spark, "job"))
    # The split starts a version; the stages after it go on with the draft.
    if args.stage in ("all", "split"):
        version = published.begin()
    else:
        version = published.draft() or published.current()
    if version is None:
        ap.error(f"no version under {published.root}: run the split stage first")
    zones = Zones(published.path(version), args.split_format)

    def raw() -> DataFrame:
        if args.raw_csv:
            return read_raw_csv(spark, args.raw_csv)
        if args.testdata:
            return fixture.raw_loans(spark, args.testdata)
        ap.error("--raw-csv or --testdata is required for the split stage")

    if args.stage in ("all", "split"):
        stage_split(spark, raw(), zones)
    if args.stage in ("all", "clean"):
        stage_clean(spark, zones, variant)
    if args.stage in ("all", "quarantine"):
        stage_quarantine(spark, zones, variant)
    if args.stage in ("all", "score"):
        stage_score(spark, zones, variant)
    if args.stage in ("all", "publish"):
        published.publish(version)
        if args.keep is not None:
            published.prune(args.keep)
    if args.stage in ("all", "register") and args.database:
        register_tables(spark, args.database, zones)
    print(zones.root)


if __name__ == "__main__":
    main()
