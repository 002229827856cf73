"""Sources (S1–S8), sinks (K1–K5, K9, K10) and catalog registration (K6–K8).

Only CSV and parquet exist in the reference.  Writers never funnel data to
one task by default: ``single_file=True`` is available for small outputs
(it coalesces, without a shuffle, to one writer) but the default keeps the
input's parallelism.  Paths for durable intermediates come from
``lendwise.session.scratch_path`` (under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.session import scratch_path


# -- sources ------------------------------------------------------------------

def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header, inferred types (an extra pass over the file)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_schema(spark: SparkSession, path: str, ddl: str, header: bool = True,
                    mode: str = "PERMISSIVE") -> DataFrame:
    """Declared DDL schema; ``mode`` PERMISSIVE (bad cells -> null)
    or FAILFAST (a malformed row aborts the job)."""
    return spark.read.schema(ddl).option("mode", mode).csv(path, header=header)


BAD_LINE = "_corrupt_record"


@dataclass(frozen=True)
class Captured:
    """A CSV source with its malformed lines set aside.

    A line is malformed if it has more or fewer fields than declared, or a
    field that its type cannot hold.  ``good``: the well-formed rows.
    ``lenient``: all rows, with null for what could not be read (PERMISSIVE).
    ``bad``: the malformed rows in that form with ``source``, their file, and
    ``line``, their text.  ``counts``: per file ``n_rows``, ``n_bad`` and
    ``n_without_key``, rows whose first column is null.
    """

    good: DataFrame
    lenient: DataFrame
    bad: DataFrame
    counts: DataFrame


def read_csv_captured(spark: SparkSession, path: str, ddl: str, header: bool = True) -> Captured:
    """The source parsed once, whole, and kept as parquet in the shared
    folder; good rows, bad rows and counts read that copy.

    Left to each query the parser would look only at the columns the query
    reads, and a line would be malformed to one and well-formed to another.
    """
    rows = (spark.read.schema(f"{ddl}, {BAD_LINE} string").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_LINE).csv(path, header=header))
    names = [c for c in rows.columns if c != BAD_LINE]
    rows = rows.select(F.col("_metadata.file_path").alias("source"), F.col(BAD_LINE).alias("line"), *names)
    rows = spark.read.schema(rows.schema).parquet(write_parquet(rows, scratch_path(spark, "captured")))
    malformed = F.col("line").isNotNull()
    return Captured(
        good=rows.where(~malformed).select(*names),
        lenient=rows.select(*names),
        bad=rows.where(malformed),
        counts=rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count("line").alias("n_bad"),
                                          F.count_if(F.col(names[0]).isNull()).alias("n_without_key")))


def raises_on_malformed(spark: SparkSession, path: str, ddl: str, header: bool = True) -> bool:
    """Whether a FAILFAST read of the whole source ends in an error about
    a malformed line; any other error is passed on."""
    try:
        read_csv_schema(spark, path, ddl, header, mode="FAILFAST").write.format("noop").mode("overwrite").save()
    except Exception as error:
        if "MALFORMED" not in str(error).upper():
            raise
        return True
    return False


def read_csv_headerless(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """S3: declared schema with no header option — the header line is read
    as a data row (its numeric fields become null)."""
    return spark.read.schema(ddl).csv(path)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """Load with the default source (parquet)."""
    return spark.read.load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def temp_view(df: DataFrame, name: str) -> str:
    """Name an intermediate for SQL users."""
    df.createOrReplaceTempView(name)
    return name


# -- sinks --------------------------------------------------------------------

# Member ids are hex digits: they shrink to half under zstd, not at all under
# snappy.
PARQUET_CODEC = "zstd"

def _writer(df: DataFrame, single_file: bool):
    return (df.coalesce(1) if single_file else df).write


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
              compression: str | None = None) -> str:
    """K1/K9: CSV with header; plain text, or compressed with a codec that
    Spark's CSV reader knows by the file name (``gzip``)."""
    _writer(df, single_file).mode(mode).option("header", True).csv(path, compression=compression)
    return path


def write_csv_one_header(df: DataFrame, path: str) -> str:
    """Multi-part CSV whose folder holds exactly one header line, as a
    single-file export has, without funnelling the rows into one task: the
    data parts carry no header and one empty part carries it."""
    df.write.mode("overwrite").option("header", False).csv(path)
    df.limit(0).coalesce(1).write.mode("append").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Parquet; optional ``partition_by`` for partition pruning."""
    w = df.write.mode(mode).option("compression", PARQUET_CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_default(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3: ``save()`` with no format: the default source, parquet."""
    df.write.mode(mode).option("compression", PARQUET_CODEC).save(path)
    return path


def write_new(df: DataFrame, path: str) -> str:
    """K4: default save mode: fail when the target exists."""
    df.write.mode("errorifexists").option("compression", PARQUET_CODEC).save(path)
    return path


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> str:
    """K5: a managed table in the current (or named) database."""
    df.write.mode(mode).option("compression", PARQUET_CODEC).saveAsTable(name)
    return name


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> str:
    """K5/K6: a table at ``path`` in ``buckets`` files by the hash of ``key``,
    each sorted: two tables bucketed alike join on the key without a shuffle.
    Only for keys that cannot be hot, as a bucket is read by one task."""
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path).option("compression", PARQUET_CODEC)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return name


# -- catalog ------------------------------------------------------------------

def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K7: create a database if missing (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def use_database(spark: SparkSession, name: str) -> None:
    """K7: names without a database mean this one from now on."""
    spark.catalog.setCurrentDatabase(name)


def drop_database(spark: SparkSession, name: str) -> None:
    """K7: a database with all its tables and views; external files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def external_table(spark: SparkSession, name: str, ddl: str, location: str,
                   replace: bool = False) -> str:
    """K6: parquet table over a directory; idempotent."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{location}'")
    return name


def analyze_table(spark: SparkSession, name: str, columns: tuple[str, ...] = ()) -> str:
    """K6: row count and size of a registered table, and the statistics of
    ``columns`` (nulls, distinct values, range), kept in the catalog: joins
    are then chosen and ordered by measured sizes."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    return name


def table_statistics(spark: SparkSession, name: str, columns: tuple[str, ...] = ()) -> dict[str, int]:
    """What the catalog knows of a table: ``rows`` and, by column, nulls."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'").first()
    found = {"rows": int(told.data_type.split(",")[1].split()[0])} if told and "rows" in told.data_type else {}
    for column in columns:
        about = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {column}").collect()}
        if about["num_nulls"] != "NULL":
            found[column] = int(about["num_nulls"])
    return found


def drop_table(spark: SparkSession, name: str) -> None:
    """K7."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """K7: permanent table names in a database (catalog metadata, no data
    read); session temp views, which the catalog lists too, are left out."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def persistent_view(spark: SparkSession, name: str, select_sql: str) -> str:
    """K8: ``CREATE OR REPLACE VIEW`` (without the rejected IF NOT EXISTS, D7)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")
    return name
