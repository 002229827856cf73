"""The training-data pipeline: stages over ``documents``, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendwise.llm.pipeline_stages import STAGES, apply_stages

__all__ = ["ORACLE_SQL", "STAGES", "run"]

ORACLE_SQL = None  # language ID and encoding are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
