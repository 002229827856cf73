"""Re-scoring only the members that a batch of raw rows touches.

A member's score rows depend on the member's own rows and on the repayments
of its loans, nothing else (the mean that imputes employment lengths enters
no rating).  So a batch changes the scores of the members it names, and of
those that hold a loan under an id in the batch; the others' stored rows stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwise.params import DEFAULT_PARAMS, DEFAULT_VARIANT, ScoreParams, Variant
from lendwise.functions.keys import pack, unpack
from lendwise.operators.marks import drop_marked, keep_marked
from lendwise.plans.stages import Stages
from lendwise.session import scratch_path
from lendwise.sources import io

KEY = "member_id"


def touched_members(keyed: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of the members whose score may change when ``batch`` joins the
    keyed raw rows (``keyed`` holds the batch already)."""
    ids = batch.where(F.col("id").isNotNull()).select("id").distinct()
    sharing = keep_marked(keyed.select("id", KEY), ids, "id").select(KEY)
    return unpack(pack(batch.select(KEY)).unionByName(pack(sharing)).distinct())


def rows_for(keyed: DataFrame, touched: DataFrame) -> DataFrame:
    """The raw rows that the scores of ``touched`` depend on: their own, and
    every row under the id of one of their loans."""
    own = keep_marked(keyed.select("id", KEY), touched, KEY)
    ids = own.where(F.col("id").isNotNull()).select("id").distinct()
    nameless = keep_marked(keyed.where(F.col("id").isNull()), touched, KEY)
    return keep_marked(keyed, ids, "id").unionByName(nameless)


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, "rescore", name)
    io.write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def rescore(keyed: DataFrame, batch: DataFrame, stored: DataFrame, variant: Variant = DEFAULT_VARIANT,
            params: ScoreParams = DEFAULT_PARAMS) -> DataFrame:
    """The whole score after ``batch``: ``stored`` (the score before it)
    without the touched members, and the touched ones scored anew.

    Rows that the batch cannot touch, stored or raw, are told by marks and not
    shuffled; the score itself runs over the touched members' rows, written
    out once as its many branches read them.  Write the result as a new
    version, it reads the old one.
    """
    spark = keyed.sparkSession
    touched = _kept(spark, touched_members(keyed, batch), "touched")
    rows = _kept(spark, rows_for(keyed, touched), "touched_rows")
    again = Stages(pack(rows), variant=variant, params=params, raw_is_keyed=True).loan_score
    fresh = again.join(pack(touched), KEY, "left_semi")
    return drop_marked(unpack(stored), touched, KEY).unionByName(unpack(fresh))
