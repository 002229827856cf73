"""Session construction for tests and the benchmark, and shared-folder lookup.

Library functions never create a session: callers pass theirs in.  The
helpers here exist for local runs (tests, ``bench.py``) and for finding the
cluster-shared folder that durable intermediates go to.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions
# at run time, splits skewed join partitions, and the broadcast threshold is
# Spark's own size check (only relations whose measured size is below it are
# broadcast).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lendwise") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LENDWISE_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (a bare test session) gets a
    private folder, registered as its checkpoint dir; on a cluster a missing
    setting is an error, because a machine-local folder is not visible to
    the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="lendwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    base = "/".join([shared_root(spark), "lendwise", uuid.uuid4().hex, *parts])
    return base
