import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from lendwise.session import SCALE_CONF
    b = SparkSession.builder.master("local[*]").appName("lendwise-tests")
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    # One JVM serves all tests; Spark's 1 GB fills with what each leaves behind.
    b = b.config("spark.driver.memory", "4g").config("spark.sql.ui.retainedExecutions", "20")
    b = b.config("spark.ui.retainedJobs", "50").config("spark.ui.retainedStages", "100").config("spark.ui.retainedTasks", "1000")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="lendwise-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lendwise-test-")
