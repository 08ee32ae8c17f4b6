import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="qs-test-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("quarrysight-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", scratch)
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="qs-work-")
