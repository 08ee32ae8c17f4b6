"""The shared scratch folder, and tables stored in it."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, ``spark.checkpoint.dir``. Only a local
    master may go without; it gets a folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quarrysight-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "layer") -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: used by several
    branches of one plan it is computed once, a lost executor re-reads it, and its size and
    columns are known to the planner."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
