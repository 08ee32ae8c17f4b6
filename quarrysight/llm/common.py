"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# else shuffle files stay until the driver collects garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.
    Only a local master may go without; it gets a folder of its own."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="quarrysight-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it lives as long as the results that
    read it are wanted, and goes when that folder is cleared."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as a table in the shared folder and read back: cuts the
    lineage, survives lost executors, keeps column pruning and statistics. The
    shuffles made for it, which nothing reads again, go at once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)      # planned anew, under this setting
    finally:
        if was is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete tables that ``written`` stored and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
            if folder.getName().startswith("llm-"):
                folder.getFileSystem(conf).delete(folder, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; unlike ``written`` it fixes partitions and row order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(col: str | Column) -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.encode(col, "UTF-8"), F.lit(b""))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def row_key() -> Column:
    """Hash of doc_id and text: rows that agree in both share it, rows that share a
    doc_id only, or have none, do not."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_or_empty("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_KEPT: dict[Any, Any] = {}


def worker_keeps(name: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks under ``name``. It keeps one thing: a new
    one takes the place of the last, so that an idle worker does not hold on to what an
    earlier stage needed."""
    if name not in _KEPT:
        worker_drops()
        _KEPT[name] = make()
    return _KEPT[name]


def worker_drops() -> None:
    """Give back what this worker keeps; for tasks that need nothing kept."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
