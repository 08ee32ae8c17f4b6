"""Keyed streaming state: the best copy of each key while it is wanted.

A micro-batch costs its own rows. A stateful aggregation (in the JVM, over RocksDB) holds
each key's best copy, for the period in which it was first seen; what it gives for the
keys of a batch goes to a log, one partition per batch. The clock is that of arrival, so
no reading is too late for it, whatever its own time, and the state lets a period go by
the watermark on that clock: it is bounded by what arrives in two periods. A copy that
comes in a later period is written again as if it were the first: :func:`best_rows` picks
by the same total order as a batch run, so the table depends neither on arrival nor on
what the state forgot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables as T
from .tables import drain

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SEEN = "_seen"


def best_copies(stream: DataFrame, keys: list[str], order: list[Column], keep: str = "7 days",
                seen: Column | None = None) -> DataFrame:
    """Per key and period of arrival the copy that ranks first by ``order`` (ascending,
    NULL first), in update mode: a batch gives its own keys only. ``seen`` is the clock,
    by default that of the batch."""
    whole = F.struct(*[F.col(c) for c in stream.columns])
    clocked = stream.withColumn(SEEN, F.current_timestamp() if seen is None else seen).withWatermark(SEEN, "0 seconds")
    return clocked.groupBy(*keys, F.window(SEEN, keep).alias("_period")).agg(
        F.min_by(whole, F.struct(*order)).alias("_best")).select("_best.*")


def write_best_copies(spark: SparkSession, stream: DataFrame, path: str, keys: list[str], order: list[Column],
                      checkpoint: str, keep: str = "7 days", seen: Column | None = None) -> None:
    """Run the stream over all input there is, into the log at ``path``. A batch that is
    run again starts from the state before it and overwrites its partition."""
    def write(batch: DataFrame, batch_id: int) -> None:
        T.write_table(batch.withColumn("batch_id", F.lit(batch_id)), path, "overwrite", ("batch_id",))

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        drain(best_copies(stream, keys, order, keep, seen), write, checkpoint, mode="update")
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def best_rows(log: DataFrame, best: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table that a log stands for: ``best`` is the batch run's own de-duplication."""
    return best(log.drop("batch_id"))


def compact(spark: SparkSession, log_path: str, path: str, best: Callable[[DataFrame], DataFrame], partition_col: str) -> None:
    """Merge the log into a table by partition, from time to time."""
    T.merge_best(spark, path, spark.read.parquet(log_path).drop("batch_id"), best, partition_col)
