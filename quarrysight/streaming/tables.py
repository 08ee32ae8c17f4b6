"""Streams into tables whose content does not depend on how the input falls
into micro-batches: late and repeated rows count like any others.

Each writer is a ``foreachBatch`` that can be run again for the same batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import EXACT_PRECISION, EXACT_SCALE, fixed_point, keeps_digits
from ..sources import tables as T


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run ``write(batch, batch_id)`` over all input there is, and wait."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_files(spark: SparkSession, source_dir: str, schema, glob: str | None = None,
               files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source_dir)


def keep_best(path: str, prepare: Callable[[DataFrame], DataFrame], best: Callable[[DataFrame], DataFrame],
              partition_col: str) -> Callable[[DataFrame, int], None]:
    """Keyed table of best rows: each batch is ``prepare``d and merged into the
    partitions it touches, and ``best`` picks among stored and new rows by the
    same total order as a batch run, so arrival decides nothing."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        T.merge_best(batch.sparkSession, path, prepare(batch), best, partition_col)
    return write


def window_partials(df: DataFrame, ts_col: str, unit_col: str, value_col: str, status_col: str,
                    operating: tuple[str, ...]) -> DataFrame:
    """What rows add to their (hour, unit): counts, sums and the highest value."""
    value = F.col(value_col).cast("double")
    fixed = fixed_point(value)
    return df.groupBy(F.date_trunc("hour", F.col(ts_col)).cast("timestamp_ntz").alias("window_start"), F.col(unit_col)).agg(
        F.count("*").alias("n"), F.count_if(F.col(status_col).isin(*operating)).alias("n_operating"),
        F.count(value).alias("n_value"), F.count(fixed).alias("n_fixed"),
        F.sum(fixed).cast(f"decimal(38,{EXACT_SCALE})").alias("sum_fixed"), F.sum(value).alias("sum_value"),
        F.max(F.abs(value)).alias("largest"), F.max(value_col).alias("max_value"))


def add_partials(path: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """One partition of partial aggregates per batch, overwritten if the batch
    is run again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        T.write_table(make(batch).withColumn("batch_id", F.lit(batch_id)), path, "overwrite", ("batch_id",))
    return write


def window_totals(partials: DataFrame, unit_col: str) -> DataFrame:
    """Hourly KPIs of all windows from the partial aggregates of all batches."""
    total = partials.groupBy("window_start", unit_col).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_operating", "n_value", "n_fixed", "sum_fixed", "sum_value")],
        F.max("largest").alias("largest"), F.max("max_value").alias("max_value"))
    mean = F.when(keeps_digits(F.col("n_fixed"), F.col("n_value"), F.col("largest")),
                  (F.col("sum_fixed").cast(f"decimal({EXACT_PRECISION + 10},{EXACT_SCALE})")
                   / F.col("n_value").cast("decimal(10,0)")).cast(f"decimal(38,{EXACT_SCALE + 4})").cast("double")
                  ).otherwise(F.col("sum_value") / F.col("n_value"))
    return total.select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"), unit_col,
        F.col("n").alias("total_readings"), F.col("n_operating").alias("operating_readings"),
        F.round(F.col("n_operating") / F.col("n") * 100, 2).alias("utilization_pct"),
        mean.alias("avg_value"), "max_value")
