"""Incremental ingest of landed files with Structured Streaming.

Only new files are processed (the file source records them in the
checkpoint); ``availableNow`` drains what is there and stops, and the call
waits for it (the reference counted the table before the stream finished).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..sources.rescue import rescue_json


def json_lines_stream(spark: SparkSession, landing: str, schema: StructType = schemas.SENSOR_JSON,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed JSON lines + ``_rescued_data`` +
    ingest metadata (``source_file`` from the file source's metadata)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing).select("value", F.col("_metadata.file_path").alias("source_file"))
    parsed = rescue_json(lines, schema)
    return parsed.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "ingestion_date": F.current_date(),
    })


def ingest_json_stream(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                       schema: StructType = schemas.SENSOR_JSON, partition_by: tuple[str, ...] = ("ingestion_date",)) -> int:
    """Append new landed files to a parquet table; returns the number of
    micro-batches committed to the checkpoint so far. A rerun on the same checkpoint adds nothing."""
    df = json_lines_stream(spark, landing, schema)
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
         .trigger(availableNow=True).start(table_path))
    q.awaitTermination()
    last = q.lastProgress
    return int(last["batchId"]) + 1 if last else 0


def stream_parquet_once(spark: SparkSession, source_dir: str, schema: StructType, table_path: str,
                        checkpoint: str, transform=None, output_mode: str = "append",
                        glob: str | None = None) -> None:
    """Drain a parquet source directory (files matching ``glob``) through
    ``transform`` into a parquet sink (``availableNow``), waiting for it."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.parquet(source_dir)
    if transform is not None:
        df = transform(df)
    q = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(table_path))
    q.awaitTermination()


def string_schema(names) -> StructType:
    """All-string schema for header CSVs (no inference, as in the batch readers)."""
    from pyspark.sql.types import StringType, StructField
    return StructType([StructField(n, StringType()) for n in names])


def ingest_csv_stream(spark: SparkSession, landing: str, table_path: str, checkpoint: str, header: list[str],
                      transform, delimiter: str = ",", partition_by: tuple[str, ...] = ("ingestion_date",)) -> None:
    """Append new header-CSV files of ``landing`` to a parquet table: every
    column read as string, header names checked against ``header``,
    ``transform(df, source_file_col, ingest_ts_col)`` applied row-wise, one
    ``availableNow`` drain, awaited. A rerun on the same checkpoint adds
    nothing; a new file adds only its rows."""
    df = (spark.readStream.option("header", "true").option("enforceSchema", "false")
          .option("delimiter", delimiter).schema(string_schema(header)).csv(landing))
    out = transform(df, F.col("_metadata.file_path"), F.current_timestamp())
    q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by).trigger(availableNow=True).start(table_path))
    q.awaitTermination()
