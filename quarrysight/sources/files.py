"""Batch readers for the landed files and the layer tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C
from ..functions.text import decimal_comma_to_double as _dc
from ..operators.ranks import gapless_rank


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path's scheme
    (works for local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, reader) -> DataFrame:
    """A missing landing folder yields an empty DataFrame with the
    contract schema, so downstream stages still run."""
    return reader(path) if path_exists(spark, path) else empty_frame(spark, schema)


def read_csv_strings(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Header CSV, every column as string (no inference)."""
    return spark.read.option("header", "true").option("inferSchema", "false") \
        .option("delimiter", delimiter).csv(path)


def decimal_comma_to_double(df: DataFrame, skip: tuple[str, ...] = ("date",)) -> DataFrame:
    """``"1,5"`` -> 1.5 for every column but ``skip``, in one projection."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in skip else _dc(c).alias(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source header -> contract name; absent headers are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` in one projection (bad values -> NULL, no ANSI error)."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def with_ingest_metadata(df: DataFrame, as_of: Column, source: Column | str | None = None) -> DataFrame:
    """``ingestion_timestamp``, ``source_file``, ``ingestion_date``,
    ``_rescued_data`` (NULL unless already present)."""
    src = F.lit(source) if isinstance(source, str) else (source if source is not None else F.col("_metadata.file_path"))
    cols = {
        "ingestion_timestamp": as_of,
        "source_file": src,
        "ingestion_date": F.to_date(as_of),
    }
    if "_rescued_data" not in df.columns:
        cols["_rescued_data"] = F.lit(None).cast("string")
    return df.withColumns(cols)


def flotation_bronze(raw: DataFrame, source: Column, as_of: Column) -> DataFrame:
    """Flotation rows as read (all strings) -> decimal-comma doubles ->
    contract names -> ingest metadata. Row-wise: batch or stream."""
    raw = raw.withColumn("source_file", source)
    renamed = rename_columns(decimal_comma_to_double(raw, skip=("date", "source_file")), C.FLOTATION_HEADER_MAP)
    return with_ingest_metadata(renamed, as_of, F.col("source_file"))


def label_bronze(raw: DataFrame, source: Column, as_of: Column) -> DataFrame:
    """Maintenance-label rows as read -> contract names -> typed -> metadata."""
    raw = rename_columns(raw.withColumn("source_file", source), C.LABEL_HEADER_MAP)
    types = {**{c: "double" for c in C.LABEL_DOUBLE_COLUMNS}, **{c: "int" for c in C.LABEL_INT_COLUMNS}}
    return with_ingest_metadata(cast_columns(raw, types), as_of, F.col("source_file"))


def read_flotation_csv(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """Flotation CSV (batch): strings -> decimal-comma doubles -> contract names."""
    return flotation_bronze(read_csv_strings(spark, path), F.col("_metadata.file_path"), as_of)


def read_label_csv(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """Maintenance-label CSV (batch)."""
    return label_bronze(read_csv_strings(spark, path), F.col("_metadata.file_path"), as_of)


def read_vibration_files(spark: SparkSession, root: str, as_of: Column,
                         experiments: dict[str, int] = C.EXPERIMENT_IDS,
                         max_samples: int | None = None,
                         bearings: int = C.BEARINGS_PER_FILE) -> DataFrame:
    """``<root>/<experiment dir>/<file>``, one tab-separated file per
    measurement, one column per bearing.

    Each file is read whole (``wholetext``) so its sample order is kept;
    lines are split, every sample ``try_cast`` (bad ones dropped), all kept,
    or the first ``max_samples`` if that is given. ``measurement_index`` is the rank of the file name
    within its experiment: ``operators/ranks.gapless_rank`` over the narrow
    (experiment, file) table, joined back, so no window carries signals or
    holds an experiment's files.
    """
    # keyword form: ``text()`` resets ``wholetext`` to its default otherwise
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True) \
        .select(F.col("value"), F.col("_metadata.file_path").alias("path"))
    parts = F.split(F.col("path"), "/")
    exp_name = F.element_at(parts, -2)
    fname = F.element_at(parts, -1)
    mapping = F.create_map(*[x for k, v in experiments.items() for x in (F.lit(k), F.lit(v))])
    files = files.withColumns({"experiment_id": mapping[exp_name].cast("int"), "timestamp": fname}) \
        .filter(F.col("experiment_id").isNotNull())
    idx = gapless_rank(files.select("experiment_id", "timestamp", "path"), ["experiment_id"], ["timestamp", "path"],
                       "measurement_index").withColumn("measurement_index", F.col("measurement_index").cast("int"))
    lines = F.filter(F.split(F.col("value"), "\r?\n"), lambda l: F.length(F.trim(l)) > 0)
    rows = F.transform(lines, lambda l: F.split(F.trim(l), "\t"))
    def column(b: int):
        # a one-argument lambda: ``transform`` reads a second one as the index
        return lambda r: F.get(r, b).try_cast("double")

    per_bearing = [
        F.filter(F.transform(rows, column(b)), lambda x: x.isNotNull())
        for b in range(bearings)
    ]
    if max_samples is not None:
        per_bearing = [F.slice(x, 1, max_samples) for x in per_bearing]
    sig = files.select(
        "experiment_id", "timestamp", "path",
        F.posexplode(F.array(*per_bearing)).alias("bearing_pos", "vibration_signal"),
    )
    out = sig.join(idx, ["experiment_id", "timestamp", "path"], "inner").select(
        "experiment_id",
        (F.col("bearing_pos") + 1).cast("int").alias("bearing_id"),
        "measurement_index", "timestamp", "vibration_signal",
        F.lit(C.SAMPLE_RATE_HZ).alias("sample_rate_hz"),
        F.col("path").alias("source_file"),
    )
    return with_ingest_metadata(out, as_of, F.col("source_file"))


def write_text_files(files: DataFrame, root: str) -> int:
    """One file per row of ``files`` (path below ``root``, text), written by the tasks; a
    task that runs again writes the same files. The number of files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        for batch in batches:
            for path, text in zip(*(c.to_pylist() for c in batch.columns)):
                at = f"{base}/{path}"
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(at) as out:
                    out.write((text or "").encode())
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    return files.select("path", "text").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_registry_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                      maintenance_days_ago: int = 30, as_of_date: Column | None = None) -> DataFrame:
    """Registry CSV with declared schema; ``last_maintenance_date`` is
    ``as_of_date - maintenance_days_ago`` when the file has none."""
    from ..schemas import REGISTRY_CSV
    df = spark.read.option("header", "true").schema(schema or REGISTRY_CSV).csv(path)
    df = df.withColumn("commissioned_date", F.to_date("commissioned_date"))
    if "last_maintenance_date" not in df.columns:
        base = as_of_date if as_of_date is not None else F.current_date()
        df = df.withColumn("last_maintenance_date", F.date_sub(base, maintenance_days_ago))
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A layer table (parquet file or directory). Its splits follow
    ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``."""
    return spark.read.parquet(path)
