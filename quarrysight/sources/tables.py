"""Table writes, keyed upsert without MERGE, and table contracts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from .files import path_exists


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Parquet write. With ``partition_by`` an overwrite replaces only
    the partitions present in ``df`` (dynamic partition overwrite)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def upsert_rows(target: DataFrame, updates: DataFrame, keys: list[str], better: str = "quality_score") -> DataFrame:
    """T2 as a plan: MERGE semantics ``MATCHED AND source.better >
    target.better -> UPDATE *``, ``NOT MATCHED -> INSERT *``, target wins ties.

    Tagged union + ``row_number`` per key (partial WindowGroupLimit before
    the shuffle). Updates are de-duplicated by the caller (silver does).
    Schemas may differ (a column added upstream): the union is by name and
    a column missing on one side is NULL there, like an append with schema
    merging.
    """
    t = target.withColumn("_src", F.lit(0))
    u = updates.withColumn("_src", F.lit(1))
    w = Window.partitionBy(*keys).orderBy(F.col(better).desc_nulls_last(), F.col("_src").asc())
    merged = t.unionByName(u, allowMissingColumns=True)
    return merged.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own (staging, run folders)."""
    _fs(spark, path).delete(_path(spark, path), True)


def read_partitioned(spark: SparkSession, path: str, partitions: dict[str, DataType]) -> DataFrame:
    """A partitioned table as it was written: partition columns get the given types, so
    that ``007`` stays a text; columns that only some files have are in the schema."""
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    wanted = StructType([StructField(f.name, partitions.get(f.name, f.dataType)) for f in found.fields])
    return spark.read.schema(wanted).parquet(path)


# ------------------------------------------------------ write, then swap

STAGING = "__staging"
READY = "READY"


def _staging(path: str, staging: str | None = None) -> str:
    return (staging or path.rstrip("/") + STAGING).rstrip("/")


def _leaves(spark: SparkSession, root: str) -> list[str]:
    """Partition folders below ``root``, as Spark named them, relative to it."""
    fs, found, todo = _fs(spark, root), [], [""]
    while todo:
        at = todo.pop()
        deeper = [at + st.getPath().getName() for st in fs.listStatus(_path(spark, f"{root}/{at}"))
                  if st.isDirectory() and "=" in st.getPath().getName()]
        todo += [d + "/" for d in deeper]
        if at and not deeper:
            found.append(at.rstrip("/"))
    return sorted(found)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs = _fs(spark, target)
    fs.mkdirs(_path(spark, target).getParent())
    if not fs.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not rename {source} to {target}")


def _swap(spark: SparkSession, run: str, path: str) -> None:
    """Put a ready run's partitions in the place of the table's: two renames each. What
    was done before an interruption is not done again."""
    fs = _fs(spark, path)
    fs.mkdirs(_path(spark, path))
    gone = [r[0] for r in spark.read.text(f"{run}/{READY}").collect() if r[0]]
    for part in [*_leaves(spark, f"{run}/new"), *gone]:
        new, now, old = f"{run}/new/{part}", f"{path}/{part}", f"{run}/old/{part}"
        if fs.exists(_path(spark, now)) and not fs.exists(_path(spark, old)):
            _rename(spark, now, old)
        if fs.exists(_path(spark, new)):
            _rename(spark, new, now)
    fs.delete(_path(spark, run), True)


def finish_swaps(spark: SparkSession, path: str, staging: str | None = None) -> int:
    """Finish what interrupted writers of ``path`` had ready; a run that was not ready is
    none of the table's and stays unread. Every writer here does this first."""
    root, n = _staging(path, staging), 0
    if not path_exists(spark, root):
        return 0
    for st in _fs(spark, root).listStatus(_path(spark, root)):
        run = f"{root}/{st.getPath().getName()}"
        if path_exists(spark, f"{run}/{READY}/_SUCCESS"):
            _swap(spark, run, path.rstrip("/"))
            n += 1
    return n


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, by: tuple[str, ...], gone: list[str] = (),
                       staging: str | None = None, run: str | None = None) -> None:
    """Replace the ``by`` partitions that ``df`` has rows for, and remove the folders
    ``gone`` that it has none for. All is written beside the table before any of it is
    touched, ``df`` may read the table itself, and an interruption at any point loses
    nothing: before the run is ready the table is as it was, after that
    :func:`finish_swaps` completes it. A reader between two renames may miss a partition.

    Folders are only listed and renamed, never named here, so partition values may hold
    anything; Spark stores an empty text as NULL. The rebalance lets Spark cut large
    partitions into several files and put small ones together."""
    finish_swaps(spark, path, staging)
    run = run or f"{_staging(path, staging)}/{uuid.uuid4().hex}"
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{run}/new")
    made = set(_leaves(spark, f"{run}/new"))
    spark.createDataFrame([(g,) for g in gone if g not in made], "value string").coalesce(1).write.text(f"{run}/{READY}")
    _swap(spark, run, path.rstrip("/"))


def replace_days(spark: SparkSession, df: DataFrame, path: str, col: str, days: list) -> None:
    """Replace the date partitions ``days`` with the rows of ``df``, which has no others; a
    day without rows any more goes."""
    replace_partitions(spark, df, path, (col,), [f"{col}={d.isoformat()}" for d in days])


def merge_upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                 partition_col: str, better: str = "quality_score", staging: str | None = None) -> None:
    """T2 on storage: :func:`upsert_rows` on the ``partition_col`` partitions
    the updates touch. First load = empty target."""
    _merge(spark, path, updates, lambda t, u: upsert_rows(t, u, keys, better), partition_col, staging)


def merge_best(spark: SparkSession, path: str, updates: DataFrame, best: Callable[[DataFrame], DataFrame],
               partition_col: str, staging: str | None = None) -> None:
    """Like :func:`merge_upsert`, with ``best`` picking among stored and new
    rows; of a first load too."""
    _merge(spark, path, updates, lambda t, u: best(u if t is None else t.unionByName(u, allowMissingColumns=True)),
           partition_col, staging, first=True)


def _merge(spark: SparkSession, path: str, updates: DataFrame, merge: Callable, partition_col: str,
           staging: str | None, first: bool = False) -> None:
    """The batch is written once, to a folder of this run alone. The target is one read of
    the table under a predicate on the partition column, which Spark prunes by; its values
    are compared as texts of the column's own type, so any value will do. The list of
    touched partitions is of the size of the table's own list of folders. What is merged
    is swapped in by :func:`replace_partitions`."""
    finish_swaps(spark, path, staging)
    kind = updates.schema[partition_col].dataType
    if isinstance(kind, StringType):
        # Spark stores an empty text as NULL: they are one partition
        updates = updates.withColumn(partition_col, F.nullif(F.col(partition_col), F.lit("")))
    run = f"{_staging(path, staging)}/{uuid.uuid4().hex}"
    write_table(updates, f"{run}/batch")
    batch = spark.read.schema(updates.schema).parquet(f"{run}/batch")
    target = None
    if path_exists(spark, path) and _leaves(spark, path.rstrip("/")):
        value = F.col(partition_col).cast("string")
        touched = [r[0] for r in batch.select(value).distinct().collect()]
        there = value.isin([v for v in touched if v is not None])
        if None in touched:
            there = F.coalesce(there, F.lit(False)) | value.isNull()
        target = read_partitioned(spark, path, {partition_col: kind}).where(there)
    if target is None:
        merged = merge(None, batch) if first else batch
    else:
        merged = merge(target, batch)
    replace_partitions(spark, merged, path, (partition_col,), staging=staging, run=run)


@dataclass(frozen=True)
class Contract:
    """Declared types, NOT NULL columns, closed ranges and defaults."""

    types: dict[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


def _violation(c: Contract) -> Column:
    conds = [F.col(n).isNull() for n in c.not_null]
    conds += [F.col(n).isNotNull() & ~F.col(n).between(lo, hi) for n, (lo, hi) in c.ranges.items()]
    out = F.lit(False)
    for x in conds:
        out = out | F.coalesce(x, F.lit(True))
    return out


def enforce_contract(df: DataFrame, c: Contract) -> tuple[DataFrame, DataFrame]:
    """Apply defaults and declared types, then split into (good, bad)."""
    shaped = df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in c.defaults.items() if k in df.columns})
    shaped = shaped.withColumns({k: F.col(k).cast(t) for k, t in c.types.items() if k in df.columns})
    bad = _violation(c)
    return shaped.filter(~bad), shaped.filter(bad)


def assert_contract(df: DataFrame, c: Contract) -> DataFrame:
    """Strict form: the first violating row fails the job (``raise_error``)."""
    shaped, _ = enforce_contract(df, Contract(types=c.types, defaults=c.defaults))
    # a predicate, not a projected column: a dropped column would be pruned
    return shaped.filter(F.when(_violation(c), F.raise_error(F.lit("table contract violated"))).otherwise(F.lit(True)))
