"""Aggregates kept between runs, bound to the benchmark tables: three increments
are stored one after the other and only what is stored is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import distinct as DI
from ..operators import sketches as SK
from ..sources import scratch as SC
from ..sources import tables as T
from . import bindings as B

BATCHES = 3


def _kept(spark, df: DataFrame, batch: Column, make, name: str) -> DataFrame:
    """``make`` of each of three increments of ``df``, as stored partials."""
    path = SC.run_folder(spark, name)
    schema = None
    for k in range(BATCHES):
        part = make(df.where(batch == k)).withColumn("batch_id", F.lit(k))
        schema = part.schema
        T.write_table(part, path, "overwrite", ("batch_id",))
    return spark.read.schema(schema).parquet(path)


def q_kept_calibration(spark, sf_dir):
    """Failure calibration of three increments; the thresholds by their rank."""
    labels = B.labelled_records(spark, sf_dir)
    partials = _kept(spark, labels, F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)),
                     lambda b: SK.calibration_partials(b, B.LABEL_FLAGS), "calibration")
    got = SK.calibration_from(partials, B.as_of(), B.LABEL_FLAGS)
    exact = None
    for flag, label in B.LABEL_FLAGS.items():
        of = labels.where(F.col(flag) == 1).agg(
            *[F.percentile(col, p).alias(f"{name}_{side}") for name, col in (("proc", "process_temperature_k"), ("wear", "tool_wear_min"))
              for side, p in (("low", 0.89), ("high", 0.91))]).withColumn("_type", F.lit(label))
        exact = of if exact is None else exact.unionByName(of)
    return got.join(exact, F.col("failure_type") == F.col("_type")).select(
        "failure_type", "failure_count", "total_records", "failure_rate_pct", "avg_air_temp_k", "avg_torque_nm", "avg_tool_wear_min",
        # between the exact percentiles 1 % below and above
        F.col("temp_threshold_k").between(F.col("proc_low"), F.col("proc_high")).alias("temp_rank_ok"),
        F.col("wear_threshold_min").between(F.col("wear_low"), F.col("wear_high")).alias("wear_rank_ok"))


def q_kept_latency(spark, sf_dir):
    """Processing lag of three increments of the events."""
    silver = B.ev_silver(spark, sf_dir)
    lag = F.timestamp_diff("SECOND", F.col("bronze_ingestion_timestamp"), F.col("silver_processed_timestamp"))
    rows = SC.materialize(silver.select(lag.alias("lag"), F.pmod(F.xxhash64("equipment_id", "reading_timestamp"), F.lit(BATCHES)).alias("b")))
    got = SK.latency_from(_kept(spark, rows, F.col("b"), lambda p: SK.latency_partials(p, F.col("lag")), "latency"))
    rank = rows.select(F.percentile("lag", 0.94).alias("low"), F.percentile("lag", 0.96).alias("high"))
    low, high = rank.select("low").scalar(), rank.select("high").scalar()
    return got.select("avg_lag_sec", F.col("max_lag_sec").cast("bigint").alias("max_lag_sec"), F.col("min_lag_sec").cast("bigint").alias("min_lag_sec"),
                      F.col("p95_lag_sec").between(low, high).alias("p95_rank_ok"))


def q_kept_distinct(spark, sf_dir):
    """Distinct users of the 7 days up to each day, from three increments' bitmaps."""
    ev = B.table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), "user_id", "event_id")
    stored = _kept(spark, ev, F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)),
                   lambda b: DI.daily_bitmaps(b, F.col("d"), F.col("user_id")), "bitmaps")
    bitmaps = SC.materialize(DI.add_bitmaps(stored))
    days = bitmaps.select(F.date_sub("day", 6).alias("first"), F.col("day").alias("last"))
    return DI.distinct_in_ranges(bitmaps, days).select(F.col("last").alias("day"), "units")


QUERIES = {"kept_calibration": q_kept_calibration, "kept_latency": q_kept_latency, "kept_distinct": q_kept_distinct}

ORACLE = {
    "kept_distinct": """SELECT d.day, count(DISTINCT user_id) AS units
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day - 6 AND d.day
GROUP BY d.day""",
}
