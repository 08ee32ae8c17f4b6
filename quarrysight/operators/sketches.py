"""Aggregates kept between runs: each batch adds a row per group, nothing old is read again.

Counts, sums and extremes merge exactly (sums in the fixed point of ``functions.checks``);
percentiles merge as KLL sketches, whose rank error is about 2.3 / K^0.9 (0.25 % with the K
used) whatever the number of batches, and 0 for groups of fewer rows than K.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.checks import EXACT_PRECISION, EXACT_SCALE, fixed_point, keeps_digits
from .failures import CALIBRATION_MEASURES

K = 2048


def mean_sums(x: Column, name: str) -> list[Column]:
    """What a batch stores of a mean."""
    fixed = fixed_point(x)
    return [F.count(x).alias(f"{name}_n"), F.count(fixed).alias(f"{name}_nf"),
            F.sum(fixed).cast(f"decimal(38,{EXACT_SCALE})").alias(f"{name}_sf"), F.sum(x).alias(f"{name}_s"),
            F.max(F.abs(x)).alias(f"{name}_top")]


def add_means(name: str) -> list[Column]:
    """The same over the rows of several batches."""
    return [*[F.sum(f"{name}_{c}").alias(f"{name}_{c}") for c in ("n", "nf", "sf", "s")], F.max(f"{name}_top").alias(f"{name}_top")]


def mean_of(name: str) -> Column:
    """``exact_avg`` of all rows, from the sums."""
    exact = (F.col(f"{name}_sf").cast(f"decimal({EXACT_PRECISION + 10},{EXACT_SCALE})")
             / F.col(f"{name}_n").cast("decimal(10,0)")).cast(f"decimal(38,{EXACT_SCALE + 4})").cast("double")
    return F.when(keeps_digits(F.col(f"{name}_nf"), F.col(f"{name}_n"), F.col(f"{name}_top")), exact).otherwise(
        F.col(f"{name}_s") / F.col(f"{name}_n"))


def sketch(x: Column, name: str) -> Column:
    return F.kll_sketch_agg_double(x, F.lit(K)).alias(f"{name}_kll")


def add_sketches(name: str) -> Column:
    return F.kll_merge_agg_double(f"{name}_kll", F.lit(K)).alias(f"{name}_kll")


def quantile_of(name: str, share: float) -> Column:
    """The ``share`` quantile, a value of the data; NULL of no rows."""
    sketched = F.col(f"{name}_kll")
    return F.when(F.kll_sketch_get_n_double(sketched) > 0, F.kll_sketch_get_quantile_double(sketched, F.lit(share)))


# ------------------------------------------------------------- calibration

PERCENTILES = {"proc": "temp_threshold_k", "torque": "torque_threshold_nm", "wear": "wear_threshold_min"}
MEANS = {"air": "avg_air_temp_k", "proc": "avg_process_temp_k", "rpm": "avg_rotational_speed_rpm", "torque": "avg_torque_nm",
         "wear": "avg_tool_wear_min"}


def calibration_partials(labels: DataFrame, flags: dict[str, str] | None = None,
                         measures: dict[str, str] | None = None) -> DataFrame:
    """What one batch of labelled records adds: a row per failure flag."""
    flags = flags or dict(C.FAILURE_TYPES)
    m = {**CALIBRATION_MEASURES, **(measures or {})}
    hits = F.array(*[F.when(F.col(f).cast("int") == 1, F.lit(f)) for f in flags])
    rows = labels.select(*[F.col(c).cast("double").alias(k) for k, c in m.items()], hits.alias("_hits"))
    per = (
        rows.select(*m, F.explode(F.array_compact("_hits")).alias("flag")).groupBy("flag")
        .agg(F.count("*").alias("failure_count"), *[c for k in m for c in mean_sums(F.col(k), k)],
             *[sketch(F.col(k), k) for k in PERCENTILES]))
    # the batch's size once, under no flag
    return per.unionByName(rows.agg(F.count("*").alias("total_records")).withColumn("flag", F.lit("")), allowMissingColumns=True)


def calibration_from(partials: DataFrame, as_of: Column, flags: dict[str, str] | None = None,
                     percentile: float = C.FAILURE_PERCENTILE) -> DataFrame:
    """A7 of all batches together, as ``failures.failure_calibration`` gives it."""
    flags = flags or dict(C.FAILURE_TYPES)
    total = partials.agg(F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"))
    name = F.create_map(*[F.lit(x) for kv in flags.items() for x in kv])[F.col("flag")]
    per = partials.where("flag != ''").groupBy("flag").agg(
        F.sum("failure_count").alias("failure_count"), *[c for k in MEANS for c in add_means(k)],
        *[add_sketches(k) for k in PERCENTILES])
    records = total.scalar()
    return per.withColumn("total_records", records).select(
        name.alias("failure_type"), "failure_count", "total_records",
        F.round(F.col("failure_count") / F.col("total_records") * 100, 4).alias("failure_rate_pct"),
        *[F.round(mean_of(k), 2).alias(out) for k, out in MEANS.items()],
        *[F.round(quantile_of(k, percentile), 2).alias(out) for k, out in PERCENTILES.items()],
        as_of.alias("calculated_at"))


# ------------------------------------------------------------------ latency

def latency_partials(lags: DataFrame, lag: Column) -> DataFrame:
    """What one batch adds to A9: one row."""
    x = lag.cast("double")
    return lags.agg(*mean_sums(x, "lag"), F.max(x).alias("max_lag_sec"), F.min(x).alias("min_lag_sec"), sketch(x, "lag"))


def latency_from(partials: DataFrame, percentile: float = C.LATENCY_PERCENTILE) -> DataFrame:
    total = partials.agg(*add_means("lag"), F.max("max_lag_sec").alias("max_lag_sec"), F.min("min_lag_sec").alias("min_lag_sec"),
                         add_sketches("lag"))
    return total.select(mean_of("lag").alias("avg_lag_sec"), "max_lag_sec", "min_lag_sec",
                        quantile_of("lag", percentile).alias("p95_lag_sec"))
