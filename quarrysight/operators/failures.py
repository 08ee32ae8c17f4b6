"""Failure-threshold calibration from labelled machine records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.checks import exact_avg

CALIBRATION_MEASURES = {
    "air": "air_temperature_k",
    "proc": "process_temperature_k",
    "rpm": "rotational_speed_rpm",
    "torque": "torque_nm",
    "wear": "tool_wear_min",
}


def failure_calibration(labels: DataFrame, as_of, flags: dict[str, str] | None = None,
                        measures: dict[str, str] | None = None,
                        percentile: float = C.FAILURE_PERCENTILE,
                        accuracy: int = 10000) -> DataFrame:
    """Per failure type with at least one record: count, share of all
    records, five means and three P90 thresholds.

    One ``unpivot`` of the flag columns + one ``groupBy`` replace a
    filter-and-collect pass per failure type. ``accuracy`` is the sketch
    size of ``percentile_approx`` (Spark's default; its memory per group is
    bounded by it, whatever the group size).
    """
    flags = flags or dict(C.FAILURE_TYPES)
    m = {**CALIBRATION_MEASURES, **(measures or {})}
    keep = [F.col(v).alias(k) for k, v in m.items()]
    long = labels.select(*keep, *[F.col(f).cast("int").alias(f) for f in flags]).unpivot(
        [k for k in m], list(flags), "flag", "hit")
    name = None
    for f, label in flags.items():
        name = F.when(F.col("flag") == f, F.lit(label)) if name is None else name.when(F.col("flag") == f, F.lit(label))
    hit = F.col("hit") == 1

    def on_hit(c: str):
        return F.when(hit, F.col(c))

    # every label row appears once per flag in ``long``, so count(*) of a
    # flag group is the record total - no second scan, no join
    per_type = long.groupBy("flag").agg(
        F.count_if(hit).alias("failure_count"),
        F.count("*").alias("total_records"),
        F.round(exact_avg(on_hit("air")), 2).alias("avg_air_temp_k"),
        F.round(exact_avg(on_hit("proc")), 2).alias("avg_process_temp_k"),
        F.round(exact_avg(on_hit("rpm")), 2).alias("avg_rotational_speed_rpm"),
        F.round(exact_avg(on_hit("torque")), 2).alias("avg_torque_nm"),
        F.round(exact_avg(on_hit("wear")), 2).alias("avg_tool_wear_min"),
        F.round(F.percentile_approx(on_hit("proc"), percentile, accuracy), 2).alias("temp_threshold_k"),
        F.round(F.percentile_approx(on_hit("torque"), percentile, accuracy), 2).alias("torque_threshold_nm"),
        F.round(F.percentile_approx(on_hit("wear"), percentile, accuracy), 2).alias("wear_threshold_min"),
    )
    return per_type.filter(F.col("failure_count") > 0).select(
        name.alias("failure_type"), "failure_count", "total_records",
        F.round(F.col("failure_count") / F.col("total_records") * 100, 4).alias("failure_rate_pct"),
        "avg_air_temp_k", "avg_process_temp_k", "avg_rotational_speed_rpm", "avg_torque_nm", "avg_tool_wear_min",
        "temp_threshold_k", "torque_threshold_nm", "wear_threshold_min",
        as_of.alias("calculated_at"),
    )
