"""Anomaly events: threshold rules (one scan for all rules) and the
statistical detectors the reference announces but never computes (ours)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import ThresholdSpec
from ..functions import moments as M
from ..functions.text import stable_id

EVENT_COLUMNS = (
    "event_id", "equipment_id", "equipment_type", "event_timestamp", "anomaly_type", "severity",
    "sensor_name", "sensor_value", "threshold_value", "z_score", "description", "detected_at",
)


def _with_value(sql: str, value_col: str) -> str:
    return re.sub(r"\bsensor_value\b", value_col, sql)


def threshold_events(silver: DataFrame, specs: tuple[ThresholdSpec, ...], as_of: Column,
                     unit_col: str = "equipment_id", type_col: str = "equipment_type",
                     ts_col: str = "reading_timestamp") -> DataFrame:
    """Every rule becomes a nullable struct; ``inline(array_compact(...))``
    turns the matches into rows. All rules share one scan of silver instead
    of one scan per ``unionByName`` branch.

    A reading yields an event when its value exceeds the least severe rung;
    its severity is the first rung it exceeds (so a negative limit still
    reports "critical", as the reference's two-step test does).
    """
    values = {f"_v{i}": F.expr(s.value_sql) for i, s in enumerate(specs)}
    base = silver.withColumns(values)
    candidates = []
    for i, s in enumerate(specs):
        v = F.col(f"_v{i}")
        sev = None
        for bound, label in s.ladder:
            cond = v > F.expr(bound)
            sev = F.when(cond, F.lit(label)) if sev is None else sev.when(cond, F.lit(label))
        fires = (
            (F.col(type_col) == F.lit(s.equipment_type))
            & F.coalesce(F.expr(s.status_sql), F.lit(False))
            & F.coalesce(v > F.expr(s.ladder[-1][0]), F.lit(False))
        )
        event = F.struct(
            F.lit(s.anomaly_type).alias("anomaly_type"),
            sev.alias("severity"),
            F.lit(s.sensor_name).alias("sensor_name"),
            v.cast("double").alias("sensor_value"),
            F.expr(s.threshold_sql).cast("double").alias("threshold_value"),
            F.expr(_with_value(s.description_sql, f"_v{i}")).alias("description"),
        )
        candidates.append(F.when(fires, event))
    exploded = base.select(
        F.col(unit_col).alias("equipment_id"),
        F.col(type_col).alias("equipment_type"),
        F.col(ts_col).alias("event_timestamp"),
        F.inline(F.array_compact(F.array(*candidates))),
    )
    return exploded.select(
        stable_id("equipment_id", "event_timestamp", "sensor_name").alias("event_id"),
        "equipment_id", "equipment_type", "event_timestamp", "anomaly_type", "severity",
        "sensor_name", "sensor_value", "threshold_value",
        F.lit(None).cast("double").alias("z_score"),
        "description",
        as_of.alias("detected_at"),
    )


def threshold_events_by_union(silver: DataFrame, specs: tuple[ThresholdSpec, ...], as_of: Column, **kw) -> DataFrame:
    """The simple form: one filtered branch per rule, ``unionByName``.
    Same rows as :func:`threshold_events`; scans silver once per rule."""
    parts = [threshold_events(silver, (s,), as_of, **kw) for s in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- extensions

def zscore_anomalies(readings: DataFrame, sensor: str, as_of: Column, unit_col: str = "equipment_id",
                     type_col: str = "equipment_type", ts_col: str = "reading_timestamp",
                     baseline_hours: int = 24, z_threshold: float = 3.0, min_count: int = 3) -> DataFrame:
    """(Extension) z-score of each reading against the unit's readings of the
    preceding ``baseline_hours`` whole hours.

    Skew-safe: the baseline is built from per-(unit, hour) moments (a
    map-side-combined ``groupBy``), of which a window on that small table
    collects the preceding hours, at most ``baseline_hours``, and merges them
    pair by pair in time order; joined back on (unit, hour). No window ever
    spans all raw readings of one unit, and large values lose no digits
    (``functions/moments.py``).
    """
    hour = F.date_trunc("hour", F.col(ts_col)).cast("timestamp")
    x = readings.select(unit_col, type_col, ts_col, F.col(sensor).cast("double").alias("_x"), hour.alias("_h"))
    hourly = (x.filter(F.col("_x").isNotNull())
              .groupBy(unit_col, "_h").agg(*M.moment_sums(F.col("_x"))).select(unit_col, "_h", M.moments().alias("_m")))
    w = (Window.partitionBy(unit_col).orderBy(F.col("_h").cast("long"))
         .rangeBetween(-baseline_hours * 3600, -1))
    # the window's rows come in the order of their hours
    base = hourly.select(unit_col, "_h", F.collect_list("_m").over(w).alias("_before")).select(
        unit_col, "_h", M.merged(F.col("_before")).alias("_b"))
    stats = base.filter(F.col("_b.n") >= min_count).select(
        unit_col, "_h", "_b", M.mean(F.col("_b")).alias("_mean"), M.std(F.col("_b")).alias("_std"))
    z = M.distance(F.col("_x"), F.col("_b")) / F.col("_std")
    scored = x.join(stats, [unit_col, "_h"], "inner").filter(F.col("_std") > 0).withColumn("_z", z)
    hits = scored.filter(F.abs(F.col("_z")) > z_threshold)
    return hits.select(
        stable_id(unit_col, ts_col, F.lit(sensor), F.lit("zscore")).alias("event_id"),
        F.col(unit_col).alias("equipment_id"),
        F.col(type_col).alias("equipment_type"),
        F.col(ts_col).alias("event_timestamp"),
        F.lit("zscore").alias("anomaly_type"),
        F.when(F.abs(F.col("_z")) > 2 * z_threshold, "critical").otherwise("warning").alias("severity"),
        F.lit(sensor).alias("sensor_name"),
        F.col("_x").alias("sensor_value"),
        F.col("_mean").alias("threshold_value"),
        F.col("_z").alias("z_score"),
        F.concat(F.lit(f"{sensor} z-score "), F.round("_z", 2).cast("string"),
                 F.lit(f" vs trailing {baseline_hours}h baseline")).alias("description"),
        as_of.alias("detected_at"),
    )


def rate_of_change_anomalies(readings: DataFrame, sensor: str, max_step: float, as_of: Column,
                             unit_col: str = "equipment_id", type_col: str = "equipment_type",
                             ts_col: str = "reading_timestamp", bucket: str = "hour") -> DataFrame:
    """(Extension) |value - previous value of the unit| > ``max_step``.

    The previous value is found inside (unit, ``bucket``) windows; the first
    reading of a bucket takes the last reading of the unit's previous
    non-empty bucket, found on a per-(unit, bucket) ``max_by`` table (a
    partial aggregation). A busy unit is therefore split into hourly windows
    instead of one window task; the result does not depend on ``bucket``.
    Ties on the timestamp are broken by the value, so the order is total.
    """
    b = F.date_trunc(bucket, F.col(ts_col)).cast("timestamp")
    x = readings.select(unit_col, type_col, ts_col, F.col(sensor).cast("double").alias("_x"), b.alias("_b")) \
        .filter(F.col("_x").isNotNull())
    w_in = Window.partitionBy(unit_col, "_b").orderBy(F.col(ts_col), F.col("_x"))
    inner = x.withColumn("_prev", F.lag("_x").over(w_in))
    last = (x.groupBy(unit_col, "_b")
            .agg(F.max_by("_x", F.struct(F.col(ts_col), F.col("_x"))).alias("_last")))
    w_b = Window.partitionBy(unit_col).orderBy("_b")
    carry = last.select(unit_col, "_b", F.lag("_last").over(w_b).alias("_carry"))
    joined = inner.join(carry, [unit_col, "_b"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    step = F.col("_x") - prev
    hits = joined.withColumn("_step", step).filter(F.abs(F.col("_step")) > max_step)
    return hits.select(
        stable_id(unit_col, ts_col, F.lit(sensor), F.lit("rate_of_change")).alias("event_id"),
        F.col(unit_col).alias("equipment_id"),
        F.col(type_col).alias("equipment_type"),
        F.col(ts_col).alias("event_timestamp"),
        F.lit("rate_of_change").alias("anomaly_type"),
        F.when(F.abs(F.col("_step")) > 2 * max_step, "critical").otherwise("warning").alias("severity"),
        F.lit(sensor).alias("sensor_name"),
        F.col("_x").alias("sensor_value"),
        F.lit(float(max_step)).alias("threshold_value"),
        F.lit(None).cast("double").alias("z_score"),
        F.concat(F.lit(f"{sensor} changed by "), F.round("_step", 2).cast("string")).alias("description"),
        as_of.alias("detected_at"),
    )


def _fleet_rule(sensor: str) -> ThresholdSpec:
    return next(s for s in C.FLEET_THRESHOLD_SPECS if s.sensor_name == sensor)


def engine_temp_anomalies(silver: DataFrame, as_of: Column) -> DataFrame:
    """Haul trucks not idle, engine temperature against the unit's limit."""
    return threshold_events(silver, (_fleet_rule("engine_temp_c"),), as_of)


def vibration_anomalies(silver: DataFrame, as_of: Column) -> DataFrame:
    """D3: running conveyors, x/y/z vibration magnitude."""
    return threshold_events(silver, (_fleet_rule("vibration_rms"),), as_of)


def crusher_vibration_anomalies(silver: DataFrame, as_of: Column) -> DataFrame:
    """Crushing crushers, crusher vibration."""
    return threshold_events(silver, (_fleet_rule("crusher_vibration_mms"),), as_of)


def oil_temp_anomalies(silver: DataFrame, as_of: Column) -> DataFrame:
    """Digging excavators, hydraulic oil temperature."""
    return threshold_events(silver, (_fleet_rule("hydraulic_oil_temp_c"),), as_of)
