"""Maintenance alerts: every rule is tested on a row in one projection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import AlertRule
from ..functions.text import stable_id

_PART = re.compile(r"\[([^\]]*)\]|\{(\w+)(?::(\d))?\}")


def fill(template: str) -> Column:
    """A text with ``{column}`` (``{column:1}``: rounded to one digit) and
    ``[optional parts]``, which vanish if a column in them is NULL; a NULL
    elsewhere makes the whole text NULL."""
    parts, at = [F.lit("")], 0
    for m in _PART.finditer(template):
        parts.append(F.lit(template[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            parts.append(F.coalesce(fill(m[1]), F.lit("")))
        else:
            parts.append((F.round(m[2], int(m[3])) if m[3] else F.col(m[2])).cast("string"))
    return F.concat(*parts, F.lit(template[at:]))


def _candidate(rule: AlertRule, day: str, as_of: Column, columns: list[str]) -> Column:
    known = {
        "alert_id": stable_id("equipment_id", day, "site_location", F.lit(rule.alert_type)),
        "alert_timestamp": F.col("calculated_at") if "calculated_at" in columns else as_of,
        "alert_date": F.col(day),
        "severity": F.expr(rule.severity),
        "alert_type": F.lit(rule.alert_type),
        "title": fill(rule.title),
        "description": fill(rule.description),
        "recommended_action": F.expr(rule.action),
    }
    return F.when(F.expr(rule.when), F.struct(*[v.alias(k) for k, v in known.items()]))


def raise_alerts(rows: DataFrame, rules: tuple[AlertRule, ...], as_of: Column, day: str = "score_date") -> DataFrame:
    """One alert per row and rule that holds on it: the candidates are an array
    built in the scan of ``rows``, so no rule needs a pass or a union. The
    alert keeps its row's ``site_location``."""
    candidates = F.array_compact(F.array(*[_candidate(r, day, as_of, rows.columns) for r in rules]))
    score = F.col("health_score") if "health_score" in rows.columns else F.lit(None).cast("double")
    return rows.select(
        "equipment_id", "equipment_type", "site_location", score.alias("health_score"), F.explode(candidates).alias("_a")
    ).select("equipment_id", "equipment_type", "site_location", "health_score", "_a.*",
             F.lit(False).alias("acknowledged"), as_of.alias("created_at"))


def health_alerts(health: DataFrame, as_of: Column) -> DataFrame:
    """Units in critical or warning health."""
    return raise_alerts(health, (C.HEALTH_ALERT,), as_of)


def trend_alerts(health: DataFrame, as_of: Column) -> DataFrame:
    """Units on watch whose health falls."""
    return raise_alerts(health, (C.TREND_ALERT,), as_of)


def all_alerts(health: DataFrame, as_of: Column) -> DataFrame:
    return raise_alerts(health, (C.HEALTH_ALERT, C.TREND_ALERT), as_of)


def anomaly_frequency_alerts(daily: DataFrame, as_of: Column, max_flags: float,
                             date_col: str = "kpi_date") -> DataFrame:
    """A unit-day with more flagged readings than ``max_flags``."""
    limited = daily.withColumn("max_flags", F.lit(f"{max_flags:g}"))
    return raise_alerts(limited, (C.FREQUENCY_ALERT,), as_of, date_col)


def threshold_alerts(events: DataFrame, as_of: Column, day: str = "event_date") -> DataFrame:
    """A unit-day and sensor with critical threshold events -> one alert
    with their number and the highest value. ``events`` carry ``site_location``."""
    worst = (
        events.where(F.col("severity") == "critical")
        .groupBy("equipment_id", "equipment_type", "site_location", day, "sensor_name")
        .agg(F.count("*").alias("n_events"), F.max("sensor_value").alias("worst_value"))
    )
    out = raise_alerts(worst, (C.THRESHOLD_ALERT,), as_of, day)
    # one per sensor: its name is part of the text and so of the id
    return out.withColumn("alert_id", stable_id("alert_id", "title"))
