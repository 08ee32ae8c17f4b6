"""Daily health: component scores, weighted health, status, trend, estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import HealthParams
from ..functions import scores as S

HEALTH_COLUMNS = (
    "equipment_id", "equipment_type", "score_date", "site_location",
    "temperature_score", "pressure_score", "vibration_score", "performance_score",
    "health_score", "health_status", "health_score_prev_day", "health_trend",
    "days_to_maintenance_estimate", "calculated_at",
)


def component_scores(daily: DataFrame, p: HealthParams = C.HEALTH) -> DataFrame:
    """Expects the roll-up columns (``daily_max_temp``, ``daily_avg_oil_press``,
    ``daily_avg_hyd_press``, ``daily_max_vib``, ``daily_avg_quality``,
    ``daily_utilization``, ``daily_anomaly_count``) and ``max_safe_temp``."""
    return daily.withColumns(
        {
            "temperature_score": S.temperature_score("daily_max_temp", "max_safe_temp", p),
            "pressure_score": S.pressure_score("daily_avg_oil_press", "daily_avg_hyd_press", p),
            "vibration_score": S.vibration_score("daily_max_vib", p),
            "performance_score": S.performance_score("daily_avg_quality", "daily_utilization", "daily_anomaly_count", p),
        }
    ).withColumn(
        "health_score", S.health_score("temperature_score", "pressure_score", "vibration_score", "performance_score", p)
    ).withColumn("health_status", S.health_status("health_score", p))


def with_trend(scored: DataFrame, unit_col: str = "equipment_id", date_col: str = "kpi_date",
               tie_cols: tuple[str, ...] = ("site_location", "equipment_type"), p: HealthParams = C.HEALTH) -> DataFrame:
    """``lag`` over the unit's previous available row (not calendar day).

    The window runs over the daily table - one row per unit-day(-site) -
    so its partitions are bounded by the number of days, not by readings.
    ``tie_cols`` order rows of the same day (a unit seen at two sites or
    under two types that day) so the result is deterministic.
    """
    w = Window.partitionBy(unit_col).orderBy(F.col(date_col), *[F.col(c).asc_nulls_first() for c in tie_cols])
    return (
        scored.withColumn("health_score_prev_day", F.lag("health_score").over(w))
        .withColumn("health_trend", S.health_trend("health_score", "health_score_prev_day", p))
        .withColumn("days_to_maintenance_estimate",
                    S.days_to_maintenance("health_score", "health_score_prev_day", "health_trend"))
    )


def health_scores(daily_with_limits: DataFrame, as_of: Column, p: HealthParams = C.HEALTH,
                  date_col: str = "kpi_date") -> DataFrame:
    """Roll-up + limits -> the 14-column health table."""
    scored = with_trend(component_scores(daily_with_limits, p), date_col=date_col, p=p)
    return scored.withColumns({"calculated_at": as_of, "score_date": F.col(date_col)}).select(*HEALTH_COLUMNS)


STORED = "_stored"


def health_scores_touching(daily_with_limits: DataFrame, stored: DataFrame | None, as_of: Column,
                           p: HealthParams = C.HEALTH, date_col: str = "kpi_date") -> DataFrame:
    """What changes in the health table if the days in ``daily_with_limits`` are computed
    anew, whichever days these are: their rows, and those of ``stored`` (rows of all other
    days) whose unit's previous row is now another one. ``_stored`` tells them apart.

    One window over the unit's days finds both a new row's predecessor among the stored
    rows and a new row's successor. Only units with new rows are looked at, and of stored
    rows only what the trend needs. Without ``stored`` this is :func:`health_scores`."""
    scored = component_scores(daily_with_limits, p).withColumns({"score_date": F.col(date_col), "calculated_at": as_of})
    new = scored.select(*[c for c in HEALTH_COLUMNS if c in scored.columns], F.lit(False).alias(STORED))
    if stored is not None:
        units = scored.select(F.col("equipment_id").alias("_unit")).distinct()
        old = (stored.select(*HEALTH_COLUMNS, F.lit(True).alias(STORED))
               .join(units, F.col("equipment_id") == F.col("_unit"), "left_semi"))
        new = new.unionByName(old, allowMissingColumns=True)
    else:
        new = new.withColumn("health_score_prev_day", F.lit(None).cast("double"))
    was = new.withColumn("_was", F.col("health_score_prev_day"))
    out = with_trend(was, date_col="score_date", p=p)
    return out.where(~F.col(STORED) | ~F.col("_was").eqNullSafe(F.col("health_score_prev_day"))).select(*HEALTH_COLUMNS, STORED)
