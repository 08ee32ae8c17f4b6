"""Period KPIs per unit (hourly in the reference) and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import KpiMeasure, StatusGroups
from ..functions.checks import exact_avg, exact_sum
from ..functions.timestamps import truncate
from ..functions.vectors import magnitude

FLEET_KPI_KEYS = ("equipment_id", "equipment_type", "kpi_hour", "kpi_date", "site_location")
FLEET_DAILY_KEYS = ("equipment_id", "equipment_type", "kpi_date", "site_location")


def fleet_vibration_rms(type_col: str = "equipment_type") -> Column:
    """Gold vibration: conveyor x/y/z magnitude with a missing axis as 0,
    crusher's own vibration column, NULL for other types."""
    return (
        F.when(F.col(type_col) == "conveyor",
               magnitude("vibration_x_mms", "vibration_y_mms", "vibration_z_mms", null_as_zero=True))
        .when(F.col(type_col) == "crusher", F.col("crusher_vibration_mms"))
    )


def measure_column(m: KpiMeasure) -> Column:
    """Sums and means accumulate in fixed point (``exact_sum``/``exact_avg``)
    so KPIs are identical whatever the partitioning; min/max are exact."""
    x = F.expr(m.expr)
    if m.agg == "avg":
        out = exact_avg(x)
    elif m.agg == "max":
        out = F.max(x)
    elif m.agg == "min":
        out = F.min(x)
    elif m.agg == "sum":
        out = exact_sum(x)
    elif m.agg == "isum":
        # integer counts stay integer
        out = F.sum(x)
    elif m.agg == "sum_if_gt":
        # NULL, not 0, when no value passes (reference semantics)
        out = exact_sum(F.when(x > F.lit(m.arg), x))
    elif m.agg == "count_if":
        out = F.count_if(x)
    else:
        raise ValueError(f"unknown aggregate {m.agg!r}")
    return out.alias(m.name)


def status_counts(status_col: str, groups: StatusGroups) -> list[Column]:
    s = F.col(status_col)
    return [
        F.count("*").alias("total_readings"),
        F.sum(F.when(s.isin(*groups.operating), 1).otherwise(0)).alias("operating_readings"),
        F.sum(F.when(s.isin(*groups.idle), 1).otherwise(0)).alias("idle_readings"),
        F.sum(F.when(s.contains(groups.down_token), 1).otherwise(0)).alias("down_readings"),
    ]


def hourly_kpis(
    silver: DataFrame,
    measures: tuple[KpiMeasure, ...] = C.FLEET_HOURLY_MEASURES,
    status: StatusGroups = C.FLEET_STATUS,
    keys: tuple[str, ...] = FLEET_KPI_KEYS,
    ts_col: str = "reading_timestamp",
    status_col: str = "operating_status",
    grain: str = "hour",
    derived: dict[str, Column] | None = None,
) -> DataFrame:
    """Per (unit, period): status-group counts, sensor aggregates, flag
    count, mean quality and ``utilization_pct = round(op/total*100, 2)``.

    A plain ``groupBy`` - partial aggregation runs map-side, so a busy unit
    is combined before the shuffle. Groups on ``kpi_hour`` (truncated to
    ``grain``) and ``kpi_date``.
    """
    dtype = silver.schema[ts_col].dataType
    extra = dict(derived) if derived is not None else {}
    if derived is None and "vibration_rms" not in silver.columns and {"vibration_x_mms", "crusher_vibration_mms"} <= set(silver.columns):
        extra["vibration_rms"] = fleet_vibration_rms()
    df = silver.withColumns({"kpi_hour": truncate(ts_col, grain, dtype), "kpi_date": F.to_date(F.col(ts_col)), **extra})
    aggs = [
        *status_counts(status_col, status),
        *[measure_column(m) for m in measures],
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
        exact_avg("quality_score").alias("avg_quality_score"),
    ]
    out = df.groupBy(*keys).agg(*aggs)
    return out.withColumn(
        "utilization_pct", F.round(F.col("operating_readings") / F.col("total_readings") * 100, 2)
    )


def daily_rollup(
    hourly: DataFrame,
    measures: tuple[KpiMeasure, ...] = C.FLEET_DAILY_MEASURES,
    keys: tuple[str, ...] = FLEET_DAILY_KEYS,
    date_col: str = "kpi_date",
    grain: str = "day",
) -> DataFrame:
    """Unweighted mean of period means, max of maxes, sum of flag counts.
    ``grain`` above "day" (e.g. "month") re-buckets ``date_col`` first."""
    df = hourly
    if grain != "day":
        df = df.withColumn(date_col, F.trunc(F.col(date_col), grain))
    return df.groupBy(*keys).agg(*[measure_column(m) for m in measures])
