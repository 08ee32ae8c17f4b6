"""The reporting queries (four dashboard pages + the plant/failure page),
each a function of the layer tables returning a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.checks import exact_avg, exact_sum, severity_rank
from ..operators.quality import distinct_units, latest, quality_distribution


# ------------------------------------------------------------ page 1: fleet
def total_units_latest(health: DataFrame) -> DataFrame:                       # B1.1
    return distinct_units(latest(health))


def availability_latest(health: DataFrame) -> DataFrame:                      # B1.2
    h = latest(health)
    return h.agg(F.round(F.sum(F.when(F.col("health_status") != "critical", 1).otherwise(0)) * 100.0
                         / F.count("*"), 1).cast("double").alias("fleet_availability_pct"))


def avg_health_latest(health: DataFrame) -> DataFrame:                        # B1.3
    return latest(health).agg(F.round(exact_avg("health_score"), 1).alias("avg_health_score"))


def open_critical_alerts(alerts: DataFrame) -> DataFrame:                     # B1.4
    return alerts.filter((F.col("severity") == "critical") & (F.col("acknowledged") == F.lit(False))) \
        .agg(F.count("*").alias("critical_alerts"))


def status_distribution_latest(health: DataFrame) -> DataFrame:               # B1.5
    return latest(health).groupBy("health_status").agg(F.count("*").alias("equipment_count")) \
        .orderBy(severity_rank("health_status", C.SEVERITY_RANK))


def daily_health_trend(health: DataFrame) -> DataFrame:                       # B1.6
    return health.groupBy("score_date").agg(
        F.round(exact_avg("health_score"), 2).alias("avg_health_score"),
        F.round(F.min("health_score"), 2).alias("min_health_score"),
        F.round(F.max("health_score"), 2).alias("max_health_score"),
    ).orderBy("score_date")


def utilization_by_type(kpis: DataFrame) -> DataFrame:                        # B1.7
    return kpis.groupBy("kpi_date", "equipment_type").agg(
        F.round(exact_avg("utilization_pct"), 2).alias("avg_utilization_pct")).orderBy("kpi_date", "equipment_type")


def daily_anomalies_by_severity(events: DataFrame) -> DataFrame:              # B1.8
    return events.groupBy(F.to_date("event_timestamp").alias("event_date"), "severity") \
        .agg(F.count("*").alias("anomaly_count")).orderBy("event_date", "severity")


def daily_payload(kpis: DataFrame, type_value: str = "haul_truck") -> DataFrame:  # B1.9
    return kpis.filter(F.col("equipment_type") == type_value).groupBy("kpi_date").agg(
        F.round(exact_sum("total_payload_tonnes"), 0).alias("total_payload_tonnes")).orderBy("kpi_date")


# ---------------------------------------------------------- page 2: drill
def latest_scorecard(health: DataFrame) -> DataFrame:                         # B2.1
    return latest(health).select(
        "equipment_id", "equipment_type", "health_score", "health_status", "temperature_score", "pressure_score",
        "vibration_score", "performance_score", "health_trend", "days_to_maintenance_estimate",
    ).orderBy("health_score")


def score_history(health: DataFrame) -> DataFrame:                            # B2.2
    return health.select("score_date", "equipment_id", "health_score").orderBy("equipment_id", "score_date")


# --- fixed values: component labels of the breakdown ---
COMPONENTS = (("temperature_score", "Temperature"), ("pressure_score", "Pressure"),
              ("vibration_score", "Vibration"), ("performance_score", "Performance"))


def component_breakdown(health: DataFrame) -> DataFrame:                      # B2.3
    """Long form of the four components on the latest day: one ``unpivot``
    (one scan) instead of a four-branch UNION ALL."""
    h = latest(health).select("equipment_id", *[F.col(c).alias(label) for c, label in COMPONENTS])
    return h.unpivot("equipment_id", [label for _, label in COMPONENTS], "component", "score") \
        .orderBy("equipment_id", "component")


def hourly_trend(kpis: DataFrame, type_value: str, cols: dict[str, tuple[str, int]],
                 not_null: str, keys: tuple[str, ...] = ("kpi_hour", "equipment_id"),
                 order: tuple[str, ...] = ("equipment_id", "kpi_hour")) -> DataFrame:  # B2.4-B2.7
    """Generic hourly drill-down: one type, rounded measures, non-null filter."""
    return kpis.filter((F.col("equipment_type") == type_value) & F.col(not_null).isNotNull()).select(
        *keys, *[F.round(src, d).alias(name) for name, (src, d) in cols.items()]).orderBy(*order)


def engine_temp_trend(kpis: DataFrame) -> DataFrame:                          # B2.4
    return hourly_trend(kpis, "haul_truck", {"avg_engine_temp": ("avg_engine_temp_c", 2),
                                             "max_engine_temp": ("max_engine_temp_c", 2)}, "avg_engine_temp_c")


def conveyor_vibration_trend(kpis: DataFrame) -> DataFrame:                   # B2.5
    return hourly_trend(kpis, "conveyor", {"avg_vibration_rms": ("avg_vibration_rms", 3),
                                           "max_vibration_rms": ("max_vibration_rms", 3)}, "avg_vibration_rms")


def crusher_gap_power(kpis: DataFrame) -> DataFrame:                          # B2.6
    return hourly_trend(kpis, "crusher", {"avg_css_mm": ("avg_css_mm", 2), "avg_power_draw_kw": ("avg_power_draw_kw", 2),
                                          "avg_feed_rate_tph": ("avg_feed_rate_tph", 1)}, "avg_css_mm",
                        keys=("equipment_id", "kpi_hour"), order=("kpi_hour",))


def excavator_cycle_trend(kpis: DataFrame) -> DataFrame:                      # B2.7
    return hourly_trend(kpis, "excavator", {"avg_cycle_time_sec": ("avg_cycle_time_sec", 1),
                                            "avg_hydraulic_pressure_bar": ("avg_hydraulic_pressure_bar", 1)},
                        "avg_cycle_time_sec")


# --------------------------------------------------------- page 3: alerts
def open_alerts(alerts: DataFrame) -> DataFrame:                              # B3.1
    return alerts.filter(F.col("acknowledged") == F.lit(False)).select(
        "alert_id", "equipment_id", "equipment_type", "severity", "alert_type", "title", "description",
        "recommended_action", F.round("health_score", 1).alias("health_score"), "alert_timestamp",
    ).orderBy(severity_rank("severity", C.SEVERITY_RANK[:3]).asc_nulls_first(), F.col("alert_timestamp").desc())


def anomalies_by_unit_severity(events: DataFrame) -> DataFrame:               # B3.2
    return events.groupBy("equipment_id", "severity").agg(F.count("*").alias("anomaly_count")) \
        .orderBy("equipment_id", "severity")


def anomalies_by_sensor(events: DataFrame) -> DataFrame:                      # B3.3
    return events.groupBy("sensor_name").agg(
        F.count("*").alias("event_count"),
        F.round(exact_avg("sensor_value"), 2).alias("avg_sensor_value"),
        F.round(exact_avg("threshold_value"), 2).alias("threshold"),
    ).orderBy(F.desc("event_count"))


def anomaly_timeline(events: DataFrame) -> DataFrame:                         # B3.4
    return events.groupBy(F.to_date("event_timestamp").alias("event_date"), "equipment_id") \
        .agg(F.count("*").alias("anomaly_count")).orderBy("event_date", "equipment_id")


def alerts_by_unit_type(alerts: DataFrame) -> DataFrame:                      # B3.5
    return alerts.groupBy("equipment_id", "alert_type").agg(F.count("*").alias("alert_count")) \
        .orderBy(F.desc("alert_count"))


# ---------------------------------------------------------- page 4: quality
def row_counts(tables: dict[str, DataFrame]) -> DataFrame:                    # B4.1
    parts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "records")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def funnel(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:  # B4.2
    r = row_counts({"Bronze Input": bronze, "Silver Output": silver, "Quarantined": quarantine})
    return r.withColumnRenamed("table_name", "stage")


def funnel_of(counts: DataFrame) -> DataFrame:                                # B4.2
    """The funnel's rows from ``clean.stage_counts``."""
    stages = {"Bronze Input": "bronze_records", "Silver Output": "silver_records", "Quarantined": "quarantined_records"}
    return counts.select(F.inline(F.array(*[F.struct(F.lit(k).alias("stage"), F.col(c).alias("records")) for k, c in stages.items()])))


def quality_bands(silver: DataFrame) -> DataFrame:                            # B4.3
    return quality_distribution(silver, C.QUALITY_BANDS_DASHBOARD).orderBy("quality_band")


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:                   # B4.4
    return quarantine.groupBy("quarantine_reason").agg(F.count("*").alias("records")).orderBy(F.desc("records"))


def freshness(tables: dict[str, tuple[DataFrame, str]], now: Column) -> DataFrame:  # B4.5
    """Latest timestamp per table and whole minutes behind ``now``."""
    parts = [df.agg(F.max(col).alias("latest_record")).select(
                 F.lit(name).alias("table_name"), "latest_record",
                 F.timestamp_diff("MINUTE", F.col("latest_record"), now).alias("minutes_behind"))
             for name, (df, col) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rows_per_type(silver: DataFrame) -> DataFrame:                            # B4.6
    return silver.groupBy("equipment_type").agg(F.count("*").alias("record_count")).orderBy(F.desc("record_count"))


def rows_per_ingestion_day(bronze: DataFrame, date_col: str = "ingestion_date") -> DataFrame:  # B4.7
    return bronze.groupBy(F.col(date_col).alias("ingestion_date")).agg(F.count("*").alias("records_ingested")) \
        .orderBy("ingestion_date")


# ------------------------------------------------- page 5: plant, failures
def silica_trend(quality: DataFrame, n: int = 500) -> DataFrame:              # B5.1
    """First ``n`` hours (a chart window: the limit is the feature)."""
    return quality.orderBy("score_date", "score_hour").select(
        "score_date", "score_hour", "avg_silica_concentrate_pct", "process_quality_score",
        "silica_breach_rate_pct").limit(n)


def iron_vs_silica(quality: DataFrame, n: int = 1000) -> DataFrame:           # B5.3
    return quality.orderBy("score_date", "score_hour").select(
        "avg_iron_concentrate_pct", "avg_silica_concentrate_pct", "process_quality_score").limit(n)


def failure_types(predictions: DataFrame) -> DataFrame:                       # B5.4
    return predictions.select("failure_type", "failure_count", "failure_rate_pct", "temp_threshold_k",
                              "torque_threshold_nm", "wear_threshold_min").orderBy(F.desc("failure_count"))
