"""Bindings of the operators to the benchmark tables.

The benchmark tables are not mining telemetry, so each operator is bound to
columns that make its result non-trivial (see README "Bindings"):

* ``lineitem`` as a wide reading table: unit ``l_suppkey``, time
  ``l_shipdate``, type ``l_linestatus``, status ``l_returnflag``, sensors
  ``l_quantity, l_extendedprice, l_discount, l_tax``; registry
  ``supplier`` + ``nation`` (site = nation, limit = ``s_acctbal / 100``).
* ``events`` as an hourly reading stream: unit ``user_id``, time ``ts``,
  status ``event_type``, sensors ``value`` and ``props.k``; registry
  ``customer`` + ``nation`` (limit = ``c_acctbal / 10``).
* ``orders`` as flotation readings, ``labels`` + ``documents`` as labelled
  failure records, ``embeddings`` as vibration signals.

Every function takes ``(spark, sf_dir)``, reads whole tables and returns a
lazy DataFrame whose columns match the DuckDB oracle in ``plans/oracle.py``.
Run-time columns (``calculated_at`` etc.) take the fixed ``AS_OF`` instant.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import KpiMeasure, RangeRule, SilverSpec, StatusGroups, ThresholdSpec
from ..operators import alerts as AL
from ..operators import anomalies as AN
from ..operators import clean as CL
from ..operators import enrich as EN
from ..operators import failures as FA
from ..operators import fleet as FL
from ..operators import health as HE
from ..operators import kpis as KP
from ..operators import process as PR
from ..operators import quality as QU
from ..operators import signals as SG
from ..sources import files as SF
from ..sources import scratch as SC
from ..sources.rescue import rescue_json
from ..sources.scratch import shared_dir
from ..sources.tables import upsert_rows
from . import dashboard as DB

# --- fixed values: the instant used for every run-time column in bindings ---
AS_OF_TEXT = "2024-02-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return SF.read_table(spark, os.path.join(sf_dir, f"{name}.parquet"))


# =========================================================== lineitem fleet
# --- fixed values: lineitem reading rules (column, lo, hi, hard) ---
LI_RULES = (
    RangeRule("l_quantity", 0, 45, False),
    RangeRule("l_extendedprice", 0, 100000, True),
    RangeRule("l_discount", 0, 0.09, False),
    RangeRule("l_tax", 0, 0.07, False),
)
LI_SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "operating_status", "equipment_type")
LI_SPEC = SilverSpec(rules=LI_RULES, completeness_cols=LI_SENSORS, ingest_ts_col=None, source_col=None,
                     ts_type="timestamp_ntz")
LI_STATUS = StatusGroups(operating=("N",), idle=("A",), down_token="R")

# --- fixed values: lineitem threshold rules ---
LI_THRESHOLDS = (
    ThresholdSpec("F", "operating_status != 'A'", "l_quantity", "l_quantity",
                  (("max_engine_temp_c", "critical"), ("max_engine_temp_c * 0.9", "warning")),
                  "max_engine_temp_c",
                  "concat('Quantity ', round(l_quantity, 1), ' exceeds ', round(max_engine_temp_c * 0.9, 1), ' limit')"),
    ThresholdSpec("O", "operating_status = 'N'", "rate_magnitude",
                  "sqrt(pow(l_discount * 100, 2) + pow(l_tax * 100, 2))",
                  (("15", "critical"), ("10", "warning"), ("7.0", "watch")), "7.0",
                  "concat('Rate magnitude ', round(sensor_value, 2), ' exceeds 7.0')"),
    ThresholdSpec("O", "operating_status = 'R'", "tax_pct", "l_tax * 100",
                  (("7.5", "critical"), ("6.5", "warning"), ("5.5", "watch")), "5.5",
                  "concat('Tax ', round(sensor_value, 2), ' pct exceeds 5.5')"),
    ThresholdSpec("F", "operating_status = 'R'", "price_k", "l_extendedprice / 1000",
                  (("95", "critical"), ("85", "warning"), ("80", "watch")), "80.0",
                  "concat('Price ', round(sensor_value, 1), 'k exceeds 80k')"),
)

# --- fixed values: lineitem period KPI measures ---
LI_MEASURES = (
    KpiMeasure("avg_quantity", "avg", "l_quantity"),
    KpiMeasure("max_quantity", "max", "l_quantity"),
    KpiMeasure("avg_discount_pct", "avg", "l_discount * 100"),
    KpiMeasure("avg_price_k", "avg", "l_extendedprice / 1000"),
    KpiMeasure("max_tax_pct", "max", "l_tax * 100"),
    KpiMeasure("total_payload_tonnes", "sum_if_gt", "l_quantity", 10.0),
)
LI_ROLLUP = (
    KpiMeasure("daily_avg_temp", "avg", "avg_quantity"),
    KpiMeasure("daily_max_temp", "max", "max_quantity"),
    KpiMeasure("daily_avg_oil_press", "avg", "avg_discount_pct"),
    KpiMeasure("daily_avg_hyd_press", "avg", "avg_price_k"),
    KpiMeasure("daily_max_vib", "max", "max_tax_pct"),
    KpiMeasure("daily_utilization", "avg", "utilization_pct"),
    KpiMeasure("daily_anomaly_count", "isum", "anomaly_count"),
    KpiMeasure("daily_avg_quality", "avg", "avg_quality_score"),
)


def li_raw(spark, sf_dir) -> DataFrame:
    return li_readings(table(spark, sf_dir, "lineitem"))


def li_readings(li: DataFrame) -> DataFrame:
    """lineitem rows as landed readings (batch or stream)."""
    return li.select(
        F.col("l_suppkey").cast("string").alias("equipment_id"),
        F.col("l_linestatus").alias("equipment_type"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("l_returnflag").alias("operating_status"),
        "l_orderkey", "l_linenumber", "l_partkey", *LI_SENSORS,
    )


def li_registry(spark, sf_dir) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    nat = n.select("n_nationkey", "n_name")
    return s.join(nat, s["s_nationkey"] == nat["n_nationkey"], "inner").select(
        F.col("s_suppkey").cast("string").alias("equipment_id"),
        F.col("s_name").alias("model"),
        F.col("n_name").alias("site_location"),
        (F.col("s_acctbal") / 100.0).alias("max_engine_temp_c"),
    )


def _li_dedup(df: DataFrame) -> DataFrame:
    # explicit tie columns: the oracle cannot reproduce xxhash64
    return CL.dedup_keep_best(df, ["equipment_id", CL.PARSED], LI_SPEC, ties=LI_TIES)


def li_flagged(spark, sf_dir) -> DataFrame:
    return CL.flag_quality(CL.passing_records(li_raw(spark, sf_dir), LI_SPEC), LI_RULES)


# rows of a task that goes by unit: the buffers of the KPI and health aggregates take about
# 2 KB a row, many times the shuffled bytes by which tasks are sized otherwise
TASK_ROWS = 1 << 17


def by_unit(deduped: DataFrame, source: DataFrame) -> DataFrame:
    """``deduped`` dealt by unit to tasks of about ``TASK_ROWS`` rows of ``source``; the
    registry join, the aggregates and the trend keep this dealing."""
    tasks = -(-source.count() // TASK_ROWS)
    return deduped.repartition(max(tasks, deduped.sparkSession.sparkContext.defaultParallelism), "equipment_id")


def li_silver(spark, sf_dir, dealt: bool = False) -> DataFrame:
    deduped = _li_dedup(li_flagged(spark, sf_dir))
    if dealt:
        deduped = by_unit(deduped, table(spark, sf_dir, "lineitem"))
    return EN.enrich_with_registry(deduped, li_registry(spark, sf_dir), as_of(),
                                   registry_cols=("model", "site_location"), limit_cols=("max_engine_temp_c",))


def li_events(spark, sf_dir) -> DataFrame:
    return AN.threshold_events(li_silver(spark, sf_dir), LI_THRESHOLDS, as_of())


def li_kpis(spark, sf_dir) -> DataFrame:
    return KP.hourly_kpis(li_silver(spark, sf_dir, dealt=True), LI_MEASURES, LI_STATUS, grain="day", derived={})


# ============================================================ events fleet
# --- fixed values: events reading rules ---
EV_RULES = (
    RangeRule("value", 0, 400, True),
    RangeRule("k", 5, 95, False),
)
EV_SPEC = SilverSpec(rules=EV_RULES, completeness_cols=("value", "k"), ingest_ts_col="ingestion_timestamp",
                     source_col=None, ts_type="timestamp_ntz")
EV_STATUS = StatusGroups(operating=("click", "purchase"), idle=("view",), down_token="error")
EV_KPI_KEYS = ("equipment_id", "equipment_type", "kpi_hour", "kpi_date", "site_location")
EV_DAILY_KEYS = ("equipment_id", "equipment_type", "kpi_date", "site_location")
EV_MEASURES = (
    KpiMeasure("avg_value", "avg", "value"),
    KpiMeasure("max_value", "max", "value"),
    KpiMeasure("avg_k_tenths", "avg", "k / 10"),
    KpiMeasure("avg_vib", "avg", "value / 50"),
    KpiMeasure("max_vib", "max", "value / 50"),
    KpiMeasure("total_payload_tonnes", "sum_if_gt", "value", 100.0),
)
EV_ROLLUP = (
    KpiMeasure("daily_avg_temp", "avg", "avg_value"),
    KpiMeasure("daily_max_temp", "max", "max_value"),
    KpiMeasure("daily_avg_oil_press", "avg", "avg_k_tenths"),
    KpiMeasure("daily_avg_hyd_press", "avg", "avg_value"),
    KpiMeasure("daily_avg_vib", "avg", "avg_vib"),
    KpiMeasure("daily_max_vib", "max", "max_vib"),
    KpiMeasure("daily_utilization", "avg", "utilization_pct"),
    KpiMeasure("daily_anomaly_count", "isum", "anomaly_count"),
    KpiMeasure("daily_avg_quality", "avg", "avg_quality_score"),
)


def ev_raw(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("equipment_id"),
        F.lit("user").alias("equipment_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("event_type").alias("operating_status"),
        "event_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("ts").alias("ingestion_timestamp"),
    )


def ev_registry(spark, sf_dir) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    nat = n.select("n_nationkey", "n_name")
    return c.join(nat, c["c_nationkey"] == nat["n_nationkey"], "inner").select(
        F.col("c_custkey").cast("string").alias("equipment_id"),
        F.col("c_name").alias("model"),
        F.col("c_mktsegment").alias("manufacturer"),
        F.col("n_name").alias("site_location"),
        (F.col("c_acctbal") / 10.0).alias("max_engine_temp_c"),
        F.lit(None).cast("double").alias("max_oil_pressure_bar"),
        F.lit(None).cast("double").alias("max_payload_tonnes"),
    )


def _ev_dedup(df: DataFrame) -> DataFrame:
    return CL.dedup_keep_best(df, ["equipment_id", CL.PARSED], EV_SPEC, ties=("ingestion_timestamp", "event_id"))


def ev_silver(spark, sf_dir, dealt: bool = False) -> DataFrame:
    deduped = _ev_dedup(CL.flag_quality(CL.passing_records(ev_raw(spark, sf_dir), EV_SPEC), EV_RULES))
    if dealt:
        deduped = by_unit(deduped, table(spark, sf_dir, "events"))
    return EN.enrich_with_registry(deduped, ev_registry(spark, sf_dir), as_of())


def ev_kpis(spark, sf_dir) -> DataFrame:
    return KP.hourly_kpis(ev_silver(spark, sf_dir, dealt=True), EV_MEASURES, EV_STATUS, keys=EV_KPI_KEYS, derived={})


def ev_daily(spark, sf_dir) -> DataFrame:
    return KP.daily_rollup(ev_kpis(spark, sf_dir), EV_ROLLUP, EV_DAILY_KEYS)


def ev_health(spark, sf_dir, kpis: DataFrame | None = None) -> DataFrame:
    k = kpis if kpis is not None else ev_kpis(spark, sf_dir)
    limits = EN.join_limits(KP.daily_rollup(k, EV_ROLLUP, EV_DAILY_KEYS), ev_registry(spark, sf_dir))
    return HE.health_scores(limits, as_of())


def ev_alerts(spark, sf_dir) -> DataFrame:
    # two branches (health + trend alerts) read health: share one copy
    return AL.all_alerts(ev_health_shared(spark, sf_dir), as_of())


def ev_health_shared(spark, sf_dir) -> DataFrame:
    """Health written once (checkpoint) for queries that read it more than
    once - latest-day filters with a scalar subquery, semi-joins, unions -
    so the silver -> KPI -> health chain is not recomputed per use."""
    kpis = materialize(spark, ev_kpis(spark, sf_dir))
    return materialize(spark, ev_health(spark, sf_dir, kpis))


# ================================================================ queries

def q_range_flags(spark, sf_dir):
    f = li_flagged(spark, sf_dir)
    return f.select("equipment_id", "l_orderkey", "l_linenumber", "l_partkey",
                    F.array_join("anomaly_reasons", "|").alias("reasons"),
                    F.size("anomaly_reasons").alias("n_reasons"), "is_anomaly", "quality_score")


def q_quality_distribution(spark, sf_dir):
    return QU.quality_distribution(_li_dedup(li_flagged(spark, sf_dir)), C.QUALITY_BANDS_DASHBOARD)


def q_quarantine_split(spark, sf_dir):
    q = CL.quarantine_records(li_raw(spark, sf_dir), as_of(), LI_SPEC)
    return q.select("equipment_id", "equipment_type", "raw_timestamp", "quarantine_reason",
                    F.get_json_object("raw_record", "$.l_orderkey").cast("bigint").alias("l_orderkey"),
                    F.get_json_object("raw_record", "$.l_linenumber").cast("int").alias("l_linenumber"),
                    F.get_json_object("raw_record", "$.l_extendedprice").cast("double").alias("l_extendedprice"))


def q_dedup_keep_best(spark, sf_dir):
    d = _li_dedup(li_flagged(spark, sf_dir))
    return d.select("equipment_id", F.col(CL.PARSED).alias("reading_timestamp"), "l_orderkey", "l_linenumber",
                    "l_partkey", "quality_score")


def q_enrich_registry(spark, sf_dir):
    s = li_silver(spark, sf_dir)
    return s.select("equipment_id", "reading_timestamp", "reading_date", "model", "site_location",
                    "max_engine_temp_c", "l_orderkey", "l_linenumber", "quality_score")


def q_merge_upsert(spark, sf_dir):
    """Two loads of the whole table split by line status: the closed lines
    form the target, the open lines are merged into it."""
    f = li_flagged(spark, sf_dir)
    target = _li_dedup(f.filter(F.col("equipment_type") == "F")).withColumn("load", F.lit("target"))
    updates = _li_dedup(f.filter(F.col("equipment_type") == "O")).withColumn("load", F.lit("update"))
    merged = upsert_rows(target, updates, ["equipment_id", CL.PARSED])
    return merged.select("equipment_id", F.col(CL.PARSED).alias("reading_timestamp"), "l_orderkey",
                         "l_linenumber", "quality_score", "load")


def q_parse_timestamps(spark, sf_dir):
    """Strict parsing of the events' text timestamps: fractional seconds do
    not match ``yyyy-MM-dd HH:mm:ss`` and are routed to quarantine."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("equipment_id"), F.lit("user").alias("equipment_type"),
        F.col("ts").cast("string").alias("timestamp"), "value")
    spec = SilverSpec(ts_patterns=("yyyy-MM-dd HH:mm:ss",), rules=(), ingest_ts_col=None, source_col=None,
                      ts_type="timestamp_ntz")
    parsed = CL.with_parsed_timestamp(ev, spec)
    return parsed.select("event_id", "timestamp", CL.PARSED,
                         F.when(F.col(CL.PARSED).isNull(), F.lit(C.REASON_BAD_TS)).alias("quarantine_reason"))


def q_threshold_events(spark, sf_dir):
    e = li_events(spark, sf_dir)
    return e.select("event_id", "equipment_id", "equipment_type", "event_timestamp", "anomaly_type", "severity",
                    "sensor_name", "sensor_value", "threshold_value", "description")


def q_anomalies_by_severity(spark, sf_dir):
    return DB.daily_anomalies_by_severity(li_events(spark, sf_dir))


def q_hourly_kpis(spark, sf_dir):
    k = ev_kpis(spark, sf_dir)
    return k.select(*EV_KPI_KEYS, "total_readings", "operating_readings", "idle_readings", "down_readings",
                    *[F.round(m.name, 6).alias(m.name) for m in EV_MEASURES],
                    "anomaly_count", F.round("avg_quality_score", 6).alias("avg_quality_score"), "utilization_pct")


def q_daily_rollup(spark, sf_dir):
    d = ev_daily(spark, sf_dir)
    return d.select(*EV_DAILY_KEYS, *[F.round(m.name, 6).alias(m.name) for m in EV_ROLLUP])


def q_component_scores(spark, sf_dir):
    limits = EN.join_limits(ev_daily(spark, sf_dir), ev_registry(spark, sf_dir))
    s = HE.component_scores(limits)
    return s.select("equipment_id", "kpi_date", "site_location", "temperature_score", "pressure_score",
                    "vibration_score", "performance_score", "health_score", "health_status")


def q_health_scores(spark, sf_dir):
    return ev_health(spark, sf_dir).drop("calculated_at")


def q_health_trend(spark, sf_dir):
    return ev_health(spark, sf_dir).select("equipment_id", "score_date", "site_location", "health_score",
                                           "health_score_prev_day", "health_trend")


def q_days_to_maintenance(spark, sf_dir):
    h = ev_health(spark, sf_dir)
    return h.filter(F.col("days_to_maintenance_estimate").isNotNull()).select(
        "equipment_id", "score_date", "health_score", "health_score_prev_day", "days_to_maintenance_estimate")


def _alert_view(a: DataFrame) -> DataFrame:
    return a.select("alert_id", "equipment_id", "equipment_type", "alert_date", "severity", "alert_type", "title",
                    "description", "recommended_action", "health_score", "acknowledged")


def q_health_alerts(spark, sf_dir):
    return _alert_view(AL.health_alerts(ev_health(spark, sf_dir), as_of()))


def q_trend_alerts(spark, sf_dir):
    return _alert_view(AL.trend_alerts(ev_health(spark, sf_dir), as_of()))


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    return SC.materialize(df)


def _fleet(spark, sf_dir, per_site):
    kpis = materialize(spark, ev_kpis(spark, sf_dir))
    h = materialize(spark, ev_health(spark, sf_dir, kpis))
    return FL.fleet_summary(h, AL.all_alerts(h, as_of()), kpis, as_of(), per_site=per_site) \
        .drop("calculated_at")


def q_fleet_summary(spark, sf_dir):
    return _fleet(spark, sf_dir, False)


def q_fleet_summary_per_site(spark, sf_dir):
    return _fleet(spark, sf_dir, True)


def q_latest_scorecard(spark, sf_dir):
    return DB.latest_scorecard(ev_health_shared(spark, sf_dir))


def q_component_breakdown(spark, sf_dir):
    return DB.component_breakdown(ev_health_shared(spark, sf_dir))


def q_degrading_history(spark, sf_dir):
    return QU.degrading_history(ev_health_shared(spark, sf_dir))


def q_topn_anomalies(spark, sf_dir):
    return QU.anomalies_by_equipment_topn(li_events(spark, sf_dir), 10)


def q_funnel_counts(spark, sf_dir):
    raw = li_raw(spark, sf_dir)
    return DB.funnel_of(CL.stage_counts(raw, LI_SPEC))


def q_conversion_metrics(spark, sf_dir):
    raw = li_raw(spark, sf_dir)
    return QU.with_rates(CL.stage_counts(raw, LI_SPEC))


def q_latency_stats(spark, sf_dir):
    s = ev_silver(spark, sf_dir)
    return QU.latency_stats(s, accuracy=C.PERCENTILE_ACCURACY)


def orders_flotation(spark, sf_dir) -> DataFrame:
    """Orders as plant readings; the date text comes in three layouts (by
    order status), like a CSV assembled from several exports."""
    o = table(spark, sf_dir, "orders")
    date = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
            .when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MM/dd/yyyy HH:mm"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    cols = {
        "date": date,
        "iron_feed_pct": F.col("o_custkey") / 10.0,
        "silica_feed_pct": F.col("o_totalprice") / 200000.0,
        "ore_pulp_ph": F.col("o_totalprice") / 50000.0,
        "flotation_col_01_air_flow": F.col("o_totalprice") / 1000.0,
        "flotation_col_02_air_flow": F.col("o_custkey").cast("double"),
        "flotation_col_01_level": F.col("o_totalprice") / 2000.0,
        "iron_concentrate_pct": F.lit(70.0) - F.col("o_totalprice") / 100000.0,
        "silica_concentrate_pct": F.col("o_totalprice") / 100000.0,
    }
    base = o.select("o_orderkey", *[v.alias(k) for k, v in cols.items()])
    missing = [c for c in (*PR.AIR_FLOW_COLS, *PR.LEVEL_COLS) if c not in cols]
    return base.withColumns({c: F.lit(None).cast("double") for c in missing})


def q_clean_flotation(spark, sf_dir):
    s = PR.clean_flotation(orders_flotation(spark, sf_dir), as_of(), ts_type="timestamp_ntz")
    return s.select("o_orderkey", "date", "reading_timestamp", "reading_date", "avg_air_flow", "avg_column_level",
                    "silica_above_threshold", "quality_score")


def flotation_quality(spark, sf_dir) -> DataFrame:
    cleaned = PR.clean_flotation(orders_flotation(spark, sf_dir), as_of(), ts_type="timestamp_ntz")
    return PR.flotation_hourly_quality(cleaned, as_of())


def q_process_quality(spark, sf_dir):
    return flotation_quality(spark, sf_dir).drop("calculated_at")


def q_process_bands(spark, sf_dir):
    return PR.process_quality_bands(flotation_quality(spark, sf_dir))


# --- fixed values: label flags bound as failure types ---
LABEL_FLAGS = {"quality": "Quality Flag", "toxic": "Toxic Flag"}


def labelled_records(spark, sf_dir) -> DataFrame:
    lab, doc = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    d = doc.select("doc_id", "n_chars")
    return lab.join(d, "doc_id", "left").select(
        "doc_id", "quality", "toxic",
        F.col("n_chars").cast("double").alias("air_temperature_k"),
        F.col("n_chars").cast("double").alias("process_temperature_k"),
        F.col("doc_id").cast("double").alias("rotational_speed_rpm"),
        (F.col("n_chars") / 100.0).alias("torque_nm"),
        (F.col("doc_id") / 10.0).alias("tool_wear_min"),
    )


def q_failure_calibration(spark, sf_dir):
    return FA.failure_calibration(labelled_records(spark, sf_dir), as_of(), flags=LABEL_FLAGS).drop("calculated_at")


def embedding_signals(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("label").alias("experiment_id"),
        F.lit(1).alias("bearing_id"),
        F.col("vec_id").alias("measurement_index"),
        F.col("vec_id").cast("string").alias("timestamp"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vibration_signal"),
        F.lit(C.SAMPLE_RATE_HZ).alias("sample_rate_hz"),
    )


def q_signal_features(spark, sf_dir):
    f = SG.bearing_features(embedding_signals(spark, sf_dir), as_of(), with_moments=False)
    return f.select("experiment_id", "measurement_index", "sample_count", "rms_amplitude", "peak_amplitude",
                    "crest_factor", "std_deviation", "bearing_health_index")


def q_signal_moments(spark, sf_dir):
    f = SG.bearing_features(embedding_signals(spark, sf_dir), as_of(), with_moments=True)
    return f.select("measurement_index", "kurtosis", "skewness")


def q_bearing_health(spark, sf_dir):
    f = SG.bearing_features(embedding_signals(spark, sf_dir), as_of(), with_moments=False)
    return SG.bearing_health_by_unit(f, ("experiment_id",))


def q_spectral_features(spark, sf_dir):
    f = SG.bearing_features(embedding_signals(spark, sf_dir), as_of(), with_moments=False, with_spectrum=True)
    return f.select("measurement_index", "sample_count", "dominant_frequency_hz", "spectral_energy")


def q_decimal_comma(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    plain = F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    grouped = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    df = o.select("o_orderkey", plain.alias("price_text"), grouped.alias("price_grouped_text"))
    df = df.withColumns({"price": F.col("price_text"), "price_grouped": F.col("price_grouped_text")})
    out = SF.decimal_comma_to_double(df, skip=("o_orderkey", "price_text", "price_grouped_text"))
    return out.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def q_freshness(spark, sf_dir):
    return DB.freshness({
        "events": (table(spark, sf_dir, "events"), "ts"),
        "orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
    }, as_of())


def q_recommendations(spark, sf_dir):
    metrics = QU.with_rates(CL.stage_counts(li_raw(spark, sf_dir), LI_SPEC))
    h = ev_health_shared(spark, sf_dir)
    return QU.recommendations(metrics, h, AL.all_alerts(h, as_of()))


def q_zscore_anomalies(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("equipment_id"), F.lit("user").alias("equipment_type"),
        F.col("ts").alias("reading_timestamp"), "value")
    z = AN.zscore_anomalies(ev, "value", as_of(), baseline_hours=168, z_threshold=2.5)
    return z.select("equipment_id", "event_timestamp", "severity", "sensor_value",
                    F.round("threshold_value", 6).alias("baseline_mean"), F.round("z_score", 6).alias("z_score"))


def q_rate_of_change(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("equipment_id"), F.lit("user").alias("equipment_type"),
        F.col("ts").alias("reading_timestamp"), "value")
    r = AN.rate_of_change_anomalies(ev, "value", 300.0, as_of())
    return r.select("equipment_id", "event_timestamp", "severity", "sensor_value", "description")


def q_threshold_alerts(spark, sf_dir):
    silver = li_silver(spark, sf_dir)
    events = AN.threshold_events(silver, LI_THRESHOLDS, as_of()).withColumn("event_date", F.to_date("event_timestamp"))
    sites = li_registry(spark, sf_dir).select("equipment_id", "site_location")
    a = AL.threshold_alerts(events.join(sites, "equipment_id", "left"), as_of())
    return a.select("equipment_id", "equipment_type", "site_location", "alert_date", "severity", "alert_type", "title",
                    "description", "recommended_action")


def q_anomaly_frequency_alerts(spark, sf_dir):
    a = AL.anomaly_frequency_alerts(ev_daily(spark, sf_dir), as_of(), max_flags=1)
    return a.select("alert_id", "equipment_id", "alert_date", "severity", "alert_type", "title", "description")


def q_rescue_json(spark, sf_dir):
    """Event props against a declared ``{k: int}`` schema plus document texts
    (which are not JSON) through the same rescued-data parser."""
    from pyspark.sql.types import IntegerType, StructField, StructType
    schema = StructType([StructField("k", IntegerType())])
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("events").alias("src"),
                                                F.col("props").alias("value"))
    doc = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("src"),
                                                    F.col("text").alias("value"))
    return rescue_json(ev.unionByName(doc), schema)


def q_table_stats(spark, sf_dir):
    names = ("lineitem", "orders", "events", "supplier", "customer")
    return QU.table_stats(spark, {n: os.path.join(sf_dir, f"{n}.parquet") for n in names}).select(
        "table_name", "size_mb", "num_files", F.unix_seconds("last_modified").alias("last_modified_s"))


# ------------------------------------------------------------- streaming

def q_stream_ingest(spark, sf_dir):
    """Incremental ingest of the events file with ``availableNow`` into a
    parquet table under the shared folder; returns the ingested table."""
    from ..streaming.ingest import stream_parquet_once
    run = os.path.join(shared_dir(spark), f"stream-ingest-{uuid.uuid4().hex}")
    schema = table(spark, sf_dir, "events").schema
    stream_parquet_once(spark, sf_dir, schema, os.path.join(run, "table"), os.path.join(run, "checkpoint"),
                        transform=lambda df: df.withColumn("source_file", F.col("_metadata.file_name")),
                        glob="events.parquet")
    return spark.read.parquet(os.path.join(run, "table"))


def q_stream_hourly_window(spark, sf_dir, files_per_trigger=None, glob="events.parquet"):
    """Hourly KPIs of the events stream: every micro-batch adds its partial
    aggregates, the totals cover all windows."""
    from ..streaming import tables as ST
    run = os.path.join(shared_dir(spark), f"stream-window-{uuid.uuid4().hex}")
    stream = ST.read_files(spark, sf_dir, table(spark, sf_dir, glob.split(".")[0]).schema, glob, files_per_trigger)
    ST.drain(stream, ST.add_partials(os.path.join(run, "table"), lambda b: ST.window_partials(
        b, "ts", "user_id", "value", "event_type", EV_STATUS.operating)), os.path.join(run, "checkpoint"))
    k = ST.window_totals(spark.read.parquet(os.path.join(run, "table")), "user_id")
    return k.withColumn("avg_value", F.round("avg_value", 6))


def q_stream_silver(spark, sf_dir, files_per_trigger=None, glob="lineitem.parquet"):
    """The lineitem file as a reading stream through the silver stage (parse,
    hard rules, flags) into a table of the best row per key."""
    from ..streaming import tables as ST
    run = os.path.join(shared_dir(spark), f"stream-silver-{uuid.uuid4().hex}")
    stream = ST.read_files(spark, sf_dir, table(spark, sf_dir, glob.split(".")[0]).schema, glob, files_per_trigger)

    def prepare(batch):
        flagged = CL.flag_quality(CL.passing_records(li_readings(batch), LI_SPEC), LI_RULES)
        return flagged.withColumn("reading_year", F.date_format(CL.PARSED, "yyyy"))

    ST.drain(stream, ST.keep_best(os.path.join(run, "table"), prepare, _li_dedup, "reading_year"),
             os.path.join(run, "checkpoint"))
    return spark.read.parquet(os.path.join(run, "table")).select(
        "equipment_id", F.col(CL.PARSED).alias("reading_timestamp"), "l_orderkey", "l_linenumber", "l_partkey",
        "quality_score", F.array_join("anomaly_reasons", "|").alias("reasons"))


def q_stream_keyed_state(spark, sf_dir, files_per_trigger=None, glob="lineitem.parquet"):
    """The same stream into a log of best copies, with keyed state instead of
    a merge of the touched years; the log is read as the table it stands for."""
    from ..streaming import state as SS
    from ..streaming import tables as ST
    run = os.path.join(shared_dir(spark), f"stream-state-{uuid.uuid4().hex}")
    stream = ST.read_files(spark, sf_dir, table(spark, sf_dir, glob.split(".")[0]).schema, glob, files_per_trigger)
    flagged = CL.flag_quality(CL.passing_records(li_readings(stream), LI_SPEC), LI_RULES)
    order = [-F.col("quality_score"), -CL.completeness(list(LI_SENSORS)), *[F.col(c) for c in LI_TIES]]
    SS.write_best_copies(spark, flagged, os.path.join(run, "log"), ["equipment_id", CL.PARSED], order,
                         os.path.join(run, "checkpoint"))
    return SS.best_rows(spark.read.parquet(os.path.join(run, "log")), _li_dedup).select(
        "equipment_id", F.col(CL.PARSED).alias("reading_timestamp"), "l_orderkey", "l_linenumber", "l_partkey",
        "quality_score", F.array_join("anomaly_reasons", "|").alias("reasons"))


# ================================================================ registry
QUERIES = {
    # silver
    "range_flags": q_range_flags,
    "quality_distribution": q_quality_distribution,
    "quarantine_split": q_quarantine_split,
    "dedup_keep_best": q_dedup_keep_best,
    "enrich_registry": q_enrich_registry,
    "merge_upsert": q_merge_upsert,
    "parse_timestamps": q_parse_timestamps,
    "threshold_events": q_threshold_events,
    "anomalies_by_severity": q_anomalies_by_severity,
    # gold
    "hourly_kpis": q_hourly_kpis,
    "daily_rollup": q_daily_rollup,
    "component_scores": q_component_scores,
    "health_scores": q_health_scores,
    "health_trend": q_health_trend,
    "days_to_maintenance": q_days_to_maintenance,
    "health_alerts": q_health_alerts,
    "trend_alerts": q_trend_alerts,
    "fleet_summary": q_fleet_summary,
    "fleet_summary_per_site": q_fleet_summary_per_site,
    # monitoring / reports
    "latest_scorecard": q_latest_scorecard,
    "component_breakdown": q_component_breakdown,
    "degrading_history": q_degrading_history,
    "topn_anomalies": q_topn_anomalies,
    "funnel_counts": q_funnel_counts,
    "conversion_metrics": q_conversion_metrics,
    "latency_stats": q_latency_stats,
    "freshness": q_freshness,
    "recommendations": q_recommendations,
    # plant, failures, signals
    "clean_flotation": q_clean_flotation,
    "process_quality": q_process_quality,
    "process_bands": q_process_bands,
    "failure_calibration": q_failure_calibration,
    "signal_features": q_signal_features,
    "signal_moments": q_signal_moments,
    "bearing_health": q_bearing_health,
    "decimal_comma": q_decimal_comma,
    "rescue_json": q_rescue_json,
    # streaming
    "stream_ingest": q_stream_ingest,
    "stream_hourly_window": q_stream_hourly_window,
    "stream_silver": q_stream_silver,
    "stream_keyed_state": q_stream_keyed_state,
    # extensions (ours)
    "zscore_anomalies": q_zscore_anomalies,
    "rate_of_change": q_rate_of_change,
    "anomaly_frequency_alerts": q_anomaly_frequency_alerts,
    "threshold_alerts": q_threshold_alerts,
    # rows-only
    "spectral_features": q_spectral_features,
    "table_stats": q_table_stats,
}


# ======================================================== report queries
def _li_quar(spark, sf_dir):
    return CL.quarantine_records(li_raw(spark, sf_dir), as_of(), LI_SPEC)


def q_total_units_latest(spark, sf_dir):                      # B1.1 / A12
    return DB.total_units_latest(ev_health_shared(spark, sf_dir))


def q_availability_latest(spark, sf_dir):                     # B1.2
    return DB.availability_latest(ev_health_shared(spark, sf_dir))


def q_avg_health_latest(spark, sf_dir):                       # B1.3
    return DB.avg_health_latest(ev_health_shared(spark, sf_dir))


def q_open_critical_alerts(spark, sf_dir):                    # B1.4
    return DB.open_critical_alerts(ev_alerts(spark, sf_dir))


def q_status_distribution(spark, sf_dir):                     # B1.5
    return DB.status_distribution_latest(ev_health_shared(spark, sf_dir))


def q_daily_health_trend(spark, sf_dir):                      # B1.6
    return DB.daily_health_trend(ev_health(spark, sf_dir))


def q_utilization_by_type(spark, sf_dir):                     # B1.7
    return DB.utilization_by_type(li_kpis(spark, sf_dir))


def q_daily_payload(spark, sf_dir):                           # B1.9
    return DB.daily_payload(li_kpis(spark, sf_dir), "F")


def q_score_history(spark, sf_dir):                           # B2.2
    return DB.score_history(ev_health(spark, sf_dir))


def q_kpi_trend_quantity(spark, sf_dir):                      # B2.4 form
    return DB.hourly_trend(li_kpis(spark, sf_dir), "F", {"avg_quantity": ("avg_quantity", 2),
                                                         "max_quantity": ("max_quantity", 2)}, "avg_quantity")


def q_kpi_trend_rates(spark, sf_dir):                         # B2.5 form
    return DB.hourly_trend(li_kpis(spark, sf_dir), "O", {"avg_discount_pct": ("avg_discount_pct", 3),
                                                         "max_tax_pct": ("max_tax_pct", 3)}, "avg_discount_pct")


def q_kpi_price_vs_quantity(spark, sf_dir):                   # B2.6 form
    return DB.hourly_trend(li_kpis(spark, sf_dir), "O",
                           {"avg_price_k": ("avg_price_k", 2), "avg_discount_pct": ("avg_discount_pct", 2),
                            "avg_quantity": ("avg_quantity", 1)}, "avg_price_k",
                           keys=("equipment_id", "kpi_hour"), order=("kpi_hour",))


def q_kpi_trend_events(spark, sf_dir):                        # B2.7 form
    return DB.hourly_trend(ev_kpis(spark, sf_dir), "user", {"avg_value": ("avg_value", 1),
                                                            "avg_k_tenths": ("avg_k_tenths", 1)}, "avg_value")


def q_open_alerts(spark, sf_dir):                             # B3.1
    return DB.open_alerts(ev_alerts(spark, sf_dir))


def q_anomalies_by_unit_severity(spark, sf_dir):              # B3.2
    return DB.anomalies_by_unit_severity(li_events(spark, sf_dir))


def q_anomalies_by_sensor(spark, sf_dir):                     # B3.3
    return DB.anomalies_by_sensor(li_events(spark, sf_dir))


def q_anomaly_timeline(spark, sf_dir):                        # B3.4
    return DB.anomaly_timeline(li_events(spark, sf_dir))


def q_alerts_by_unit_type(spark, sf_dir):                     # B3.5
    return DB.alerts_by_unit_type(ev_alerts(spark, sf_dir))


def q_row_counts(spark, sf_dir):                              # B4.1
    raw = li_raw(spark, sf_dir)
    silver = materialize(spark, li_silver(spark, sf_dir))
    kpis = materialize(spark, ev_kpis(spark, sf_dir))
    h = materialize(spark, ev_health(spark, sf_dir, kpis))
    return DB.row_counts({
        "Bronze - Sensor Readings": raw,
        "Silver - Cleaned Readings": silver,
        "Silver - Quarantine": CL.quarantine_records(raw, as_of(), LI_SPEC),
        "Silver - Anomaly Events": AN.threshold_events(silver, LI_THRESHOLDS, as_of()),
        "Gold - Hourly KPIs": kpis,
        "Gold - Health Scores": h,
        "Gold - Alerts": AL.all_alerts(h, as_of()),
    })


def q_layer_counts(spark, sf_dir):                            # M1
    return QU.layer_counts(spark, {
        "raw_sensor_readings": li_raw(spark, sf_dir),
        "raw_flotation_readings": orders_flotation(spark, sf_dir),
        "raw_maintenance_labels": labelled_records(spark, sf_dir),
        "raw_bearing_vibration": None,       # not landed: reported as NULL
    })


def q_quarantine_reasons(spark, sf_dir):                      # B4.4
    ev_q = CL.quarantine_records(ev_raw(spark, sf_dir), as_of(), EV_SPEC)
    return DB.quarantine_reasons(_li_quar(spark, sf_dir).unionByName(ev_q))


def q_rows_per_type(spark, sf_dir):                           # B4.6
    return DB.rows_per_type(_li_dedup(li_flagged(spark, sf_dir)))


def q_rows_per_ingestion_day(spark, sf_dir):                  # B4.7
    raw = ev_raw(spark, sf_dir).withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    return DB.rows_per_ingestion_day(raw)


def q_silica_trend(spark, sf_dir):                            # B5.1
    return DB.silica_trend(flotation_quality(spark, sf_dir), 500)


def q_iron_vs_silica(spark, sf_dir):                          # B5.3
    return DB.iron_vs_silica(flotation_quality(spark, sf_dir), 1000)


def q_failure_types(spark, sf_dir):                           # B5.4
    preds = FA.failure_calibration(labelled_records(spark, sf_dir), as_of(), flags=LABEL_FLAGS)
    return DB.failure_types(preds)


def q_active_alerts(spark, sf_dir):                           # M7
    return QU.active_alerts(ev_alerts(spark, sf_dir))


def q_latest_health(spark, sf_dir):                           # M3
    return QU.latest_health(ev_health_shared(spark, sf_dir))


def q_critical_equipment(spark, sf_dir):                      # M9
    return QU.critical_equipment(ev_health(spark, sf_dir))


def q_status_counts(spark, sf_dir):                           # A10
    return QU.count_by(li_silver(spark, sf_dir), "equipment_type", "operating_status", name="records")


def q_monthly_health(spark, sf_dir):
    """Health per supplier and month: day KPIs rolled up to months."""
    monthly = KP.daily_rollup(li_kpis(spark, sf_dir), LI_ROLLUP, grain="month")
    return HE.health_scores(EN.join_limits(monthly, li_registry(spark, sf_dir)), as_of()).drop("calculated_at")


QUERIES.update({
    "monthly_health": q_monthly_health,
    "total_units_latest": q_total_units_latest,
    "availability_latest": q_availability_latest,
    "avg_health_latest": q_avg_health_latest,
    "open_critical_alerts": q_open_critical_alerts,
    "status_distribution": q_status_distribution,
    "daily_health_trend": q_daily_health_trend,
    "utilization_by_type": q_utilization_by_type,
    "daily_payload": q_daily_payload,
    "score_history": q_score_history,
    "kpi_trend_quantity": q_kpi_trend_quantity,
    "kpi_trend_rates": q_kpi_trend_rates,
    "kpi_price_vs_quantity": q_kpi_price_vs_quantity,
    "kpi_trend_events": q_kpi_trend_events,
    "open_alerts": q_open_alerts,
    "anomalies_by_unit_severity": q_anomalies_by_unit_severity,
    "anomalies_by_sensor": q_anomalies_by_sensor,
    "anomaly_timeline": q_anomaly_timeline,
    "alerts_by_unit_type": q_alerts_by_unit_type,
    "row_counts": q_row_counts,
    "layer_counts": q_layer_counts,
    "quarantine_reasons": q_quarantine_reasons,
    "rows_per_type": q_rows_per_type,
    "rows_per_ingestion_day": q_rows_per_ingestion_day,
    "silica_trend": q_silica_trend,
    "iron_vs_silica": q_iron_vs_silica,
    "failure_types": q_failure_types,
    "active_alerts": q_active_alerts,
    "latest_health": q_latest_health,
    "critical_equipment": q_critical_equipment,
    "status_counts": q_status_counts,
})
