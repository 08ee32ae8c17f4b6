"""The fleet's own rules under their own names: lineitem columns stand in for
the sensors, scaled so that values fall on either side of every bound. The SQL
states every constant itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import anomalies as AN
from ..operators import clean as CL
from ..operators import kpis as KP
from ..operators import quality as QU
from ..sources import files as SF
from ..sources import scratch as SC
from ..sources import tables as T
from . import bindings as B
from . import dashboard as DB

# --- fixed values: what stands in for each sensor ---
SENSORS = {
    "engine_temp_c": "l_quantity * 4 - 45",
    "oil_pressure_bar": "l_discount * 110",
    "tire_pressure_psi": "if(l_linenumber = 7, null, l_quantity * 3)",
    "fuel_rate_lph": "l_extendedprice / 140",
    "payload_tonnes": "l_quantity * 10 - 20",
    "speed_kmh": "l_tax * 1100",
    "hydraulic_pressure_bar": "l_quantity * 9 - 10",
    "hydraulic_oil_temp_c": "l_quantity * 3 - 25",
    "belt_speed_mps": "l_discount * 90",
    "motor_current_amps": "l_extendedprice / 240",
    "vibration_x_mms": "l_quantity / 4",
    "vibration_y_mms": "if(l_linenumber = 5, null, l_discount * 100)",
    "vibration_z_mms": "l_tax * 700",
    "motor_temp_c": "l_quantity * 3 - 25",
    "feed_rate_tph": "l_extendedprice / 12",
    "power_draw_kw": "l_extendedprice / 65",
    "css_mm": "l_quantity * 5 + 10",
    "crusher_vibration_mms": "l_quantity / 2",
    "crusher_oil_temp_c": "l_quantity * 3 - 25",
    "cycle_time_sec": "l_extendedprice / 1000",
}


def fleet_raw(spark, sf_dir) -> DataFrame:
    """lineitem rows as landed fleet messages; every line 6 has a bad time, every line 4
    of a part divisible by 9 no type."""
    li = B.table(spark, sf_dir, "lineitem")
    kind = F.expr("element_at(array('haul_truck', 'conveyor', 'crusher', 'excavator'), cast(l_partkey % 4 + 1 as int))")
    status = F.expr("""case when l_returnflag = 'A' then 'idle'
                            else element_at(array('loaded', 'running', 'crushing', 'digging'), cast(l_partkey % 4 + 1 as int)) end""")
    return li.select(
        F.concat(F.lit("U-"), F.col("l_suppkey").cast("string")).alias("equipment_id"),
        F.when((F.col("l_linenumber") == 4) & (F.col("l_partkey") % 9 == 0), None).otherwise(kind).alias("equipment_type"),
        F.when(F.col("l_linenumber") == 6, "no time").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("timestamp"),
        status.alias("operating_status"), "l_orderkey", "l_linenumber",
        (F.col("l_suppkey") % 40 + 100).cast("double").alias("max_engine_temp_c"),
        *[F.expr(e).cast("double").alias(name) for name, e in SENSORS.items()])


SPEC = C.SilverSpec(ingest_ts_col=None, source_col=None, ts_type="timestamp_ntz")


def fleet_readings(spark, sf_dir) -> DataFrame:
    """All readings with a time and their flags, hard breaches too, so that every rule shows."""
    parsed = CL.with_parsed_timestamp(fleet_raw(spark, sf_dir), SPEC)
    flagged = CL.flag_quality(parsed.where(F.col(CL.PARSED).isNotNull()), C.SENSOR_RULES)
    return flagged.withColumnRenamed(CL.PARSED, "reading_timestamp")


def q_fleet_sensor_rules(spark, sf_dir):
    """All 19 range rules."""
    return fleet_readings(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.array_join("anomaly_reasons", "|").alias("reasons"), "is_anomaly", "quality_score")


def q_fleet_threshold_rules(spark, sf_dir):
    """D2-D5, each by its own name."""
    r = fleet_readings(spark, sf_dir)
    out = None
    for rule in (AN.engine_temp_anomalies, AN.vibration_anomalies, AN.crusher_vibration_anomalies, AN.oil_temp_anomalies):
        e = rule(r, B.as_of())
        out = e if out is None else out.unionByName(e)
    return out.select("event_id", "equipment_id", "equipment_type", "event_timestamp", "anomaly_type", "severity", "sensor_name",
                      F.round("sensor_value", 6).alias("sensor_value"), "threshold_value", "description")


def q_fleet_vibration(spark, sf_dir):
    """Gold vibration: the conveyors' magnitude with a missing axis as 0."""
    return fleet_readings(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "equipment_type", F.round(KP.fleet_vibration_rms(), 6).alias("vibration_rms"))


CONTRACT = T.Contract(not_null=("equipment_id", "equipment_type"), ranges={"quality_score": (0.0, 1.0)})


def q_fleet_quarantine(spark, sf_dir):
    """The rows of each quarantine reason, and those that stay."""
    raw = fleet_raw(spark, sf_dir)
    _, bad_times = CL.split_bad_timestamps(raw, B.as_of(), SPEC)
    hard = CL.quarantine_hard_limits(raw, B.as_of(), SPEC)
    good, broken = T.enforce_contract(CL.flag_quality(CL.drop_quarantined(raw, SPEC), C.SENSOR_RULES), CONTRACT)
    key = F.get_json_object("raw_record", "$.l_orderkey").cast("bigint"), F.get_json_object("raw_record", "$.l_linenumber").cast("int")
    out = good.select("equipment_id", "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.lit("stays").alias("verdict"))
    for df in (bad_times, hard):
        out = out.unionByName(df.select("equipment_id", key[0].alias("l_orderkey"), key[1].alias("l_linenumber"),
                                        F.col("quarantine_reason").alias("verdict")))
    return out.unionByName(broken.select("equipment_id", "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
                                         F.lit(C.REASON_CONTRACT).alias("verdict")))


def q_quality_labels(spark, sf_dir):
    """silver's and the report's label sets."""
    r = fleet_readings(spark, sf_dir)
    out = None
    for name, bands in (("silver", C.QUALITY_BANDS_SILVER), ("report", C.QUALITY_BANDS_REPORT)):
        d = QU.quality_distribution(r, bands).withColumn("label_set", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def fleet_kpis(spark, sf_dir) -> DataFrame:
    return KP.hourly_kpis(fleet_readings(spark, sf_dir).where(F.col("equipment_type").isNotNull())
                          .withColumn("site_location", F.lit("pit")))


def q_fleet_engine_trend(spark, sf_dir):                      # B2.4
    return DB.engine_temp_trend(fleet_kpis(spark, sf_dir))


def q_fleet_conveyor_trend(spark, sf_dir):                    # B2.5
    return DB.conveyor_vibration_trend(fleet_kpis(spark, sf_dir))


def q_fleet_crusher_gap(spark, sf_dir):                       # B2.6
    return DB.crusher_gap_power(fleet_kpis(spark, sf_dir))


def q_fleet_excavator_cycle(spark, sf_dir):                   # B2.7
    return DB.excavator_cycle_trend(fleet_kpis(spark, sf_dir))


def q_vibration_files(spark, sf_dir):
    """Every embedding as a file of 4 bearings' samples in one of four folders, of which
    three are experiments; every fifth file has a sample that is no number."""
    root = SC.run_folder(spark, "vibration")
    e = B.table(spark, sf_dir, "embeddings").where("embedding is not null and size(embedding) > 0")
    folder = F.expr("element_at(array('1st_test', '2nd_test', '3rd_test', 'notes'), cast(vec_id % 4 + 1 as int))")
    name = F.concat(F.lit("2004."), F.lpad((F.col("vec_id") * 7919 % 1000003).cast("string"), 7, "0"), F.lit("."), F.col("vec_id").cast("string"))
    value = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 5 == 0) & (i == 6), F.lit("bad"))
                        .otherwise(x.cast("double").cast("string")))
    lines = F.transform(F.sequence(F.lit(0), F.ceil(F.size("embedding") / 4).cast("int") - 1),
                        lambda i: F.array_join(F.slice(value, i * 4 + 1, 4), "\t"))
    SF.write_text_files(e.select(F.concat(folder, F.lit("/"), name).alias("path"), F.array_join(lines, "\n").alias("text")), root)
    out = SF.read_vibration_files(spark, root, B.as_of())
    return out.select("experiment_id", "bearing_id", "measurement_index", "timestamp", F.size("vibration_signal").alias("samples"),
                      F.round(F.aggregate("vibration_signal", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
                      F.element_at("vibration_signal", 1).alias("first_sample"))


QUERIES = {
    "fleet_sensor_rules": q_fleet_sensor_rules,
    "fleet_threshold_rules": q_fleet_threshold_rules,
    "fleet_vibration": q_fleet_vibration,
    "fleet_quarantine": q_fleet_quarantine,
    "quality_labels": q_quality_labels,
    "fleet_engine_trend": q_fleet_engine_trend,
    "fleet_conveyor_trend": q_fleet_conveyor_trend,
    "fleet_crusher_gap": q_fleet_crusher_gap,
    "fleet_excavator_cycle": q_fleet_excavator_cycle,
    "vibration_files": q_vibration_files,
}


def _sr(x: str, d: int) -> str:
    """HALF_UP on the decimal text of a double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def _id(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST(({p}) AS VARCHAR), '\\N')" for p in parts)
    return f"sha256(concat_ws('|', {inner}))"


def _mean(x: str) -> str:
    """The mean of values in whole millionths, rounded HALF_UP to 10 decimals."""
    u = f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 6) * 1000000 AS HUGEINT)"
    s, n = f"sum({u})", f"CAST(count({x}) AS HUGEINT)"
    return (f"(CASE WHEN count({x}) > 0 THEN CAST(CASE WHEN {s} >= 0 THEN (2 * {s} * 10000 + {n}) // (2 * {n}) "
            f"ELSE -((2 * (-{s}) * 10000 + {n}) // (2 * {n})) END AS DOUBLE) / 10000000000.0 END)")


FLEET = """WITH raw AS (
  SELECT 'U-' || l_suppkey AS equipment_id,
         CASE WHEN l_linenumber = 4 AND l_partkey % 9 = 0 THEN NULL
              ELSE ['haul_truck', 'conveyor', 'crusher', 'excavator'][l_partkey % 4 + 1] END AS equipment_type,
         CASE WHEN l_linenumber <> 6 THEN l_shipdate END AS ts,
         CASE WHEN l_returnflag = 'A' THEN 'idle' ELSE ['loaded', 'running', 'crushing', 'digging'][l_partkey % 4 + 1] END AS status,
         l_orderkey, l_linenumber, CAST(l_suppkey % 40 + 100 AS DOUBLE) AS max_engine_temp_c,
         l_quantity * 4 - 45 AS engine_temp_c, l_discount * 110 AS oil_pressure_bar,
         CASE WHEN l_linenumber <> 7 THEN l_quantity * 3 END AS tire_pressure_psi, l_extendedprice / 140 AS fuel_rate_lph,
         l_quantity * 10 - 20 AS payload_tonnes, l_tax * 1100 AS speed_kmh, l_quantity * 9 - 10 AS hydraulic_pressure_bar,
         l_quantity * 3 - 25 AS hydraulic_oil_temp_c, l_discount * 90 AS belt_speed_mps, l_extendedprice / 240 AS motor_current_amps,
         l_quantity / 4 AS vibration_x_mms, CASE WHEN l_linenumber <> 5 THEN l_discount * 100 END AS vibration_y_mms,
         l_tax * 700 AS vibration_z_mms, l_quantity * 3 - 25 AS motor_temp_c, l_extendedprice / 12 AS feed_rate_tph,
         l_extendedprice / 65 AS power_draw_kw, l_quantity * 5 + 10 AS css_mm, l_quantity / 2 AS crusher_vibration_mms,
         l_quantity * 3 - 25 AS crusher_oil_temp_c, l_extendedprice / 1000 AS cycle_time_sec
  FROM lineitem),
flags AS (
  SELECT *, list_filter([
      CASE WHEN engine_temp_c < -40 OR engine_temp_c > 150 THEN 'engine_temp_c' END,
      CASE WHEN oil_pressure_bar < 0 OR oil_pressure_bar > 10 THEN 'oil_pressure_bar' END,
      CASE WHEN tire_pressure_psi < 50 OR tire_pressure_psi > 140 THEN 'tire_pressure_psi' END,
      CASE WHEN fuel_rate_lph < 0 OR fuel_rate_lph > 700 THEN 'fuel_rate_lph' END,
      CASE WHEN payload_tonnes < 0 OR payload_tonnes > 450 THEN 'payload_tonnes' END,
      CASE WHEN speed_kmh < 0 OR speed_kmh > 80 THEN 'speed_kmh' END,
      CASE WHEN hydraulic_pressure_bar < 0 OR hydraulic_pressure_bar > 420 THEN 'hydraulic_pressure_bar' END,
      CASE WHEN hydraulic_oil_temp_c < -20 OR hydraulic_oil_temp_c > 120 THEN 'hydraulic_oil_temp_c' END,
      CASE WHEN belt_speed_mps < 0 OR belt_speed_mps > 8 THEN 'belt_speed_mps' END,
      CASE WHEN motor_current_amps < 0 OR motor_current_amps > 400 THEN 'motor_current_amps' END,
      CASE WHEN vibration_x_mms < 0 OR vibration_x_mms > 50 THEN 'vibration_x_mms' END,
      CASE WHEN vibration_y_mms < 0 OR vibration_y_mms > 50 THEN 'vibration_y_mms' END,
      CASE WHEN vibration_z_mms < 0 OR vibration_z_mms > 50 THEN 'vibration_z_mms' END,
      CASE WHEN motor_temp_c < -20 OR motor_temp_c > 120 THEN 'motor_temp_c' END,
      CASE WHEN feed_rate_tph < 0 OR feed_rate_tph > 8000 THEN 'feed_rate_tph' END,
      CASE WHEN power_draw_kw < 0 OR power_draw_kw > 1500 THEN 'power_draw_kw' END,
      CASE WHEN css_mm < 50 OR css_mm > 250 THEN 'css_mm' END,
      CASE WHEN crusher_vibration_mms < 0 OR crusher_vibration_mms > 50 THEN 'crusher_vibration_mms' END,
      CASE WHEN crusher_oil_temp_c < -20 OR crusher_oil_temp_c > 120 THEN 'crusher_oil_temp_c' END], lambda x: x IS NOT NULL) AS f
  FROM raw),
r AS (
  SELECT *, CASE len(f) WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.4 ELSE 0.1 END AS quality_score FROM flags WHERE ts IS NOT NULL)
"""

_EVENT = f"""SELECT {_id("equipment_id", "strftime(ts, '%Y-%m-%d %H:%M:%S')", "sensor_name")} AS event_id, equipment_id, equipment_type,
       ts AS event_timestamp, 'threshold_breach' AS anomaly_type, severity, sensor_name, {_sr("v", 6)} AS sensor_value,
       threshold_value, description"""

_KPI = """, k AS (
  SELECT *, date_trunc('hour', ts) AS kpi_hour,
         CASE equipment_type WHEN 'conveyor' THEN sqrt(coalesce(vibration_x_mms, 0) * coalesce(vibration_x_mms, 0)
                + coalesce(vibration_y_mms, 0) * coalesce(vibration_y_mms, 0) + coalesce(vibration_z_mms, 0) * coalesce(vibration_z_mms, 0))
              WHEN 'crusher' THEN crusher_vibration_mms END AS vibration_rms
  FROM r)
"""

ORACLE = {
    "fleet_sensor_rules": FLEET + """SELECT l_orderkey, l_linenumber,
       array_to_string(list_transform(f, lambda x: x || '_out_of_range'), '|') AS reasons, len(f) > 0 AS is_anomaly, quality_score FROM r""",
    "fleet_threshold_rules": FLEET + f""", e AS (
  SELECT *, 'engine_temp_c' AS sensor_name, engine_temp_c AS v, max_engine_temp_c AS threshold_value,
         CASE WHEN engine_temp_c > max_engine_temp_c THEN 'critical' ELSE 'warning' END AS severity,
         'Engine temp ' || {_sr("engine_temp_c", 1)} || 'C exceeds ' || {_sr("max_engine_temp_c * 0.9", 1)} || 'C threshold' AS description
  FROM r WHERE equipment_type = 'haul_truck' AND status <> 'idle' AND engine_temp_c > max_engine_temp_c * 0.9
  UNION ALL
  SELECT * EXCLUDE (m), 'vibration_rms', m, 7.0, CASE WHEN m > 15 THEN 'critical' WHEN m > 10 THEN 'warning' ELSE 'watch' END,
         'Conveyor vibration RMS ' || {_sr("m", 2)} || ' mm/s exceeds 7.0 mm/s'
  FROM (SELECT *, sqrt(pow(vibration_x_mms, 2) + pow(vibration_y_mms, 2) + pow(vibration_z_mms, 2)) AS m FROM r) z
  WHERE equipment_type = 'conveyor' AND status = 'running' AND m > 7.0
  UNION ALL
  SELECT *, 'crusher_vibration_mms', crusher_vibration_mms, 8.0,
         CASE WHEN crusher_vibration_mms > 15 THEN 'critical' WHEN crusher_vibration_mms > 10 THEN 'warning' ELSE 'watch' END,
         'Crusher vibration ' || {_sr("crusher_vibration_mms", 2)} || ' mm/s exceeds 8.0 mm/s'
  FROM r WHERE equipment_type = 'crusher' AND status = 'crushing' AND crusher_vibration_mms > 8.0
  UNION ALL
  SELECT *, 'hydraulic_oil_temp_c', hydraulic_oil_temp_c, 80.0,
         CASE WHEN hydraulic_oil_temp_c > 95 THEN 'critical' WHEN hydraulic_oil_temp_c > 85 THEN 'warning' ELSE 'watch' END,
         'Hydraulic oil temp ' || {_sr("hydraulic_oil_temp_c", 1)} || 'C exceeds 80C threshold'
  FROM r WHERE equipment_type = 'excavator' AND status = 'digging' AND hydraulic_oil_temp_c > 80)
{_EVENT} FROM e""",
    "fleet_vibration": FLEET + _KPI + f"SELECT l_orderkey, l_linenumber, equipment_type, {_sr('vibration_rms', 6)} AS vibration_rms FROM k",
    "fleet_quarantine": FLEET + """SELECT equipment_id, l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CASE WHEN ts IS NULL THEN 'invalid_timestamp'
            WHEN list_has_any(f, ['engine_temp_c', 'oil_pressure_bar', 'hydraulic_pressure_bar', 'hydraulic_oil_temp_c', 'vibration_x_mms',
                                  'vibration_y_mms', 'vibration_z_mms', 'motor_temp_c', 'crusher_vibration_mms', 'crusher_oil_temp_c'])
            THEN 'out_of_range_hard_limit'
            WHEN equipment_type IS NULL THEN 'contract_violation' ELSE 'stays' END AS verdict
FROM flags""",
    "quality_labels": FLEET + f""", b AS (
  SELECT 'silver' AS label_set, CASE WHEN quality_score = 1.0 THEN 'perfect' WHEN quality_score >= 0.7 THEN 'good'
                                     WHEN quality_score >= 0.4 THEN 'fair' ELSE 'poor' END AS quality_band FROM r
  UNION ALL
  SELECT 'report', CASE WHEN quality_score = 1.0 THEN '1.0 (perfect)' WHEN quality_score >= 0.7 THEN '0.7+ (good)'
                        WHEN quality_score >= 0.4 THEN '0.4+ (fair)' ELSE '< 0.4 (poor)' END FROM r)
SELECT label_set, quality_band, records, {_sr("records * 100.0 / total", 2)} AS pct
FROM (SELECT label_set, quality_band, count(*) AS records FROM b GROUP BY ALL)
JOIN (SELECT label_set, count(*) AS total FROM b GROUP BY ALL) USING (label_set)""",
    "fleet_engine_trend": FLEET + _KPI + f"""SELECT equipment_id, kpi_hour, {_sr(_mean("engine_temp_c"), 2)} AS avg_engine_temp,
       {_sr("max(engine_temp_c)", 2)} AS max_engine_temp
FROM k WHERE equipment_type = 'haul_truck' GROUP BY equipment_id, kpi_hour HAVING count(engine_temp_c) > 0""",
    "fleet_conveyor_trend": FLEET + _KPI + f"""SELECT equipment_id, kpi_hour, {_sr(_mean("vibration_rms"), 3)} AS avg_vibration_rms,
       {_sr("max(vibration_rms)", 3)} AS max_vibration_rms
FROM k WHERE equipment_type = 'conveyor' GROUP BY equipment_id, kpi_hour HAVING count(vibration_rms) > 0""",
    "fleet_crusher_gap": FLEET + _KPI + f"""SELECT equipment_id, kpi_hour, {_sr(_mean("css_mm"), 2)} AS avg_css_mm,
       {_sr(_mean("power_draw_kw"), 2)} AS avg_power_draw_kw, {_sr(_mean("feed_rate_tph"), 1)} AS avg_feed_rate_tph
FROM k WHERE equipment_type = 'crusher' GROUP BY equipment_id, kpi_hour HAVING count(css_mm) > 0""",
    "fleet_excavator_cycle": FLEET + _KPI + f"""SELECT equipment_id, kpi_hour, {_sr(_mean("cycle_time_sec"), 1)} AS avg_cycle_time_sec,
       {_sr(_mean("hydraulic_pressure_bar"), 1)} AS avg_hydraulic_pressure_bar
FROM k WHERE equipment_type = 'excavator' GROUP BY equipment_id, kpi_hour HAVING count(cycle_time_sec) > 0""",
    "vibration_files": f"""WITH e AS (
  SELECT vec_id, vec_id % 4 + 1 AS experiment_id, '2004.' || lpad(CAST(vec_id * 7919 % 1000003 AS VARCHAR), 7, '0') || '.' || vec_id AS "timestamp",
         embedding AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id % 4 < 3),
i AS (SELECT *, CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY "timestamp") - 1 AS INTEGER) AS measurement_index FROM e),
s AS (
  SELECT *, unnest([1, 2, 3, 4]) AS bearing_id FROM i),
x AS (
  SELECT *, list_transform(list_filter(range(len(v)), lambda j: j % 4 + 1 = bearing_id AND NOT (vec_id % 5 = 0 AND j = 6)),
                           lambda j: CAST(v[j + 1] AS DOUBLE)) AS y
  FROM s)
SELECT CAST(experiment_id AS INTEGER) AS experiment_id, CAST(bearing_id AS INTEGER) AS bearing_id, measurement_index, "timestamp",
       CAST(len(y) AS INTEGER) AS samples, {_sr("list_reduce(y, lambda a, b: a + b)", 6)} AS total, y[1] AS first_sample FROM x""",
}
