"""DuckDB SQL oracle: an independent SQL statement of every bound query.

Written against the raw benchmark views (``lineitem``, ``events``, ...).
Two engine differences are bridged explicitly:

* ``sr(x, d)`` reproduces Spark's ``round`` (HALF_UP on the decimal text of
  the double) - DuckDB rounds the binary value, so ``round(1.005, 2)`` differs.
* ``sid(...)`` reproduces ``functions.text.stable_id`` (sha-256 of the
  ``|``-joined key text, NULL written as ``\\N``).

Counts are cast to BIGINT (DuckDB sums are HUGEINT) and ``hour()`` to INT.
"""

from __future__ import annotations

from .. import config as C
from ..config import RangeRule
from . import bindings as B


def sr(x: str, d: int) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def sid(*parts: str) -> str:
    inner = ", ".join(f"coalesce(CAST(({p}) AS VARCHAR), '\\N')" for p in parts)
    return f"sha256(concat_ws('|', {inner}))"


def xdec(x: str) -> str:
    """Spark's ``CAST(double AS DECIMAL(38,6))``: HALF_UP on the decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 6) AS DECIMAL(38,6))"


def xsum(x: str) -> str:
    """``functions.checks.exact_sum``: fixed-point sum, as double."""
    return f"CAST(sum({xdec(x)}) AS DOUBLE)"


def xavg(x: str) -> str:
    """``functions.checks.exact_avg``: Spark's ``avg(DECIMAL(38,6))`` - the
    exact mean rounded HALF_UP to 10 decimals - computed with integers
    (DuckDB divides decimals in floating point)."""
    s = f"CAST(sum({xdec(x)}) * 1000000 AS HUGEINT)"
    n = f"CAST(count({xdec(x)}) AS HUGEINT)"
    q = (f"CASE WHEN {s} >= 0 THEN (2 * {s} * 10000 + {n}) // (2 * {n}) "
         f"ELSE -((2 * (-{s}) * 10000 + {n}) // (2 * {n})) END")
    return f"(CASE WHEN {n} > 0 THEN CAST({q} AS DOUBLE) / 10000000000.0 END)"

def viol(r: RangeRule) -> str:
    return f"({r.column} IS NOT NULL AND ({r.column} < {r.lo} OR {r.column} > {r.hi}))"


def flag_cols(rules) -> str:
    n = " + ".join(f"(CASE WHEN {viol(r)} THEN 1 ELSE 0 END)" for r in rules)
    reasons = ", ".join(f"CASE WHEN {viol(r)} THEN '{r.column}_out_of_range' END" for r in rules)
    q = " ".join(f"WHEN {k} THEN {s}" for k, s in enumerate(C.QUALITY_BY_FLAGS))
    return (f"({n}) AS n_reasons, concat_ws('|', {reasons}) AS reasons, ({n}) > 0 AS is_anomaly, "
            f"CASE ({n}) {q} ELSE {C.QUALITY_FLOOR} END AS quality_score")


def hard(rules) -> str:
    h = [viol(r) for r in rules if r.hard]
    return " OR ".join(h) if h else "FALSE"


def completeness(cols) -> str:
    return " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)


# ------------------------------------------------------------------ lineitem
LI_BASE = f"""
li_raw AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS equipment_id, l_linestatus AS equipment_type,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp", l_returnflag AS operating_status,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem),
li_p AS (
  SELECT *, try_strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS parsed_ts,
         coalesce({hard(B.LI_RULES)}, FALSE) AS hard_violation
  FROM li_raw),
li_flag AS (
  SELECT * EXCLUDE (hard_violation), {flag_cols(B.LI_RULES)},
         {completeness(B.LI_SENSORS)} AS completeness
  FROM li_p WHERE parsed_ts IS NOT NULL AND NOT hard_violation),
li_quar AS (
  SELECT equipment_id, equipment_type, "timestamp" AS raw_timestamp,
         CASE WHEN parsed_ts IS NULL THEN '{C.REASON_BAD_TS}' ELSE '{C.REASON_HARD_LIMIT}' END AS quarantine_reason,
         l_orderkey, l_linenumber, l_extendedprice
  FROM li_p WHERE parsed_ts IS NULL OR hard_violation),
li_reg AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS equipment_id, s_name AS model, n_name AS site_location,
         s_acctbal / 100.0 AS max_engine_temp_c
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def li_dedup(src: str = "li_flag", where: str = "TRUE") -> str:
    ties = ", ".join(B.LI_TIES)
    return f"""(SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY equipment_id, parsed_ts
                               ORDER BY quality_score DESC, completeness DESC, {ties}) AS rn
  FROM {src} WHERE {where}) WHERE rn = 1)"""


LI_SILVER = f"""{LI_BASE},
li_dedup AS {li_dedup()},
li_silver AS (
  SELECT d.*, r.model, r.site_location, r.max_engine_temp_c,
         d.parsed_ts AS reading_timestamp, CAST(d.parsed_ts AS DATE) AS reading_date
  FROM li_dedup d LEFT JOIN li_reg r USING (equipment_id))"""


def _event_branch(spec, i: int) -> str:
    value = spec.value_sql
    last = spec.ladder[-1][0]
    sev = " ".join(f"WHEN ({value}) > ({b}) THEN '{label}'" for b, label in spec.ladder)
    desc = _concat_sql(spec.description_sql.replace("sensor_value", f"({value})"))
    return f"""SELECT equipment_id, equipment_type, reading_timestamp AS event_timestamp,
         '{spec.anomaly_type}' AS anomaly_type, CASE {sev} ELSE '{spec.ladder[-1][1]}' END AS severity,
         '{spec.sensor_name}' AS sensor_name, CAST(({value}) AS DOUBLE) AS sensor_value,
         CAST(({spec.threshold_sql}) AS DOUBLE) AS threshold_value, {desc} AS description
  FROM li_silver
  WHERE equipment_type = '{spec.equipment_type}' AND coalesce({spec.status_sql}, FALSE)
    AND coalesce(({value}) > ({last}), FALSE)"""


def _concat_sql(expr: str) -> str:
    """Rewrite a ``concat('a', round(x, d), ...)`` template into DuckDB
    ``||`` with Spark rounding (``||`` is NULL-propagating like Spark's
    ``concat``)."""
    import re
    body = expr.strip()
    assert body.startswith("concat(") and body.endswith(")")
    body = body[len("concat("):-1]
    parts, depth, cur = [], 0, ""
    for ch in body:
        if ch == "," and depth == 0:
            parts.append(cur.strip())
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    parts.append(cur.strip())
    out = []
    for p in parts:
        m = re.fullmatch(r"round\((.*),\s*(\d+)\)", p)
        if m:
            out.append(f"CAST({sr(m.group(1), int(m.group(2)))} AS VARCHAR)")
        else:
            out.append(p)
    return "(" + " || ".join(out) + ")"


LI_EVENTS = f"""{LI_SILVER},
li_ev0 AS (
  {" UNION ALL ".join(_event_branch(s, i) for i, s in enumerate(B.LI_THRESHOLDS))}),
li_ev AS (
  SELECT {sid("equipment_id", "event_timestamp", "sensor_name")} AS event_id, * FROM li_ev0)"""


# -------------------------------------------------------------------- events
EV_BASE = f"""
ev_raw AS (
  SELECT CAST(user_id AS VARCHAR) AS equipment_id, 'user' AS equipment_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp", event_type AS operating_status,
         event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, ts AS ingestion_timestamp
  FROM events),
ev_p AS (
  SELECT *, try_strptime("timestamp", '%Y-%m-%dT%H:%M:%S') AS parsed_ts,
         coalesce({hard(B.EV_RULES)}, FALSE) AS hard_violation
  FROM ev_raw),
ev_flag AS (
  SELECT * EXCLUDE (hard_violation), {flag_cols(B.EV_RULES)}, {completeness(("value", "k"))} AS completeness
  FROM ev_p WHERE parsed_ts IS NOT NULL AND NOT hard_violation),
ev_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY equipment_id, parsed_ts
                                 ORDER BY quality_score DESC, completeness DESC, ingestion_timestamp, event_id) AS rn
    FROM ev_flag) WHERE rn = 1),
ev_reg AS (
  SELECT CAST(c_custkey AS VARCHAR) AS equipment_id, c_name AS model, c_mktsegment AS manufacturer,
         n_name AS site_location, c_acctbal / 10.0 AS max_engine_temp_c
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
ev_silver AS (
  SELECT d.*, r.model, r.manufacturer, r.site_location, r.max_engine_temp_c,
         d.parsed_ts AS reading_timestamp, CAST(d.parsed_ts AS DATE) AS reading_date
  FROM ev_dedup d LEFT JOIN ev_reg r USING (equipment_id)),
ev_kpi0 AS (
  SELECT equipment_id, equipment_type, date_trunc('hour', reading_timestamp) AS kpi_hour,
         CAST(reading_timestamp AS DATE) AS kpi_date, site_location,
         CAST(count(*) AS BIGINT) AS total_readings,
         CAST(sum(CASE WHEN operating_status IN ('click', 'purchase') THEN 1 ELSE 0 END) AS BIGINT) AS operating_readings,
         CAST(sum(CASE WHEN operating_status IN ('view') THEN 1 ELSE 0 END) AS BIGINT) AS idle_readings,
         CAST(sum(CASE WHEN contains(operating_status, 'error') THEN 1 ELSE 0 END) AS BIGINT) AS down_readings,
         {xavg("value")} AS avg_value, max(value) AS max_value, {xavg("k / 10")} AS avg_k_tenths,
         {xavg("value / 50")} AS avg_vib, max(value / 50) AS max_vib,
         {xsum("CASE WHEN value > 100.0 THEN value END")} AS total_payload_tonnes,
         CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
         {xavg("quality_score")} AS avg_quality_score
  FROM ev_silver GROUP BY ALL),
ev_kpi AS (
  SELECT *, {sr("operating_readings / total_readings * 100", 2)} AS utilization_pct FROM ev_kpi0),
ev_daily AS (
  SELECT equipment_id, equipment_type, kpi_date, site_location,
         {xavg("avg_value")} AS daily_avg_temp, max(max_value) AS daily_max_temp,
         {xavg("avg_k_tenths")} AS daily_avg_oil_press, {xavg("avg_value")} AS daily_avg_hyd_press,
         {xavg("avg_vib")} AS daily_avg_vib, max(max_vib) AS daily_max_vib,
         {xavg("utilization_pct")} AS daily_utilization, CAST(sum(anomaly_count) AS BIGINT) AS daily_anomaly_count,
         {xavg("avg_quality_score")} AS daily_avg_quality
  FROM ev_kpi GROUP BY ALL),
ev_lim AS (
  SELECT d.*, r.max_engine_temp_c AS max_safe_temp FROM ev_daily d LEFT JOIN ev_reg r USING (equipment_id)),
ev_comp0 AS (
  SELECT *,
    CASE WHEN daily_max_temp IS NULL THEN 100.0 WHEN max_safe_temp IS NULL THEN 80.0
         ELSE greatest(0.0, {sr("(1.0 - daily_max_temp / max_safe_temp) * 100", 2)}) END AS temperature_score,
    CASE WHEN daily_avg_oil_press IS NULL AND daily_avg_hyd_press IS NULL THEN 80.0
         WHEN daily_avg_oil_press IS NOT NULL
           THEN greatest(0.0, least(100.0, {sr("daily_avg_oil_press / 5.5 * 100", 2)}))
         ELSE greatest(0.0, least(100.0, {sr("(1.0 - abs(daily_avg_hyd_press - 280.0) / 280.0) * 100", 2)})) END
      AS pressure_score,
    CASE WHEN daily_max_vib IS NULL THEN 90.0 WHEN daily_max_vib > 15.0 THEN 10.0 WHEN daily_max_vib > 10.0 THEN 30.0
         WHEN daily_max_vib > 7.0 THEN 60.0 ELSE {sr("100.0 - daily_max_vib * 5.0", 2)} END AS vibration_score,
    {sr("daily_avg_quality * 50.0 + least(daily_utilization, 100.0) * 0.3 + greatest(0.0, 20.0 - daily_anomaly_count * 0.5)", 2)}
      AS performance_score
  FROM ev_lim),
ev_comp AS (
  SELECT *, CASE WHEN health_score < 20.0 THEN 'critical' WHEN health_score < 50.0 THEN 'warning'
                 WHEN health_score < 70.0 THEN 'watch' ELSE 'normal' END AS health_status
  FROM (SELECT *, {sr("temperature_score * 0.25 + pressure_score * 0.25 + vibration_score * 0.25 + performance_score * 0.25", 2)}
                  AS health_score FROM ev_comp0)),
ev_trend0 AS (
  SELECT *, lag(health_score) OVER (PARTITION BY equipment_id
                                    ORDER BY kpi_date, site_location NULLS FIRST, equipment_type NULLS FIRST)
              AS health_score_prev_day
  FROM ev_comp),
ev_trend AS (
  SELECT *, CASE WHEN health_score_prev_day IS NULL THEN 'stable'
                 WHEN health_score - health_score_prev_day > 5.0 THEN 'improving'
                 WHEN health_score - health_score_prev_day < -5.0 THEN 'degrading' ELSE 'stable' END AS health_trend
  FROM ev_trend0),
ev_health AS (
  SELECT equipment_id, equipment_type, kpi_date AS score_date, site_location,
         temperature_score, pressure_score, vibration_score, performance_score, health_score, health_status,
         health_score_prev_day, health_trend,
         CASE WHEN health_trend = 'degrading'
              THEN CAST(greatest(1, CAST({sr("health_score / greatest(1.0, abs(health_score - health_score_prev_day))", 0)} AS INTEGER)) AS INTEGER)
         END AS days_to_maintenance_estimate
  FROM ev_trend),
ev_halerts AS (
  SELECT {sid("equipment_id", "score_date", "site_location", "'health_score'")} AS alert_id,
         equipment_id, equipment_type, score_date AS alert_date, health_status AS severity,
         'health_score' AS alert_type,
         equipment_id || ' health score: ' || CAST({sr("health_score", 1)} AS VARCHAR) AS title,
         'Equipment ' || equipment_id || ' at ' || site_location || ' has health score '
           || CAST({sr("health_score", 1)} AS VARCHAR) || ' (' || health_status || ')' || '. Trend: ' || health_trend
           || CASE WHEN days_to_maintenance_estimate IS NOT NULL
                   THEN '. Est. days to failure: ' || CAST(days_to_maintenance_estimate AS VARCHAR) ELSE '' END
           AS description,
         CASE WHEN health_status = 'critical' THEN '{C.ALERT_ACTION_CRITICAL}' ELSE '{C.ALERT_ACTION_WARNING}' END
           AS recommended_action,
         health_score, FALSE AS acknowledged
  FROM ev_health WHERE health_status IN ('critical', 'warning')),
ev_talerts AS (
  SELECT {sid("equipment_id", "score_date", "site_location", "'trend'")} AS alert_id,
         equipment_id, equipment_type, score_date AS alert_date, 'watch' AS severity, 'trend' AS alert_type,
         equipment_id || ' degrading trend detected' AS title,
         'Equipment ' || equipment_id || ' health score dropped from ' || CAST({sr("health_score_prev_day", 1)} AS VARCHAR)
           || ' to ' || CAST({sr("health_score", 1)} AS VARCHAR) || ' over 24 hours.' AS description,
         '{C.ALERT_ACTION_TREND}' AS recommended_action, health_score, FALSE AS acknowledged
  FROM ev_health WHERE health_trend = 'degrading' AND health_status = 'watch'),
ev_alerts AS (SELECT * FROM ev_halerts UNION ALL SELECT * FROM ev_talerts)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


EV = with_(EV_BASE)
LI = with_(LI_SILVER)
LIE = with_(LI_EVENTS)

EV_MEASURE_COLS = [m.name for m in B.EV_MEASURES]
EV_ROLLUP_COLS = [m.name for m in B.EV_ROLLUP]


def r6(cols) -> str:
    return ", ".join(f"{sr(c, 6)} AS {c}" for c in cols)


FLEET = f"""
fh AS (
  SELECT score_date, site_location, CAST(count(*) AS BIGINT) AS total_equipment,
         CAST(sum(CASE WHEN health_status != 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS active_equipment,
         CAST(sum(CASE WHEN health_status = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS down_equipment,
         {xavg("health_score")} AS avg_fleet_health_score
  FROM ev_health GROUP BY ALL)"""


def fleet_sql(per_site: bool) -> str:
    fh_pct = f"{sr('active_equipment / total_equipment * 100', 2)}"
    if per_site:
        body = f"""
alert_site AS (
  SELECT a.*, h.site_location FROM ev_alerts a
  LEFT JOIN (SELECT DISTINCT equipment_id, score_date, site_location FROM ev_health) h
    ON a.equipment_id = h.equipment_id AND a.alert_date = h.score_date),
ac AS (
  SELECT alert_date AS a_date, site_location AS a_site,
         CAST(sum(CASE WHEN severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_alerts,
         CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_alerts
  FROM alert_site GROUP BY ALL),
kd AS (
  SELECT kpi_date AS k_date, site_location AS k_site,
         {xsum("total_payload_tonnes")} AS total_payload_tonnes,
         {xavg("utilization_pct")} AS avg_utilization_pct, CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies
  FROM ev_kpi GROUP BY ALL),
j AS (
  SELECT * FROM fh
  LEFT JOIN ac ON fh.score_date = ac.a_date AND fh.site_location IS NOT DISTINCT FROM ac.a_site
  LEFT JOIN kd ON fh.score_date = kd.k_date AND fh.site_location IS NOT DISTINCT FROM kd.k_site)"""
    else:
        body = f"""
ac AS (
  SELECT alert_date AS a_date,
         CAST(sum(CASE WHEN severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_alerts,
         CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_alerts
  FROM ev_alerts GROUP BY ALL),
kd AS (
  SELECT kpi_date AS k_date, {xsum("total_payload_tonnes")} AS total_payload_tonnes,
         {xavg("utilization_pct")} AS avg_utilization_pct, CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies
  FROM ev_kpi GROUP BY ALL),
j AS (
  SELECT * FROM fh LEFT JOIN ac ON fh.score_date = ac.a_date LEFT JOIN kd ON fh.score_date = kd.k_date)"""
    return with_(EV_BASE, FLEET, body) + f"""
SELECT score_date AS summary_date, site_location, total_equipment, active_equipment, down_equipment,
       {fh_pct} AS fleet_availability_pct, {sr("avg_fleet_health_score", 2)} AS avg_fleet_health_score,
       coalesce(critical_alerts, 0) AS critical_alerts, coalesce(warning_alerts, 0) AS warning_alerts,
       CAST(coalesce(total_anomalies, 0) AS INTEGER) AS total_anomalies,
       {sr("total_payload_tonnes", 1)} AS total_payload_tonnes, {sr("avg_utilization_pct", 2)} AS avg_utilization_pct
FROM j"""


LATEST = "(SELECT max(score_date) FROM ev_health)"

BAND_SQL = " ".join(
    (f"WHEN quality_score = {b.lower} THEN '{b.label}'" if b.exact else f"WHEN quality_score >= {b.lower} THEN '{b.label}'")
    for b in C.QUALITY_BANDS_DASHBOARD if b.lower is not None
)
BAND_ELSE = [b.label for b in C.QUALITY_BANDS_DASHBOARD if b.lower is None][0]

# ------------------------------------------------------------------ flotation
_FLOT_DATE = ("CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M') "
              "WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%m/%d/%Y %H:%M') "
              "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END")
FLOT = f"""
fl_raw AS (
  SELECT o_orderkey, {_FLOT_DATE} AS date, o_custkey / 10.0 AS iron_feed_pct, o_totalprice / 200000.0 AS silica_feed_pct,
         o_totalprice / 50000.0 AS ore_pulp_ph, o_totalprice / 1000.0 AS air1, CAST(o_custkey AS DOUBLE) AS air2,
         o_totalprice / 2000.0 AS level1, 70.0 - o_totalprice / 100000.0 AS iron_concentrate_pct,
         o_totalprice / 100000.0 AS silica_concentrate_pct
  FROM orders),
fl_silver AS (
  SELECT *, CAST(reading_timestamp AS DATE) AS reading_date,
         {sr("(0.0 + coalesce(air1, 0) + coalesce(air2, 0) + 0 + 0 + 0 + 0 + 0) / 7", 4)} AS avg_air_flow,
         {sr("(0.0 + coalesce(level1, 0) + 0 + 0 + 0 + 0 + 0 + 0) / 7", 4)} AS avg_column_level,
         silica_concentrate_pct > 3.0 AS silica_above_threshold,
         CASE WHEN silica_concentrate_pct IS NULL THEN 0.5 WHEN silica_concentrate_pct <= 2.0 THEN 1.0
              WHEN silica_concentrate_pct <= 3.0 THEN 0.8 WHEN silica_concentrate_pct <= 4.0 THEN 0.5 ELSE 0.2 END
           AS quality_score
  FROM (SELECT *, coalesce(try_strptime(date, '%Y-%m-%d %H:%M:%S'), try_strptime(date, '%d/%m/%Y %H:%M'),
                           try_strptime(date, '%m/%d/%Y %H:%M')) AS reading_timestamp FROM fl_raw)
  WHERE reading_timestamp IS NOT NULL),
fl_q0 AS (
  SELECT reading_date AS score_date, CAST(hour(reading_timestamp) AS INTEGER) AS score_hour,
         {sr(xavg("iron_feed_pct"), 4)} AS avg_iron_feed_pct, {sr(xavg("silica_feed_pct"), 4)} AS avg_silica_feed_pct,
         {sr(xavg("iron_concentrate_pct"), 4)} AS avg_iron_concentrate_pct,
         {sr(xavg("silica_concentrate_pct"), 4)} AS avg_silica_concentrate_pct,
         {sr("min(silica_concentrate_pct)", 4)} AS min_silica_concentrate_pct,
         {sr("max(silica_concentrate_pct)", 4)} AS max_silica_concentrate_pct,
         CAST(sum(CASE WHEN silica_above_threshold THEN 1 ELSE 0 END) AS BIGINT) AS silica_breach_count,
         CAST(count(*) AS BIGINT) AS total_readings,
         {sr(xavg("avg_air_flow"), 4)} AS avg_air_flow, {sr(xavg("avg_column_level"), 4)} AS avg_column_level,
         {sr(xavg("ore_pulp_ph"), 4)} AS avg_ore_pulp_ph
  FROM fl_silver GROUP BY ALL),
fl_q AS (
  SELECT *, {sr("100 - silica_breach_rate_pct * 0.5 - greatest(0, (avg_silica_concentrate_pct - 2.0) * 10.0)", 2)}
              AS process_quality_score
  FROM (SELECT *, {sr("silica_breach_count / total_readings * 100", 2)} AS silica_breach_rate_pct FROM fl_q0))"""

PROC_BAND = " ".join(f"WHEN process_quality_score >= {b.lower} THEN '{b.label}'" for b in C.PROCESS_BANDS if b.lower is not None)
PROC_ELSE = [b.label for b in C.PROCESS_BANDS if b.lower is None][0]

# -------------------------------------------------------------------- signals
SIG = f"""
sig AS (
  SELECT label AS experiment_id, vec_id AS measurement_index,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS s FROM embeddings),
sig1 AS (
  SELECT *, len(s) AS sample_count,
         {sr("sqrt(list_reduce(list_transform(s, lambda x: x * x), lambda a, b: a + b) / len(s))", 6)} AS rms_amplitude,
         {sr("list_max(list_transform(s, lambda x: abs(x)))", 6)} AS peak_amplitude,
         list_reduce(s, lambda a, b: a + b) / len(s) AS mean_,
         list_reduce(list_transform(s, lambda x: x * x), lambda a, b: a + b) / len(s) AS meansq
  FROM sig WHERE len(s) > 0),
sig2 AS (
  SELECT *, CASE WHEN rms_amplitude > 0 THEN {sr("peak_amplitude / rms_amplitude", 4)} ELSE 0.0 END AS crest_factor,
         {sr("sqrt(greatest(meansq - mean_ * mean_, 0.0))", 6)} AS std_deviation
  FROM sig1),
sig3 AS (
  SELECT *, {sr("greatest(0.0, 100.0 - rms_amplitude * 200.0 - greatest(0.0, (crest_factor - 3.0) * 5.0))", 2)}
              AS bearing_health_index
  FROM sig2)"""

# ------------------------------------------------------------------- queries
ORACLE: dict[str, str] = {}

ORACLE["range_flags"] = with_(LI_BASE) + """
SELECT equipment_id, l_orderkey, l_linenumber, l_partkey, reasons, CAST(n_reasons AS INTEGER) AS n_reasons,
       is_anomaly, quality_score FROM li_flag"""

ORACLE["quality_distribution"] = LI + f"""
SELECT quality_band, records, {sr("records * 100.0 / sum(records) OVER ()", 2)} AS pct FROM (
  SELECT CASE {BAND_SQL} ELSE '{BAND_ELSE}' END AS quality_band, CAST(count(*) AS BIGINT) AS records
  FROM li_silver GROUP BY 1)"""

ORACLE["quarantine_split"] = with_(LI_BASE) + """
SELECT equipment_id, equipment_type, raw_timestamp, quarantine_reason, l_orderkey, l_linenumber, l_extendedprice
FROM li_quar"""

ORACLE["dedup_keep_best"] = with_(LI_BASE, f"li_dedup AS {li_dedup()}") + """
SELECT equipment_id, parsed_ts AS reading_timestamp, l_orderkey, l_linenumber, l_partkey, quality_score FROM li_dedup"""

ORACLE["enrich_registry"] = LI + """
SELECT equipment_id, reading_timestamp, reading_date, model, site_location, max_engine_temp_c, l_orderkey,
       l_linenumber, quality_score FROM li_silver"""

_T = li_dedup(where="equipment_type = 'F'")
_U = li_dedup(where="equipment_type = 'O'")
ORACLE["merge_upsert"] = with_(
    LI_BASE,
    f"t AS (SELECT *, 'target' AS load, 0 AS src FROM {_T})",
    f"u AS (SELECT *, 'update' AS load, 1 AS src FROM {_U})",
) + """
SELECT equipment_id, parsed_ts AS reading_timestamp, l_orderkey, l_linenumber, quality_score, load FROM (
  SELECT *, row_number() OVER (PARTITION BY equipment_id, parsed_ts ORDER BY quality_score DESC NULLS LAST, src) AS rn
  FROM (SELECT * FROM t UNION ALL SELECT * FROM u)) WHERE rn = 1"""

ORACLE["parse_timestamps"] = """
SELECT event_id, CAST(ts AS VARCHAR) AS "timestamp",
       try_strptime(CAST(ts AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS parsed_ts,
       CASE WHEN try_strptime(CAST(ts AS VARCHAR), '%Y-%m-%d %H:%M:%S') IS NULL THEN 'invalid_timestamp' END
         AS quarantine_reason
FROM events"""

ORACLE["threshold_events"] = LIE + """
SELECT event_id, equipment_id, equipment_type, event_timestamp, anomaly_type, severity, sensor_name, sensor_value,
       threshold_value, description FROM li_ev"""

ORACLE["anomalies_by_severity"] = LIE + """
SELECT CAST(event_timestamp AS DATE) AS event_date, severity, CAST(count(*) AS BIGINT) AS anomaly_count
FROM li_ev GROUP BY 1, 2"""

ORACLE["hourly_kpis"] = EV + f"""
SELECT equipment_id, equipment_type, kpi_hour, kpi_date, site_location, total_readings, operating_readings,
       idle_readings, down_readings, {r6(EV_MEASURE_COLS)}, anomaly_count,
       {sr("avg_quality_score", 6)} AS avg_quality_score, utilization_pct
FROM ev_kpi"""

ORACLE["daily_rollup"] = EV + f"""
SELECT equipment_id, equipment_type, kpi_date, site_location, {r6(EV_ROLLUP_COLS)} FROM ev_daily"""

ORACLE["component_scores"] = EV + """
SELECT equipment_id, kpi_date, site_location, temperature_score, pressure_score, vibration_score,
       performance_score, health_score, health_status FROM ev_comp"""

ORACLE["health_scores"] = EV + "\nSELECT * FROM ev_health"

ORACLE["health_trend"] = EV + """
SELECT equipment_id, score_date, site_location, health_score, health_score_prev_day, health_trend FROM ev_health"""

ORACLE["days_to_maintenance"] = EV + """
SELECT equipment_id, score_date, health_score, health_score_prev_day, days_to_maintenance_estimate
FROM ev_health WHERE days_to_maintenance_estimate IS NOT NULL"""

ORACLE["health_alerts"] = EV + "\nSELECT * FROM ev_halerts"
ORACLE["trend_alerts"] = EV + "\nSELECT * FROM ev_talerts"
ORACLE["fleet_summary"] = fleet_sql(False)
ORACLE["fleet_summary_per_site"] = fleet_sql(True)

ORACLE["latest_scorecard"] = EV + f"""
SELECT equipment_id, equipment_type, health_score, health_status, temperature_score, pressure_score,
       vibration_score, performance_score, health_trend, days_to_maintenance_estimate
FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["component_breakdown"] = EV + f"""
SELECT equipment_id, 'Temperature' AS component, temperature_score AS score FROM ev_health WHERE score_date = {LATEST}
UNION ALL SELECT equipment_id, 'Pressure', pressure_score FROM ev_health WHERE score_date = {LATEST}
UNION ALL SELECT equipment_id, 'Vibration', vibration_score FROM ev_health WHERE score_date = {LATEST}
UNION ALL SELECT equipment_id, 'Performance', performance_score FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["degrading_history"] = EV + f"""
SELECT equipment_id, score_date, health_score, health_status, health_trend FROM ev_health
WHERE equipment_id IN (SELECT equipment_id FROM ev_health
                       WHERE score_date = {LATEST} AND health_status IN ('critical', 'warning'))"""

ORACLE["topn_anomalies"] = LIE + """
SELECT equipment_id, equipment_type, CAST(count(*) AS BIGINT) AS total_anomalies,
       CAST(sum(CASE WHEN severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical,
       CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning
FROM li_ev GROUP BY 1, 2 ORDER BY total_anomalies DESC, equipment_id, equipment_type LIMIT 10"""

ORACLE["funnel_counts"] = LI + """
SELECT 'Bronze Input' AS stage, CAST(count(*) AS BIGINT) AS records FROM li_raw
UNION ALL SELECT 'Silver Output', CAST(count(*) AS BIGINT) FROM li_silver
UNION ALL SELECT 'Quarantined', CAST(count(*) AS BIGINT) FROM li_quar"""

_CONV = LI + f""",
cnt AS (SELECT (SELECT count(*) FROM li_raw) AS b, (SELECT count(*) FROM li_silver) AS s,
               (SELECT count(*) FROM li_quar) AS q)"""

ORACLE["conversion_metrics"] = _CONV + f"""
SELECT CAST(b AS BIGINT) AS bronze_records, CAST(s AS BIGINT) AS silver_records,
       CAST(q AS BIGINT) AS quarantined_records, CAST(0 AS BIGINT) AS rescued_records,
       CASE WHEN b > 0 THEN {sr("s / b * 100", 2)} ELSE 0.0 END AS conversion_rate_pct,
       CASE WHEN b > 0 THEN {sr("q / b * 100", 2)} ELSE 0.0 END AS quarantine_rate_pct
FROM cnt"""

ORACLE["latency_stats"] = EV + f"""
SELECT {xavg("lag")} AS avg_lag_sec, max(lag) AS max_lag_sec, min(lag) AS min_lag_sec,
       quantile_disc(lag, {C.LATENCY_PERCENTILE}) AS p95_lag_sec
FROM (SELECT (epoch_us(TIMESTAMP '{B.AS_OF_TEXT}') - epoch_us(ingestion_timestamp)) // 1000000 AS lag FROM ev_silver)"""

ORACLE["freshness"] = f"""
SELECT 'events' AS table_name, max(ts) AS latest_record,
       CAST(floor((epoch_us(TIMESTAMP '{B.AS_OF_TEXT}') - epoch_us(max(ts))) / 60000000.0) AS BIGINT) AS minutes_behind
FROM events
UNION ALL SELECT 'orders', max(o_orderdate),
       CAST(floor((epoch_us(TIMESTAMP '{B.AS_OF_TEXT}') - epoch_us(max(o_orderdate))) / 60000000.0) AS BIGINT) FROM orders
UNION ALL SELECT 'lineitem', max(l_shipdate),
       CAST(floor((epoch_us(TIMESTAMP '{B.AS_OF_TEXT}') - epoch_us(max(l_shipdate))) / 60000000.0) AS BIGINT) FROM lineitem"""

ORACLE["recommendations"] = with_(LI_SILVER, EV_BASE) + f""",
cnt AS (SELECT (SELECT count(*) FROM li_raw) AS b, (SELECT count(*) FROM li_quar) AS q),
rate AS (SELECT CASE WHEN b > 0 THEN {sr("q / b * 100", 2)} ELSE 0.0 END AS r FROM cnt),
bad AS (SELECT equipment_id FROM ev_health WHERE score_date = {LATEST} AND health_status IN ('critical', 'warning')),
crit AS (SELECT count(*) AS n FROM ev_alerts WHERE severity = 'critical' AND acknowledged = FALSE)
SELECT 1 AS priority, CAST(NULL AS VARCHAR) AS equipment_id, 'Quarantine rate is ' || format('{{:,.2f}}', r)
         || '%. Review quarantined records and investigate sensor calibration issues.' AS recommendation
FROM rate WHERE r > {C.QUARANTINE_RATE_ALERT_PCT}
UNION ALL
SELECT DISTINCT 2, equipment_id, 'Equipment ' || equipment_id
         || ' showing degrading health trends. Schedule proactive maintenance to prevent unplanned downtime.'
FROM bad
UNION ALL
SELECT 3, NULL, CAST(n AS VARCHAR) || ' unacknowledged critical alerts. Immediate attention required.'
FROM crit WHERE n > 0"""

ORACLE["clean_flotation"] = with_(FLOT) + """
SELECT o_orderkey, date, reading_timestamp, reading_date, avg_air_flow, avg_column_level, silica_above_threshold,
       quality_score FROM fl_silver"""

ORACLE["process_quality"] = with_(FLOT) + """
SELECT score_date, score_hour, avg_iron_feed_pct, avg_silica_feed_pct, avg_iron_concentrate_pct,
       avg_silica_concentrate_pct, min_silica_concentrate_pct, max_silica_concentrate_pct, silica_breach_count,
       total_readings, avg_air_flow, avg_column_level, avg_ore_pulp_ph, silica_breach_rate_pct, process_quality_score
FROM fl_q"""

ORACLE["process_bands"] = with_(FLOT) + f"""
SELECT CASE {PROC_BAND} ELSE '{PROC_ELSE}' END AS quality_band, CAST(count(*) AS BIGINT) AS hours FROM fl_q GROUP BY 1"""

_LAB = """
lab AS (
  SELECT l.doc_id, l.quality, l.toxic, CAST(d.n_chars AS DOUBLE) AS air, CAST(d.n_chars AS DOUBLE) AS proc,
         CAST(l.doc_id AS DOUBLE) AS rpm, d.n_chars / 100.0 AS torque, l.doc_id / 10.0 AS wear
  FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id),
lng AS (
  SELECT 'quality' AS flag, quality AS hit, * EXCLUDE (quality, toxic) FROM lab
  UNION ALL SELECT 'toxic', toxic, * EXCLUDE (quality, toxic) FROM lab)"""

ORACLE["failure_calibration"] = with_(_LAB) + f"""
SELECT CASE flag WHEN 'quality' THEN '{B.LABEL_FLAGS["quality"]}' WHEN 'toxic' THEN '{B.LABEL_FLAGS["toxic"]}' END
         AS failure_type,
       failure_count, total_records, {sr("failure_count / total_records * 100", 4)} AS failure_rate_pct,
       {sr("a1", 2)} AS avg_air_temp_k, {sr("a2", 2)} AS avg_process_temp_k, {sr("a3", 2)} AS avg_rotational_speed_rpm,
       {sr("a4", 2)} AS avg_torque_nm, {sr("a5", 2)} AS avg_tool_wear_min,
       {sr("p1", 2)} AS temp_threshold_k, {sr("p2", 2)} AS torque_threshold_nm, {sr("p3", 2)} AS wear_threshold_min
FROM (
  SELECT flag, CAST(count(*) FILTER (WHERE hit = 1) AS BIGINT) AS failure_count, CAST(count(*) AS BIGINT) AS total_records,
         {xavg("CASE WHEN hit = 1 THEN air END")} AS a1, {xavg("CASE WHEN hit = 1 THEN proc END")} AS a2,
         {xavg("CASE WHEN hit = 1 THEN rpm END")} AS a3, {xavg("CASE WHEN hit = 1 THEN torque END")} AS a4,
         {xavg("CASE WHEN hit = 1 THEN wear END")} AS a5,
         quantile_disc(proc, {C.FAILURE_PERCENTILE}) FILTER (WHERE hit = 1) AS p1,
         quantile_disc(torque, {C.FAILURE_PERCENTILE}) FILTER (WHERE hit = 1) AS p2,
         quantile_disc(wear, {C.FAILURE_PERCENTILE}) FILTER (WHERE hit = 1) AS p3
  FROM lng GROUP BY flag) WHERE failure_count > 0"""

ORACLE["signal_features"] = with_(SIG) + """
SELECT experiment_id, measurement_index, CAST(sample_count AS INTEGER) AS sample_count, rms_amplitude, peak_amplitude,
       crest_factor, std_deviation, bearing_health_index FROM sig3"""

ORACLE["signal_moments"] = with_(SIG) + f""",
m AS (
  SELECT measurement_index, s, list_reduce(s, lambda a, b: a + b) / len(s) AS mu FROM sig WHERE len(s) > 0),
c AS (
  SELECT measurement_index,
         list_reduce(list_transform(s, lambda x: pow(x - mu, 2)), lambda a, b: a + b) / len(s) AS m2,
         list_reduce(list_transform(s, lambda x: pow(x - mu, 3)), lambda a, b: a + b) / len(s) AS m3,
         list_reduce(list_transform(s, lambda x: pow(x - mu, 4)), lambda a, b: a + b) / len(s) AS m4
  FROM m)
SELECT measurement_index, CASE WHEN m2 > 0 THEN {sr("m4 / pow(m2, 2)", 6)} END AS kurtosis,
       CASE WHEN m2 > 0 THEN {sr("m3 / pow(m2, 1.5)", 6)} END AS skewness FROM c"""

ORACLE["bearing_health"] = with_(SIG) + f"""
SELECT experiment_id, {sr(xavg("bearing_health_index"), 2)} AS avg_health, {sr("min(bearing_health_index)", 2)} AS min_health,
       {sr(xavg("rms_amplitude"), 6)} AS avg_rms, CAST(count(*) AS BIGINT) AS measurements
FROM sig3 GROUP BY experiment_id"""

ORACLE["decimal_comma"] = """
SELECT o_orderkey, price_text, price_grouped_text,
       TRY_CAST(replace(price_text, ',', '.') AS DOUBLE) AS price,
       TRY_CAST(replace(price_grouped_text, ',', '.') AS DOUBLE) AS price_grouped
FROM (SELECT o_orderkey, replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS price_text,
             translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS price_grouped_text FROM orders)"""

ORACLE["rescue_json"] = """
SELECT event_id AS id, 'events' AS src, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS _rescued_data FROM events
UNION ALL
SELECT doc_id, 'documents', CAST(NULL AS INTEGER), CASE WHEN length(trim(text)) > 0 THEN text END FROM documents"""

ORACLE["stream_ingest"] = """
SELECT *, 'events.parquet' AS source_file FROM events"""

ORACLE["stream_hourly_window"] = f"""
WITH w AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, user_id,
         CAST(count(*) AS BIGINT) AS total_readings,
         CAST(sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS BIGINT) AS operating_readings,
         {xavg("value")} AS avg_value, max(value) AS max_value
  FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, total_readings, operating_readings,
       {sr("operating_readings / total_readings * 100", 2)} AS utilization_pct, {sr("avg_value", 6)} AS avg_value, max_value
FROM w"""

ORACLE["zscore_anomalies"] = f"""
WITH x AS (
  SELECT CAST(user_id AS VARCHAR) AS equipment_id, ts, value, date_trunc('hour', ts) AS h FROM events),
units AS (
  SELECT equipment_id, h, CAST(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,18)), 6) * 1000000 AS HUGEINT) AS u FROM x
  WHERE value IS NOT NULL),
hourly AS (
  SELECT equipment_id, h, CAST(count(*) AS HUGEINT) AS n, sum(u) AS s1, sum(u * u) AS s2 FROM units GROUP BY 1, 2),
base AS (
  SELECT equipment_id, h,
         CAST(sum(n) OVER w AS HUGEINT) AS bn, CAST(sum(s1) OVER w AS HUGEINT) AS b1, CAST(sum(s2) OVER w AS HUGEINT) AS b2
  FROM hourly
  WINDOW w AS (PARTITION BY equipment_id ORDER BY epoch(h) RANGE BETWEEN {168 * 3600} PRECEDING AND 1 PRECEDING)),
stats AS (
  -- whole numbers: n times the value less the sum, over n times the deviation
  SELECT equipment_id, h, bn, b1, CAST(b1 AS DOUBLE) / CAST(bn AS DOUBLE) / 1000000 AS mu,
         sqrt(CAST(bn * b2 - b1 * b1 AS DOUBLE) * CAST(bn AS DOUBLE) / CAST(bn - 1 AS DOUBLE)) AS nsd
  FROM base WHERE bn >= 3),
z AS (
  SELECT x.equipment_id, x.ts, x.value, s.mu,
         CAST(s.bn * CAST(round(CAST(CAST(x.value AS VARCHAR) AS DECIMAL(38,18)), 6) * 1000000 AS HUGEINT) - s.b1 AS DOUBLE) / s.nsd AS z
  FROM x JOIN stats s ON x.equipment_id = s.equipment_id AND x.h = s.h WHERE s.nsd > 0)
SELECT equipment_id, ts AS event_timestamp, CASE WHEN abs(z) > 5.0 THEN 'critical' ELSE 'warning' END AS severity,
       value AS sensor_value, {sr("mu", 6)} AS baseline_mean, {sr("z", 6)} AS z_score
FROM z WHERE abs(z) > 2.5"""

# the files of the gate's own folder
ORACLE["table_stats"] = " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, {sr("sum(size) / 1048576.0", 2)} AS size_mb, CAST(count(*) AS BIGINT) AS num_files,
       CAST(floor(epoch(max(last_modified))) AS BIGINT) AS last_modified_s
FROM read_blob('/root/testdata/sf0.01/{t}.parquet')""" for t in ("lineitem", "orders", "events", "supplier", "customer"))

ORACLE["rate_of_change"] = f"""
WITH x AS (
  SELECT CAST(user_id AS VARCHAR) AS equipment_id, ts, value,
         lag(value) OVER (PARTITION BY CAST(user_id AS VARCHAR) ORDER BY ts, value) AS prev
  FROM events WHERE value IS NOT NULL)
SELECT equipment_id, ts AS event_timestamp,
       CASE WHEN abs(value - prev) > 600.0 THEN 'critical' ELSE 'warning' END AS severity, value AS sensor_value,
       'value changed by ' || CAST({sr("value - prev", 2)} AS VARCHAR) AS description
FROM x WHERE abs(value - prev) > 300.0"""

ORACLE["anomaly_frequency_alerts"] = EV + f"""
SELECT {sid("equipment_id", "kpi_date", "site_location", "'anomaly_frequency'")} AS alert_id, equipment_id,
       kpi_date AS alert_date, 'warning' AS severity, 'anomaly_frequency' AS alert_type,
       equipment_id || ' frequent anomalies' AS title,
       'Equipment ' || equipment_id || ' flagged ' || CAST(daily_anomaly_count AS VARCHAR) || ' readings (limit 1).'
         AS description
FROM ev_daily WHERE daily_anomaly_count > 1"""


# ------------------------------------------------------------ report queries
LI_KPI = f"""
li_kpi0 AS (
  SELECT equipment_id, equipment_type, date_trunc('day', reading_timestamp) AS kpi_hour,
         CAST(reading_timestamp AS DATE) AS kpi_date, site_location,
         CAST(count(*) AS BIGINT) AS total_readings,
         CAST(sum(CASE WHEN operating_status IN ('N') THEN 1 ELSE 0 END) AS BIGINT) AS operating_readings,
         CAST(sum(CASE WHEN operating_status IN ('A') THEN 1 ELSE 0 END) AS BIGINT) AS idle_readings,
         CAST(sum(CASE WHEN contains(operating_status, 'R') THEN 1 ELSE 0 END) AS BIGINT) AS down_readings,
         {xavg("l_quantity")} AS avg_quantity, max(l_quantity) AS max_quantity,
         {xavg("l_discount * 100")} AS avg_discount_pct, {xavg("l_extendedprice / 1000")} AS avg_price_k,
         max(l_tax * 100) AS max_tax_pct,
         {xsum("CASE WHEN l_quantity > 10.0 THEN l_quantity END")} AS total_payload_tonnes,
         CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
         {xavg("quality_score")} AS avg_quality_score
  FROM li_silver GROUP BY ALL),
li_kpi AS (
  SELECT *, {sr("operating_readings / total_readings * 100", 2)} AS utilization_pct FROM li_kpi0)"""

LIK = with_(LI_SILVER, LI_KPI)
EV_QUAR = """
ev_quar AS (
  SELECT equipment_id, equipment_type, "timestamp" AS raw_timestamp,
         CASE WHEN parsed_ts IS NULL THEN 'invalid_timestamp' ELSE 'out_of_range_hard_limit' END AS quarantine_reason
  FROM ev_p WHERE parsed_ts IS NULL OR hard_violation)"""

ORACLE["total_units_latest"] = EV + f"""
SELECT CAST(count(DISTINCT equipment_id) AS BIGINT) AS total_equipment FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["availability_latest"] = EV + f"""
SELECT {sr("CAST(sum(CASE WHEN health_status != 'critical' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*)", 1)}
         AS fleet_availability_pct
FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["avg_health_latest"] = EV + f"""
SELECT {sr(xavg("health_score"), 1)} AS avg_health_score FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["open_critical_alerts"] = EV + """
SELECT CAST(count(*) AS BIGINT) AS critical_alerts FROM ev_alerts WHERE severity = 'critical' AND acknowledged = FALSE"""

ORACLE["status_distribution"] = EV + f"""
SELECT health_status, CAST(count(*) AS BIGINT) AS equipment_count FROM ev_health WHERE score_date = {LATEST}
GROUP BY health_status"""

ORACLE["daily_health_trend"] = EV + f"""
SELECT score_date, {sr(xavg("health_score"), 2)} AS avg_health_score, {sr("min(health_score)", 2)} AS min_health_score,
       {sr("max(health_score)", 2)} AS max_health_score
FROM ev_health GROUP BY score_date"""

ORACLE["utilization_by_type"] = LIK + f"""
SELECT kpi_date, equipment_type, {sr(xavg("utilization_pct"), 2)} AS avg_utilization_pct FROM li_kpi GROUP BY 1, 2"""

ORACLE["daily_payload"] = LIK + f"""
SELECT kpi_date, {sr(xsum("total_payload_tonnes"), 0)} AS total_payload_tonnes FROM li_kpi
WHERE equipment_type = 'F' GROUP BY kpi_date"""

ORACLE["score_history"] = EV + "\nSELECT score_date, equipment_id, health_score FROM ev_health"

ORACLE["kpi_trend_quantity"] = LIK + f"""
SELECT kpi_hour, equipment_id, {sr("avg_quantity", 2)} AS avg_quantity, {sr("max_quantity", 2)} AS max_quantity
FROM li_kpi WHERE equipment_type = 'F' AND avg_quantity IS NOT NULL"""

ORACLE["kpi_trend_rates"] = LIK + f"""
SELECT kpi_hour, equipment_id, {sr("avg_discount_pct", 3)} AS avg_discount_pct, {sr("max_tax_pct", 3)} AS max_tax_pct
FROM li_kpi WHERE equipment_type = 'O' AND avg_discount_pct IS NOT NULL"""

ORACLE["kpi_price_vs_quantity"] = LIK + f"""
SELECT equipment_id, kpi_hour, {sr("avg_price_k", 2)} AS avg_price_k, {sr("avg_discount_pct", 2)} AS avg_discount_pct,
       {sr("avg_quantity", 1)} AS avg_quantity
FROM li_kpi WHERE equipment_type = 'O' AND avg_price_k IS NOT NULL"""

ORACLE["kpi_trend_events"] = EV + f"""
SELECT kpi_hour, equipment_id, {sr("avg_value", 1)} AS avg_value, {sr("avg_k_tenths", 1)} AS avg_k_tenths
FROM ev_kpi WHERE equipment_type = 'user' AND avg_value IS NOT NULL"""

ORACLE["open_alerts"] = EV + f"""
SELECT alert_id, equipment_id, equipment_type, severity, alert_type, title, description, recommended_action,
       {sr("health_score", 1)} AS health_score, TIMESTAMP '{B.AS_OF_TEXT}' AS alert_timestamp
FROM ev_alerts WHERE acknowledged = FALSE"""

ORACLE["anomalies_by_unit_severity"] = LIE + """
SELECT equipment_id, severity, CAST(count(*) AS BIGINT) AS anomaly_count FROM li_ev GROUP BY 1, 2"""

ORACLE["anomalies_by_sensor"] = LIE + f"""
SELECT sensor_name, CAST(count(*) AS BIGINT) AS event_count, {sr(xavg("sensor_value"), 2)} AS avg_sensor_value,
       {sr(xavg("threshold_value"), 2)} AS threshold
FROM li_ev GROUP BY sensor_name"""

ORACLE["anomaly_timeline"] = LIE + """
SELECT CAST(event_timestamp AS DATE) AS event_date, equipment_id, CAST(count(*) AS BIGINT) AS anomaly_count
FROM li_ev GROUP BY 1, 2"""

ORACLE["alerts_by_unit_type"] = EV + """
SELECT equipment_id, alert_type, CAST(count(*) AS BIGINT) AS alert_count FROM ev_alerts GROUP BY 1, 2"""

ORACLE["row_counts"] = with_(LI_EVENTS, EV_BASE) + """
SELECT 'Bronze - Sensor Readings' AS table_name, CAST(count(*) AS BIGINT) AS records FROM li_raw
UNION ALL SELECT 'Silver - Cleaned Readings', CAST(count(*) AS BIGINT) FROM li_silver
UNION ALL SELECT 'Silver - Quarantine', CAST(count(*) AS BIGINT) FROM li_quar
UNION ALL SELECT 'Silver - Anomaly Events', CAST(count(*) AS BIGINT) FROM li_ev
UNION ALL SELECT 'Gold - Hourly KPIs', CAST(count(*) AS BIGINT) FROM ev_kpi
UNION ALL SELECT 'Gold - Health Scores', CAST(count(*) AS BIGINT) FROM ev_health
UNION ALL SELECT 'Gold - Alerts', CAST(count(*) AS BIGINT) FROM ev_alerts"""

ORACLE["layer_counts"] = """
SELECT 'raw_sensor_readings' AS table_name, CAST(count(*) AS BIGINT) AS records FROM lineitem
UNION ALL SELECT 'raw_flotation_readings', CAST(count(*) AS BIGINT) FROM orders
UNION ALL SELECT 'raw_maintenance_labels', CAST(count(*) AS BIGINT) FROM labels
UNION ALL SELECT 'raw_bearing_vibration', CAST(NULL AS BIGINT)"""

ORACLE["quarantine_reasons"] = with_(LI_BASE, EV_BASE, EV_QUAR) + """
SELECT quarantine_reason, CAST(count(*) AS BIGINT) AS records FROM (
  SELECT quarantine_reason FROM li_quar UNION ALL SELECT quarantine_reason FROM ev_quar) GROUP BY 1"""

ORACLE["rows_per_type"] = LI + """
SELECT equipment_type, CAST(count(*) AS BIGINT) AS record_count FROM li_silver GROUP BY 1"""

ORACLE["rows_per_ingestion_day"] = """
SELECT CAST(ts AS DATE) AS ingestion_date, CAST(count(*) AS BIGINT) AS records_ingested FROM events GROUP BY 1"""

ORACLE["silica_trend"] = with_(FLOT) + """
SELECT score_date, score_hour, avg_silica_concentrate_pct, process_quality_score, silica_breach_rate_pct
FROM fl_q ORDER BY score_date, score_hour LIMIT 500"""

ORACLE["iron_vs_silica"] = with_(FLOT) + """
SELECT avg_iron_concentrate_pct, avg_silica_concentrate_pct, process_quality_score
FROM fl_q ORDER BY score_date, score_hour LIMIT 1000"""

ORACLE["failure_types"] = "SELECT failure_type, failure_count, failure_rate_pct, temp_threshold_k, " \
    "torque_threshold_nm, wear_threshold_min FROM (" + ORACLE["failure_calibration"] + ")"

ORACLE["active_alerts"] = EV + """
SELECT alert_id, equipment_id, severity, alert_type, title, recommended_action, health_score
FROM ev_alerts WHERE acknowledged = FALSE"""

ORACLE["critical_equipment"] = EV + """
SELECT equipment_id, equipment_type, score_date, health_score, health_status, health_trend,
       days_to_maintenance_estimate
FROM ev_health WHERE health_status IN ('critical', 'warning')"""

ORACLE["status_counts"] = LI + """
SELECT equipment_type, operating_status, CAST(count(*) AS BIGINT) AS records FROM li_silver GROUP BY 1, 2"""


def health_chain_sql(p: str, kpi: str, reg: str, rollup: dict[str, str], date_expr: str) -> str:
    """Roll-up -> limits -> component scores -> trend -> health rows, as CTEs
    named ``{p}_daily`` ... ``{p}_health``."""
    cols = ",\n         ".join(f"{expr} AS {name}" for name, expr in rollup.items())
    return f"""
{p}_daily AS (
  SELECT equipment_id, equipment_type, {date_expr} AS kpi_date, site_location,
         {cols}
  FROM {kpi} GROUP BY ALL),
{p}_lim AS (
  SELECT d.*, r.max_engine_temp_c AS max_safe_temp FROM {p}_daily d LEFT JOIN {reg} r USING (equipment_id)),
{p}_comp0 AS (
  SELECT *,
    CASE WHEN daily_max_temp IS NULL THEN 100.0 WHEN max_safe_temp IS NULL THEN 80.0
         ELSE greatest(0.0, {sr("(1.0 - daily_max_temp / max_safe_temp) * 100", 2)}) END AS temperature_score,
    CASE WHEN daily_avg_oil_press IS NULL AND daily_avg_hyd_press IS NULL THEN 80.0
         WHEN daily_avg_oil_press IS NOT NULL
           THEN greatest(0.0, least(100.0, {sr("daily_avg_oil_press / 5.5 * 100", 2)}))
         ELSE greatest(0.0, least(100.0, {sr("(1.0 - abs(daily_avg_hyd_press - 280.0) / 280.0) * 100", 2)})) END
      AS pressure_score,
    CASE WHEN daily_max_vib IS NULL THEN 90.0 WHEN daily_max_vib > 15.0 THEN 10.0 WHEN daily_max_vib > 10.0 THEN 30.0
         WHEN daily_max_vib > 7.0 THEN 60.0 ELSE {sr("100.0 - daily_max_vib * 5.0", 2)} END AS vibration_score,
    {sr("daily_avg_quality * 50.0 + least(daily_utilization, 100.0) * 0.3 + greatest(0.0, 20.0 - daily_anomaly_count * 0.5)", 2)}
      AS performance_score
  FROM {p}_lim),
{p}_comp AS (
  SELECT *, CASE WHEN health_score < 20.0 THEN 'critical' WHEN health_score < 50.0 THEN 'warning'
                 WHEN health_score < 70.0 THEN 'watch' ELSE 'normal' END AS health_status
  FROM (SELECT *, {sr("temperature_score * 0.25 + pressure_score * 0.25 + vibration_score * 0.25 + performance_score * 0.25", 2)}
                  AS health_score FROM {p}_comp0)),
{p}_trend AS (
  SELECT *, CASE WHEN health_score_prev_day IS NULL THEN 'stable'
                 WHEN health_score - health_score_prev_day > 5.0 THEN 'improving'
                 WHEN health_score - health_score_prev_day < -5.0 THEN 'degrading' ELSE 'stable' END AS health_trend
  FROM (SELECT *, lag(health_score) OVER (PARTITION BY equipment_id
                    ORDER BY kpi_date, site_location NULLS FIRST, equipment_type NULLS FIRST) AS health_score_prev_day
        FROM {p}_comp)),
{p}_health AS (
  SELECT equipment_id, equipment_type, kpi_date AS score_date, site_location,
         temperature_score, pressure_score, vibration_score, performance_score, health_score, health_status,
         health_score_prev_day, health_trend,
         CASE WHEN health_trend = 'degrading'
              THEN CAST(greatest(1, CAST({sr("health_score / greatest(1.0, abs(health_score - health_score_prev_day))", 0)} AS INTEGER)) AS INTEGER)
         END AS days_to_maintenance_estimate
  FROM {p}_trend)"""


LI_MONTH = health_chain_sql("lim", "li_kpi", "li_reg", {
    "daily_avg_temp": xavg("avg_quantity"),
    "daily_max_temp": "max(max_quantity)",
    "daily_avg_oil_press": xavg("avg_discount_pct"),
    "daily_avg_hyd_press": xavg("avg_price_k"),
    "daily_max_vib": "max(max_tax_pct)",
    "daily_utilization": xavg("utilization_pct"),
    "daily_anomaly_count": "CAST(sum(anomaly_count) AS BIGINT)",
    "daily_avg_quality": xavg("avg_quality_score"),
}, "CAST(date_trunc('month', kpi_date) AS DATE)")

ORACLE["monthly_health"] = with_(LI_SILVER, LI_KPI, LI_MONTH) + "\nSELECT * FROM lim_health"

ORACLE["latest_health"] = EV + f"""
SELECT equipment_id, equipment_type, health_score, health_status, health_trend, days_to_maintenance_estimate,
       temperature_score, pressure_score, vibration_score, performance_score
FROM ev_health WHERE score_date = {LATEST}"""

ORACLE["stream_silver"] = with_(LI_BASE, f"li_dedup AS {li_dedup()}") + """
SELECT equipment_id, parsed_ts AS reading_timestamp, l_orderkey, l_linenumber, l_partkey, quality_score, reasons
FROM li_dedup"""

# direct DFT (DuckDB has no FFT): |X_k|^2 of the mean-removed signal for
# k = 1..n/2, the largest bin wins; energy = sum |X_k|^2 / n = sum x^2 (Parseval)
ORACLE["spectral_features"] = f"""
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
c AS (
  SELECT vec_id, v, len(v) AS n, list_reduce(v, lambda a, b: a + b) / len(v) AS mu FROM s WHERE len(v) > 0),
x AS (
  SELECT vec_id, n, unnest(range(n)) AS j, unnest(v) AS val, mu FROM c),
bins AS (
  SELECT x.vec_id, x.n, k.k,
         pow(sum((x.val - x.mu) * cos(2 * pi() * x.j * k.k / x.n)), 2)
           + pow(sum((x.val - x.mu) * sin(2 * pi() * x.j * k.k / x.n)), 2) AS p
  FROM x JOIN (SELECT unnest(range(1, 33)) AS k) k ON k.k <= x.n / 2
  GROUP BY x.vec_id, x.n, k.k),
dom AS (
  SELECT vec_id, n, arg_max(k, p) AS k FROM bins GROUP BY vec_id, n)
SELECT c.vec_id AS measurement_index, CAST(c.n AS INTEGER) AS sample_count,
       {sr("d.k * 20480.0 / c.n", 6)} AS dominant_frequency_hz,
       {sr("list_reduce(list_transform(c.v, lambda t: t * t), lambda a, b: a + b)", 6)} AS spectral_energy
FROM c JOIN dom d ON c.vec_id = d.vec_id"""

ORACLE["threshold_alerts"] = LIE + f"""
SELECT equipment_id, equipment_type, site_location, alert_date, 'critical' AS severity, 'threshold' AS alert_type,
       equipment_id || ' ' || sensor_name || ' over its limit' AS title,
       'Equipment ' || equipment_id || ' had ' || n || ' critical ' || sensor_name || ' readings, the highest ' ||
         CAST({sr("worst", 1)} AS VARCHAR) || '.' AS description,
       'Immediate inspection required. Consider taking equipment offline.' AS recommended_action
FROM (SELECT e.equipment_id, e.equipment_type, r.site_location, CAST(e.event_timestamp AS DATE) AS alert_date, sensor_name,
             count(*) AS n, max(sensor_value) AS worst
      FROM li_ev e LEFT JOIN li_reg r USING (equipment_id) WHERE severity = 'critical' GROUP BY ALL)"""

ORACLE["stream_keyed_state"] = ORACLE["stream_silver"]

ORACLE["kept_calibration"] = f"""
SELECT failure_type, failure_count, total_records, failure_rate_pct, avg_air_temp_k, avg_torque_nm, avg_tool_wear_min,
       TRUE AS temp_rank_ok, TRUE AS wear_rank_ok
FROM ({ORACLE["failure_calibration"]})"""
ORACLE["kept_latency"] = f"""
SELECT avg_lag_sec, max_lag_sec, min_lag_sec, TRUE AS p95_rank_ok FROM ({ORACLE["latency_stats"]})"""
