"""Threshold events (FIXTURES 3) and the statistical extensions."""

import datetime as dt

from pyspark.sql import functions as F

from quarrysight import config as C
from quarrysight.operators import anomalies as AN
from quarrysight.operators import clean as CL
from quarrysight.operators import enrich as EN
from tests.fixtures import as_of_col, bronze_df, registry_df


def _events(spark, union=False):
    silver = EN.enrich_with_registry(CL.silver_readings(bronze_df(spark)), registry_df(spark), as_of_col())
    fn = AN.threshold_events_by_union if union else AN.threshold_events
    return fn(silver, C.FLEET_THRESHOLD_SPECS, as_of_col())


def test_threshold_events_match_cases(spark):
    ev = _events(spark).collect()
    got = sorted((e.equipment_id, e.event_timestamp.minute, e.sensor_name, e.severity) for e in ev)
    assert got == sorted([
        ("HT-001", 0, "engine_temp_c", "warning"),
        ("HT-001", 3, "engine_temp_c", "critical"),
        ("HT-002", 2, "engine_temp_c", "critical"),       # down_unplanned is not idle
        ("CV-001", 1, "vibration_rms", "warning"),        # 13.0
        ("CV-001", 2, "vibration_rms", "critical"),       # 25.0
        ("CR-001", 1, "crusher_vibration_mms", "watch"),
        ("CR-001", 2, "crusher_vibration_mms", "warning"),
        ("CR-001", 3, "crusher_vibration_mms", "critical"),
        ("EX-001", 1, "hydraulic_oil_temp_c", "watch"),
        ("EX-001", 2, "hydraulic_oil_temp_c", "warning"),
        ("EX-001", 3, "hydraulic_oil_temp_c", "critical"),
    ])


def test_event_fields(spark):
    ev = {(e.equipment_id, e.event_timestamp.minute): e for e in _events(spark).collect()}
    w = ev[("HT-001", 0)]
    assert w.threshold_value == 110.0  # full limit even for the 0.9 warning
    assert w.description == "Engine temp 100.0C exceeds 99.0C threshold"
    assert w.anomaly_type == "threshold_breach" and w.z_score is None
    assert ev[("CV-001", 1)].sensor_value == 13.0
    assert ev[("CV-001", 1)].description == "Conveyor vibration RMS 13.0 mm/s exceeds 7.0 mm/s"
    assert len(w.event_id) == 64


def test_event_ids_are_stable(spark):
    a = sorted(r.event_id for r in _events(spark).collect())
    b = sorted(r.event_id for r in _events(spark).collect())
    assert a == b


def test_single_scan_equals_union(spark):
    cols = ["event_id", "severity", "sensor_value", "description"]
    a = sorted(map(tuple, _events(spark).select(cols).collect()))
    b = sorted(map(tuple, _events(spark, union=True).select(cols).collect()))
    assert a == b


def _series(spark, values, unit="U1"):
    base = dt.datetime(2024, 1, 1)
    rows = [(unit, "pump", base + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "equipment_id string, equipment_type string, reading_timestamp timestamp, v double")


def test_zscore_flags_outlier(spark):
    vals = [10, 11, 9, 10, 11, 9, 10, 11, 9, 10, 60]
    out = AN.zscore_anomalies(_series(spark, vals), "v", as_of_col(), baseline_hours=24, z_threshold=3.0).collect()
    assert [r.sensor_value for r in out] == [60.0]
    assert out[0].anomaly_type == "zscore" and out[0].z_score > 3


def test_rate_of_change_crosses_buckets(spark):
    vals = [10] * 23 + [10, 50] + [50] * 3   # jump at hour 24 (next day)
    out = AN.rate_of_change_anomalies(_series(spark, vals), "v", 30.0, as_of_col(), bucket="day").collect()
    assert len(out) == 1 and out[0].sensor_value == 50.0
    assert out[0].event_timestamp == dt.datetime(2024, 1, 2, 0, 0)


def test_per_type_detectors_partition_the_events(spark):
    silver = EN.enrich_with_registry(CL.silver_readings(bronze_df(spark)), registry_df(spark), as_of_col())
    parts = [AN.engine_temp_anomalies, AN.vibration_anomalies, AN.crusher_vibration_anomalies, AN.oil_temp_anomalies]
    counts = [fn(silver, as_of_col()).count() for fn in parts]
    assert counts == [3, 2, 3, 3]
    assert sum(counts) == _events(spark).count()


def test_split_helpers(spark):
    b = bronze_df(spark)
    ok, bad = CL.split_bad_timestamps(b, as_of_col())
    hard = CL.quarantine_hard_limits(b, as_of_col())
    assert bad.count() == 2 and hard.count() == 2
    assert CL.drop_quarantined(b).count() == ok.count() - 2
