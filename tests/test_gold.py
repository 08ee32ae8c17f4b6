"""KPIs, health scores, trend, alerts, fleet summary (FIXTURES 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarrysight.functions import scores as S
from quarrysight.operators import alerts as AL
from quarrysight.operators import clean as CL
from quarrysight.operators import enrich as EN
from quarrysight.operators import fleet as FL
from quarrysight.operators import health as HE
from quarrysight.operators import kpis as KP
from tests.fixtures import as_of_col, bronze_df, reading, registry_df


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def _kpis(spark, rows):
    silver = EN.enrich_with_registry(CL.silver_readings(bronze_df(spark, rows)), registry_df(spark), as_of_col())
    return KP.hourly_kpis(silver)


def test_payload_sum_null_when_none_over_10(spark):
    rows = [reading("HT-001", "haul_truck", f"2024-09-01T06:0{i}:00", "loaded", payload_tonnes=p)
            for i, p in enumerate((1.0, 5.0))]
    k = _kpis(spark, rows).collect()[0]
    assert k.total_payload_tonnes is None and k.avg_payload_tonnes == 3.0


def test_utilization_and_status_groups(spark):
    rows = [reading("HT-001", "haul_truck", f"2024-09-01T06:0{i}:00", s, engine_temp_c=80.0)
            for i, s in enumerate(("loaded", "empty", "loaded", "idle"))]
    rows += [reading("CV-001", "conveyor", "2024-09-01T06:00:00", "stopped", vibration_x_mms=8.0, vibration_z_mms=0.0)]
    k = {r.equipment_id: r for r in _kpis(spark, rows).collect()}
    assert k["HT-001"].utilization_pct == 75.0 and k["HT-001"].idle_readings == 1
    cv = k["CV-001"]
    assert cv.total_readings == 1 and cv.operating_readings + cv.idle_readings + cv.down_readings == 0
    assert cv.max_vibration_rms == 8.0  # gold: missing axis counts 0


@pytest.mark.parametrize("temp,limit,want", [(95.0, 110.0, 13.64), (None, 110.0, 100.0), (95.0, None, 80.0),
                                             (120.0, 110.0, 0.0)])
def test_temperature_score(spark, temp, limit, want):
    got = _one(spark, S.temperature_score("t", "l"), "t double, l double", [(temp, limit)])
    assert got == [want]


@pytest.mark.parametrize("oil,hyd,want", [(5.5, None, 100.0), (2.75, None, 50.0), (6.0, None, 100.0),
                                          (None, 280.0, 100.0), (None, 336.0, 80.0), (None, None, 80.0)])
def test_pressure_score(spark, oil, hyd, want):
    assert _one(spark, S.pressure_score("o", "h"), "o double, h double", [(oil, hyd)]) == [want]


@pytest.mark.parametrize("v,want", [(15.1, 10.0), (15.0, 30.0), (10.0, 60.0), (7.0, 65.0), (None, 90.0)])
def test_vibration_score(spark, v, want):
    assert _one(spark, S.vibration_score("v"), "v double", [(v,)]) == [want]


def test_performance_and_health(spark):
    assert _one(spark, S.performance_score("q", "u", "f"), "q double, u double, f long", [(1.0, 80.0, 0)]) == [94.0]
    h = _one(spark, S.health_score("a", "b", "c", "d"), "a double, b double, c double, d double",
             [(13.64, 100.0, 90.0, 94.0)])
    assert h == [74.41]


@pytest.mark.parametrize("h,want", [(19.99, "critical"), (20.0, "warning"), (49.99, "warning"), (50.0, "watch"),
                                    (69.99, "watch"), (70.0, "normal"), (None, "normal")])
def test_health_status(spark, h, want):
    assert _one(spark, S.health_status("h"), "h double", [(h,)]) == [want]


@pytest.mark.parametrize("prev,cur,trend,days", [(70.0, 64.0, "degrading", 11), (70.0, 65.0, "stable", None),
                                                 (50.0, 20.0, "degrading", 1), (None, 50.0, "stable", None),
                                                 (50.0, 60.0, "improving", None)])
def test_trend_and_days(spark, prev, cur, trend, days):
    df = spark.createDataFrame([(cur, prev)], "s double, p double").withColumn("t", S.health_trend("s", "p"))
    r = df.select("t", S.days_to_maintenance("s", "p", "t").alias("d")).collect()[0]
    assert (r.t, r.d) == (trend, days)


def _health_rows(spark, rows):
    cols = ("equipment_id string, equipment_type string, kpi_date date, site_location string, daily_max_temp double, "
            "max_safe_temp double, daily_avg_oil_press double, daily_avg_hyd_press double, daily_max_vib double, "
            "daily_avg_quality double, daily_utilization double, daily_anomaly_count long")
    return HE.health_scores(spark.createDataFrame(rows, cols), as_of_col())


def test_trend_uses_previous_available_row(spark):
    d = dt.date
    rows = [("U", "t", d(2024, 1, 1), "S", 0.0, 100.0, 5.5, None, 1.0, 1.0, 100.0, 0),
            ("U", "t", d(2024, 1, 5), "S", 90.0, 100.0, 1.0, None, 16.0, 0.1, 0.0, 40)]
    h = sorted(_health_rows(spark, rows).collect(), key=lambda r: r.score_date)
    assert h[0].health_trend == "stable" and h[0].health_score_prev_day is None
    assert h[1].health_score_prev_day == h[0].health_score and h[1].health_trend == "degrading"
    assert h[1].days_to_maintenance_estimate >= 1


def test_alert_with_null_site_has_null_description(spark):
    d = dt.date(2024, 1, 1)
    rows = [("U", "t", d, None, 100.0, 100.0, 0.0, None, 16.0, 0.1, 0.0, 40)]
    h = _health_rows(spark, rows)
    a = AL.health_alerts(h, as_of_col()).collect()
    assert len(a) == 1 and a[0].severity in ("critical", "warning") and a[0].description is None
    assert a[0].title.startswith("U health score: ") and a[0].acknowledged is False


def test_fleet_totals_repeat_per_site_unless_per_site(spark):
    d = dt.date(2024, 1, 1)
    bad = ("A", "t", d, "S1", 100.0, 100.0, 0.0, None, 16.0, 0.1, 0.0, 40)   # critical
    ok = ("B", "t", d, "S2", 10.0, 100.0, 5.5, None, 1.0, 1.0, 100.0, 0)     # normal
    h = _health_rows(spark, [bad, ok])
    alerts = AL.all_alerts(h, as_of_col())
    kcols = "kpi_date date, site_location string, total_payload_tonnes double, utilization_pct double, anomaly_count long"
    kpis = spark.createDataFrame([(d, "S1", 100.0, 50.0, 3), (d, "S2", 50.0, 100.0, 1)], kcols)
    fleet = {r.site_location: r for r in FL.fleet_summary(h, alerts, kpis, as_of_col()).collect()}
    assert fleet["S1"].critical_alerts == 1 and fleet["S2"].critical_alerts == 1
    assert fleet["S1"].total_payload_tonnes == 150.0 and fleet["S2"].total_anomalies == 4
    per = {r.site_location: r for r in FL.fleet_summary(h, alerts, kpis, as_of_col(), per_site=True).collect()}
    assert per["S1"].critical_alerts == 1 and per["S2"].critical_alerts == 0
    assert per["S2"].total_payload_tonnes == 50.0
    assert fleet["S1"].fleet_availability_pct == 0.0 and fleet["S2"].fleet_availability_pct == 100.0


def test_incremental_health_equals_full(spark):
    d = dt.date
    rows = [("U", "t", d(2024, 1, day), "S", float(t), 100.0, 5.5, None, 1.0, 1.0, 100.0, f)
            for day, t, f in ((1, 10.0, 0), (2, 40.0, 10), (3, 90.0, 40), (4, 20.0, 0))]
    rows += [("V", "t", d(2024, 1, 1), None, 50.0, 100.0, 2.0, None, 8.0, 0.7, 50.0, 3)]
    full = sorted(map(tuple, _health_rows(spark, rows).collect()))
    cols = ("equipment_id string, equipment_type string, kpi_date date, site_location string, daily_max_temp double, "
            "max_safe_temp double, daily_avg_oil_press double, daily_avg_hyd_press double, daily_max_vib double, "
            "daily_avg_quality double, daily_utilization double, daily_anomaly_count long")
    old = _health_rows(spark, [r for r in rows if r[2] < d(2024, 1, 3)])
    new_days = spark.createDataFrame([r for r in rows if r[2] >= d(2024, 1, 3)], cols)
    out = HE.health_scores_touching(new_days, old, as_of_col())
    assert out.where("_stored").isEmpty()          # nothing follows the new days
    inc = out.drop("_stored")
    merged = sorted(map(tuple, old.collect())) + sorted(map(tuple, inc.collect()))
    assert sorted(merged) == full
    assert [r.health_trend for r in sorted(inc.collect(), key=lambda r: r.score_date)] == ["degrading", "improving"]

    # any set of days in any order: what is stored and does not change is not returned
    for late in ({1}, {2}, {1, 3}, {2, 4}):
        old = _health_rows(spark, [r for r in rows if r[2].day not in late])
        out = HE.health_scores_touching(spark.createDataFrame([r for r in rows if r[2].day in late], cols), old, as_of_col())
        again = {(r.equipment_id, r.score_date): tuple(r)[:-1] for r in out.collect()}
        kept = [tuple(r) for r in old.collect() if (r.equipment_id, r.score_date) not in again]
        assert sorted(kept + list(again.values())) == full
        assert {d.day for (_, d), r in again.items()} <= late | {day + 1 for day in late}


def test_zero_limit_does_not_fail(spark):
    assert _one(spark, S.temperature_score("t", "l"), "t double, l double", [(50.0, 0.0)]) == [0.0]
