"""No stage loses, repeats or reverts rows."""

import math
import os

import pytest
from pyspark.sql import functions as F

from quarrysight.functions.checks import exact_avg, exact_sum
from quarrysight.plans import layers as L
from quarrysight.sources import files as SF
from quarrysight.sources import tables as T
from tests.fixtures import bronze_df, reading, registry_df

from .test_plans import as_of_col


@pytest.mark.parametrize("values", [(1.0, math.nan, 3.0), (1.0, math.inf), (1e-7, 3e-7), (2e12, 4e12), (0.1, 0.2, None),
                                    (-math.inf, math.inf), (None,), (1e300, 1e300), (12.345678, 0.0)])
def test_means_are_those_of_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(exact_avg("x").alias("a"), exact_sum("x").alias("s"), F.avg("x").alias("pa"), F.sum("x").alias("ps")).first()
    for ours, plain in ((got.a, got.pa), (got.s, got.ps)):
        assert (ours is None) == (plain is None)
        if plain is not None:
            assert (math.isnan(ours) and math.isnan(plain)) or ours == plain or math.isclose(ours, plain, rel_tol=1e-5)


def test_upsert_does_not_bring_back_old_rows(spark, workdir):
    path = os.path.join(workdir, "t")

    def rows(*r):
        return spark.createDataFrame(list(r), "k long, day string, quality_score double")

    T.merge_upsert(spark, path, rows((1, "d1", 0.5), (2, "d2", 0.5)), ["k", "day"], "day")
    T.merge_upsert(spark, path, rows((1, "d1", 0.6)), ["k", "day"], "day")
    T.write_table(rows((1, "d1", 0.9), (3, "d1", 0.9)), path, "overwrite", ("day",))      # corrected by hand
    T.merge_upsert(spark, path, rows((2, "d2", 0.7), (4, "d3", 0.1)), ["k", "day"], "day")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "day", "quality_score").collect())
    assert got == [(1, "d1", 0.9), (2, "d2", 0.7), (3, "d1", 0.9), (4, "d3", 0.1)]
    assert os.listdir(path + "__staging") == []


def test_bronze_is_silver_and_quarantine_and_copies(spark, workdir):
    lay = L.Layout(os.path.join(workdir, "lake"))
    rows = [reading("HT-001", "haul_truck", "BAD", "loaded", engine_temp_c=1.0)] * 3
    rows += [reading("HT-001", None, "2024-09-01T06:00:00", "loaded", engine_temp_c=80.0)]           # breaks the contract
    rows += [reading("HT-001", "haul_truck", "2024-09-01T06:05:00", "loaded", engine_temp_c=80.0)] * 2  # one is a copy
    bronze_df(spark, rows).write.partitionBy("ingestion_date").parquet(lay.path("bronze", "raw_sensor_readings"))
    registry_df(spark).write.parquet(lay.path("silver", "equipment_registry"))
    for _ in range(2):
        L.silver(spark, lay, as_of_col())
        q = spark.read.parquet(lay.path("silver", "quarantine_records"))
        reasons = dict(q.groupBy("quarantine_reason").count().collect())
        assert sorted(reasons.values()) == [1, 3] and reasons["contract_violation"] == 1
        assert spark.read.parquet(lay.path("silver", "cleaned_sensor_readings")).count() + q.count() + 1 == len(rows)


def test_whole_vibration_signals(spark, workdir):
    folder = os.path.join(workdir, "1st_test")
    os.makedirs(folder)
    with open(os.path.join(folder, "2003.10.22.12.06.24"), "w") as f:
        f.writelines("\t".join(str(i + b) for b in range(8)) + "\n" for i in range(3000))
    df = SF.read_vibration_files(spark, workdir, as_of_col(), experiments={"1st_test": 1}, bearings=4)
    assert {r[0] for r in df.select(F.size("vibration_signal")).collect()} == {3000}
    cut = SF.read_vibration_files(spark, workdir, as_of_col(), experiments={"1st_test": 1}, bearings=4, max_samples=10)
    assert {r[0] for r in cut.select(F.size("vibration_signal")).collect()} == {10}


def test_alerts_count_at_each_site_of_a_unit(spark):
    import datetime as dt

    from quarrysight.operators import alerts as AL
    from quarrysight.operators import fleet as FL
    d = dt.date(2024, 1, 1)
    health = spark.createDataFrame(
        [("U", "t", d, "S1", 10.0, "critical", "stable", None, None), ("U", "t", d, "S2", 30.0, "warning", "stable", 5, None),
         ("V", "t", d, None, 90.0, "normal", "stable", None, 80.0)],
        "equipment_id string, equipment_type string, score_date date, site_location string, health_score double, "
        "health_status string, health_trend string, days_to_maintenance_estimate int, health_score_prev_day double")
    kpis = spark.createDataFrame([(d, "S1", 100.0, 50.0, 3)],
                                 "kpi_date date, site_location string, total_payload_tonnes double, utilization_pct double, "
                                 "anomaly_count int")
    alerts = AL.all_alerts(health, as_of_col())
    texts = {r.site_location: r.description for r in alerts.collect()}
    assert texts["S1"].endswith("Trend: stable") and texts["S2"].endswith("Trend: stable. Est. days to failure: 5")
    rows = {r.site_location: r for r in FL.fleet_summary(health, alerts, kpis, as_of_col(), per_site=True).collect()}
    assert [(rows[s].critical_alerts, rows[s].warning_alerts) for s in ("S1", "S2", None)] == [(1, 0), (0, 1), (0, 0)]
    assert rows["S1"].total_anomalies == 3 and rows["S2"].total_anomalies == 0
