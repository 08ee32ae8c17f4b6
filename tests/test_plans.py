"""Plan shapes that the scale design relies on."""

import os

from pyspark.sql import functions as F

from quarrysight import config as C
from quarrysight.operators import anomalies as AN
from quarrysight.operators import enrich as EN
from quarrysight.operators import failures as FA
from quarrysight.operators import kpis as KP
from quarrysight.operators import quality as QU
from quarrysight.plans import dashboard as DB
from tests.fixtures import as_of_col, registry_df


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver_table(spark, workdir):
    path = os.path.join(workdir, "silver")
    rows = [("CV-001", "conveyor", "running", 3.0, 4.0, 12.0, None, None, None, 80.0),
            ("CR-001", "crusher", "crushing", None, None, None, 12.0, None, None, 90.0),
            ("EX-001", "excavator", "digging", None, None, None, None, 90.0, None, 95.0),
            ("HT-001", "haul_truck", "loaded", None, None, None, None, None, 108.0, 110.0)]
    df = spark.createDataFrame(rows, "equipment_id string, equipment_type string, operating_status string, "
                                     "vibration_x_mms double, vibration_y_mms double, vibration_z_mms double, "
                                     "crusher_vibration_mms double, hydraulic_oil_temp_c double, engine_temp_c double, "
                                     "max_engine_temp_c double") \
        .withColumn("reading_timestamp", F.lit("2024-09-01 06:00:00").cast("timestamp"))
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_all_threshold_rules_in_one_scan(spark, workdir):
    silver = _silver_table(spark, workdir)
    one = _plan(AN.threshold_events(silver, C.FLEET_THRESHOLD_SPECS, as_of_col()))
    many = _plan(AN.threshold_events_by_union(silver, C.FLEET_THRESHOLD_SPECS, as_of_col()))
    assert one.count("FileScan parquet") == 1
    assert many.count("FileScan parquet") == 4
    assert AN.threshold_events(silver, C.FLEET_THRESHOLD_SPECS, as_of_col()).count() == 4


def test_kpis_aggregate_partially_before_the_shuffle(spark, workdir):
    silver = _silver_table(spark, workdir).withColumns({
        "is_anomaly": F.lit(False), "quality_score": F.lit(1.0), "site_location": F.lit("S")})
    for name in ("payload_tonnes", "oil_pressure_bar", "speed_kmh", "hydraulic_pressure_bar", "cycle_time_sec",
                 "belt_speed_mps", "feed_rate_tph", "power_draw_kw", "css_mm"):
        silver = silver.withColumn(name, F.lit(None).cast("double"))
    plan = _plan(KP.hourly_kpis(silver))
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")


def test_calibration_has_no_join_and_one_aggregate(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0, 1, 0, 0, 0, 0)],
                               "air_temperature_k double, process_temperature_k double, rotational_speed_rpm double, "
                               "torque_nm double, tool_wear_min double, twf int, hdf int, pwf int, osf int, rnf int")
    plan = _plan(FA.failure_calibration(df, as_of_col()))
    assert "Join" not in plan and "Expand" in plan


def test_history_uses_a_semi_join(spark):
    h = spark.createDataFrame([("A", "2024-01-01", 10.0, "critical", "stable")],
                              "equipment_id string, score_date string, health_score double, health_status string, "
                              "health_trend string")
    assert "LeftSemi" in _plan(QU.degrading_history(h))


def test_breakdown_is_one_unpivot(spark, workdir):
    path = os.path.join(workdir, "health")
    spark.createDataFrame([("A", "2024-01-01", 1.0, 2.0, 3.0, 4.0)],
                          "equipment_id string, score_date string, temperature_score double, pressure_score double, "
                          "vibration_score double, performance_score double").write.parquet(path)
    plan = _plan(DB.component_breakdown(spark.read.parquet(path)))
    assert "Expand" in plan and "Union" not in plan


def test_joins_are_planned_without_an_action(spark):
    reg = registry_df(spark)
    daily = spark.range(5).selectExpr("cast(id as string) as equipment_id")
    logical = EN.join_limits(daily, reg)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in logical


def test_every_copy_of_a_bad_message_is_quarantined(spark, workdir):
    from quarrysight.plans import layers as L
    from tests.fixtures import bronze_df, reading
    lay = L.Layout(os.path.join(workdir, "lake"))
    rows = [reading("HT-001", "haul_truck", "BAD", "loaded", engine_temp_c=1.0) for _ in range(50)]
    bronze_df(spark, rows).write.partitionBy("ingestion_date").parquet(lay.path("bronze", "raw_sensor_readings"))
    registry_df(spark).write.parquet(lay.path("silver", "equipment_registry"))
    for _ in range(2):      # a rerun of the same batch adds nothing
        m = L.silver(spark, lay, as_of_col())
        assert m["new_quarantined"] == 50 and m["days"] == []
        assert spark.read.parquet(lay.path("silver", "quarantine_records")).count() == 50
