"""Silver: parse, quarantine, flags, de-duplication, enrichment (FIXTURES 3)."""

from pyspark.sql import functions as F

from quarrysight import config as C
from quarrysight.operators import clean as CL
from quarrysight.operators import enrich as EN
from tests.fixtures import as_of_col, bronze_df, registry_df


def _silver(spark):
    b = bronze_df(spark)
    return EN.enrich_with_registry(CL.silver_readings(b), registry_df(spark), as_of_col())


def test_quarantine_reasons(spark):
    q = CL.quarantine_records(bronze_df(spark), as_of_col()).collect()
    got = sorted((r.equipment_id, r.raw_timestamp, r.quarantine_reason) for r in q)
    assert got == sorted([
        ("HT-001", "2024-09-01T06:02:00", C.REASON_HARD_LIMIT),      # 151 > 150
        ("HT-001", "INVALID_TS_1234", C.REASON_BAD_TS),
        ("HT-001", "2024-09-01T06:04:00.5", C.REASON_BAD_TS),        # strict pattern
        ("HT-002", "2024-09-01T06:00:00", C.REASON_HARD_LIMIT),      # NaN > 150 in Spark
    ])
    rec = [r.raw_record for r in q if r.raw_timestamp == "2024-09-01T06:02:00"][0]
    assert '"engine_temp_c":151.0' in rec and '"parsed_ts"' in rec


def test_in_equals_good_plus_quarantined(spark):
    b = bronze_df(spark)
    n_in = b.count()
    assert CL.passing_records(b).count() + CL.quarantine_records(b, as_of_col()).count() == n_in


def test_inclusive_bounds_kept(spark):
    s = _silver(spark)
    row = s.filter((F.col("equipment_id") == "HT-001") & (F.hour("reading_timestamp") == 6)
                   & (F.minute("reading_timestamp") == 3)).collect()
    assert len(row) == 1 and row[0].engine_temp_c == 150.0


def test_flags_in_rule_order(spark):
    s = _silver(spark).filter(F.col("equipment_id") == "HT-001")
    by_min = {r.reading_timestamp.minute: r for r in s.collect()}
    assert by_min[0].quality_score == 1.0 and by_min[0].anomaly_reasons == []
    assert by_min[5].quality_score == 0.7 and by_min[5].anomaly_reasons == ["tire_pressure_psi_out_of_range"]
    assert by_min[6].quality_score == 0.4
    assert by_min[6].anomaly_reasons == ["tire_pressure_psi_out_of_range", "speed_kmh_out_of_range"]
    assert by_min[7].quality_score == 0.1
    assert by_min[7].anomaly_reasons == ["tire_pressure_psi_out_of_range", "fuel_rate_lph_out_of_range",
                                         "speed_kmh_out_of_range"]
    assert by_min[7].is_anomaly and not by_min[0].is_anomaly


def test_dedup_keeps_complete_row(spark):
    s = _silver(spark)
    rows = s.filter((F.col("equipment_id") == "HT-001") & (F.minute("reading_timestamp") == 0)).collect()
    assert len(rows) == 1
    assert rows[0].fuel_rate_lph == 300.0  # the copy with fuel NULL loses the quality tie


def test_one_row_per_key(spark):
    s = _silver(spark)
    assert s.groupBy("equipment_id", "reading_timestamp").count().filter("count > 1").count() == 0


def test_registry_enrichment(spark):
    s = _silver(spark)
    xx = s.filter(F.col("equipment_id") == "XX-999").collect()
    assert len(xx) == 1 and xx[0].site_location is None and xx[0].max_engine_temp_c is None
    ht = s.filter(F.col("equipment_id") == "HT-001").select("site_location", "max_engine_temp_c").distinct().collect()
    assert [(r.site_location, r.max_engine_temp_c) for r in ht] == [("Pit-A North", 110.0)]
    assert "parsed_ts" not in s.columns and "source_file" not in s.columns
    assert s.schema["reading_date"].dataType.simpleString() == "date"


def test_partitioning_does_not_change_silver(spark):
    b = bronze_df(spark)
    one = CL.silver_readings(b.repartition(1)).select("equipment_id", "parsed_ts", "fuel_rate_lph", "quality_score")
    many = CL.silver_readings(b.repartition(7)).select("equipment_id", "parsed_ts", "fuel_rate_lph", "quality_score")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


def test_dedup_uses_partial_top1_before_shuffle(spark):
    plan = CL.silver_readings(bronze_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
