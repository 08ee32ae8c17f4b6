"""End to end: landed files -> bronze -> silver -> gold, rerun, upsert."""

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarrysight import config as C
from quarrysight.plans import layers as L
from tests.fixtures import REGISTRY, as_of_col, sensor_cases

SENSOR_KEYS = None


def _write_sensors(folder, name, rows, extra_lines=()):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            msg = {k: v for k, v in r.items()
                   if k not in ("ingestion_timestamp", "source_file", "ingestion_date", "_rescued_data") and v is not None}
            fh.write(json.dumps(msg, allow_nan=True) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")


def _landing(root):
    rows = sensor_cases()
    _write_sensors(os.path.join(root, "sensors"), "day1.json", rows[:12])
    _write_sensors(os.path.join(root, "sensors"), "day2.json", rows[12:],
                   extra_lines=['{"equipment_id": "HT-003", "equipment_type": "haul_truck", '
                                '"timestamp": "2024-09-01T07:00:00", "engine_temp_c": "bad", "extra": 3}',
                                "not json"])
    os.makedirs(os.path.join(root, "registry"))
    with open(os.path.join(root, "registry", "registry.csv"), "w") as fh:
        fh.write("equipment_id,equipment_type,model,manufacturer,site_location,commissioned_date,operating_hours,"
                 "status,max_engine_temp_c,max_oil_pressure_bar,max_payload_tonnes\n")
        for e, t, s, a, b, c in REGISTRY:
            fh.write(f"{e},{t},M,Maker,{s},2020-01-01,1000,active,{a},{'' if b is None else b},{'' if c is None else c}\n")
    os.makedirs(os.path.join(root, "flotation"))
    headers = list(C.FLOTATION_HEADER_MAP)
    with open(os.path.join(root, "flotation", "plant.csv"), "w") as fh:
        fh.write(",".join(["date"] + [f'"{h}"' for h in headers]) + "\n")
        for d, silica in (("2017-03-10 01:00:00", "3,1"), ("10/03/2017 01:30", "2,1"), ("x", "1,0")):
            vals = ['"1,5"'] * (len(headers) - 1) + [f'"{silica}"']
            fh.write(",".join([d] + vals) + "\n")
    os.makedirs(os.path.join(root, "maintenance"))
    with open(os.path.join(root, "maintenance", "labels.csv"), "w") as fh:
        fh.write(",".join(C.LABEL_HEADER_MAP) + "\n")
        for i in range(1, 11):
            fh.write(f"{i},P{i},M,300,{300 + i},1500,{i},{10 * i},1,0,1,0,0,0\n")
    exp = os.path.join(root, "bearing", "1st_test")
    os.makedirs(exp)
    os.makedirs(os.path.join(root, "bearing", "notes"))
    for k, name in enumerate(("2003.10.22.12.06.24", "2003.10.22.12.16.24")):
        with open(os.path.join(exp, name), "w") as fh:
            for j in range(5):
                fh.write("\t".join(str(0.1 * (j + b + k)) for b in range(4)) + "\n")
            fh.write("bad\t0.5\t0.5\t0.5\n")


def test_layers_end_to_end_and_rerun(spark, workdir):
    landing, base = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    _landing(landing)
    lay = L.run_all(spark, base, landing, as_of_col())
    rd = lambda layer, t: spark.read.parquet(lay.path(layer, t))

    bronze = rd("bronze", "raw_sensor_readings")
    assert bronze.count() == len(sensor_cases()) + 2
    rescued = {r._rescued_data for r in bronze.filter(F.col("_rescued_data").isNotNull()).collect()}
    assert "not json" in rescued
    assert any('"extra":"3"' in x and '"engine_temp_c":"bad"' in x for x in rescued)

    silver = rd("silver", "cleaned_sensor_readings")
    quarantine = rd("silver", "quarantine_records")
    n_silver, n_quar = silver.count(), quarantine.count()
    reasons = dict(quarantine.groupBy("quarantine_reason").count().collect())
    assert reasons == {C.REASON_BAD_TS: 3, C.REASON_HARD_LIMIT: 2}   # + the "not json" line
    assert silver.groupBy("equipment_id", "reading_timestamp").count().filter("count > 1").count() == 0
    assert rd("silver", "anomaly_events").count() == 11
    assert lay.metrics["anomaly_events"] == 11 and lay.metrics["new_quarantined"] == n_quar
    assert lay.metrics["clean_readings"] == n_silver and lay.metrics["flagged_readings"] == 3
    assert rd("gold", "hourly_equipment_kpis").schema["total_readings"].dataType.simpleString() == "int"
    assert rd("gold", "equipment_health_scores").count() > 0
    assert rd("gold", "fleet_summary_daily").count() > 0
    flot = rd("silver", "cleaned_flotation_readings").collect()
    assert len(flot) == 2 and {r.iron_feed_pct for r in flot} == {1.5}
    assert [r.failure_type for r in rd("gold", "failure_predictions").collect()] == ["Heat Dissipation Failure"]
    bear = rd("bronze", "raw_bearing_vibration")
    assert bear.count() == 8 and {r.measurement_index for r in bear.collect()} == {0, 1}
    assert {r.sample_count for r in rd("silver", "bearing_features").collect()} == {5, 6}

    # rerun: nothing new landed -> nothing changes
    L.run_all(spark, base, landing, as_of_col())
    assert rd("bronze", "raw_sensor_readings").count() == bronze.count()
    assert rd("silver", "cleaned_sensor_readings").count() == n_silver
    assert rd("silver", "quarantine_records").count() == n_quar
    assert rd("bronze", "raw_flotation_readings").count() == 3      # CSV files ingested once
    assert rd("bronze", "raw_maintenance_labels").count() == 10
    assert rd("silver", "cleaned_flotation_readings").count() == 2

    # a better copy of a flagged reading replaces it; an equal one does not
    fix = sensor_cases()[6].copy()          # tire 49 -> quality 0.7
    fix["tire_pressure_psi"] = 100.0
    _write_sensors(os.path.join(landing, "sensors"), "day3.json", [fix])
    headers = list(C.FLOTATION_HEADER_MAP)
    with open(os.path.join(landing, "flotation", "plant2.csv"), "w") as fh:   # same hour + a new day
        fh.write(",".join(["date"] + [f'"{h}"' for h in headers]) + "\n")
        for d, silica in (("2017-03-10 01:45:00", "4,5"), ("2017-03-11 02:00:00", "1,0")):
            fh.write(",".join([d] + ['"1,5"'] * (len(headers) - 1) + [f'"{silica}"']) + "\n")
    L.run_all(spark, base, landing, as_of_col())
    s2 = rd("silver", "cleaned_sensor_readings")
    assert s2.count() == n_silver
    row = s2.filter((F.col("equipment_id") == "HT-001") & (F.minute("reading_timestamp") == 5)).collect()
    assert len(row) == 1 and row[0].quality_score == 1.0 and row[0].tire_pressure_psi == 100.0

    # the incremental runs end where one full run over all landed files ends
    full = L.run_all(spark, os.path.join(workdir, "lake_full"), landing, as_of_col())
    drop = {"bronze_ingestion_timestamp", "silver_processed_timestamp", "ingestion_timestamp", "ingestion_date",
            "record_key", "source_file", "batch_id"}
    for layer, t in (("silver", "cleaned_sensor_readings"), ("silver", "anomaly_events"),
                     ("gold", "hourly_equipment_kpis"), ("gold", "equipment_health_scores"),
                     ("gold", "maintenance_alerts"), ("gold", "fleet_summary_daily"),
                     ("silver", "cleaned_flotation_readings"), ("gold", "flotation_quality_scores")):
        def rows(path):
            try:
                df = spark.read.parquet(path)
            except AnalysisException:      # written empty: no files, no schema
                return []
            cols = sorted(c for c in df.columns if c not in drop)
            return sorted(map(str, df.select(cols).collect()))
        assert rows(lay.path(layer, t)) == rows(full.path(layer, t)), (layer, t)


TABLES = (("silver", "anomaly_events"), ("gold", "hourly_equipment_kpis"), ("gold", "equipment_health_scores"),
          ("gold", "maintenance_alerts"), ("gold", "fleet_summary_daily"), ("gold", "kpi_contract_violations"))


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _days_with_new_files(before, after):
    return sorted({f.split("/")[0].split("=")[1] for f in after if before.get(f) != after[f]})


def _contents(spark, lay, layer, t):
    try:
        df = spark.read.parquet(lay.path(layer, t))
    except AnalysisException:
        return []
    return sorted(map(str, df.select(sorted(c for c in df.columns if c not in (
        "bronze_ingestion_timestamp", "silver_processed_timestamp"))).collect()))


def _daily_landing(landing, units, days):
    rows = [dict(equipment_id=u, equipment_type="haul_truck", timestamp=f"{d}T{h:02d}:00:00", operating_status="loaded",
                 engine_temp_c=80.0 + 5 * k + h, payload_tonnes=100.0)
            for k, u in enumerate(units) for d in days for h in (20, 21)]
    _write_sensors(os.path.join(landing, "sensors"), f"{days[0]}-{'-'.join(units)}.json", rows)


def test_a_late_reading_touches_its_day_and_the_next(spark, workdir):
    landing, base = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    _landing(landing)
    os.remove(os.path.join(landing, "sensors", "day1.json"))
    os.remove(os.path.join(landing, "sensors", "day2.json"))
    _daily_landing(landing, ["HT-001", "HT-002"], ["2024-09-01", "2024-09-02", "2024-09-03"])
    lay = L.run_all(spark, base, landing, as_of_col())
    health = lay.path("gold", "equipment_health_scores")
    before = {t: _files(lay.path(*t)) for t in TABLES if os.path.exists(lay.path(*t))}

    # one unit's readings of 1970: that day, and that unit's next stored day
    _daily_landing(landing, ["HT-001"], ["1970-01-01"])
    L.run_all(spark, base, landing, as_of_col())
    assert _days_with_new_files(before["gold", "equipment_health_scores"], _files(health)) == ["1970-01-01", "2024-09-01"]
    assert _days_with_new_files(before["gold", "hourly_equipment_kpis"],
                                _files(lay.path("gold", "hourly_equipment_kpis"))) == ["1970-01-01"]
    first = {r.equipment_id: r for r in spark.read.parquet(health).where("score_date = '2024-09-01'").collect()}
    assert first["HT-001"].health_score_prev_day is not None and first["HT-002"].health_score_prev_day is None

    # between two stored days, and a unit that was not there before
    _daily_landing(landing, ["HT-002", "HT-003"], ["2024-01-05"])
    L.run_all(spark, base, landing, as_of_col())
    full = L.run_all(spark, os.path.join(workdir, "full"), landing, as_of_col())
    for layer, t in TABLES:
        assert _contents(spark, lay, layer, t) == _contents(spark, full, layer, t), t


def test_a_crash_between_write_and_swap(spark, workdir, monkeypatch):
    from quarrysight.sources import tables as T
    landing, base = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    _landing(landing)
    lay = L.run_all(spark, base, landing, as_of_col())
    _daily_landing(landing, ["HT-001"], ["2024-08-30", "2024-09-01"])
    plain, n = T._rename, [0]

    def breaks(*args):
        n[0] += 1
        if n[0] == 9:
            raise OSError("lost")
        plain(*args)

    monkeypatch.setattr(T, "_rename", breaks)
    try:
        L.run_all(spark, base, landing, as_of_col())
        raise AssertionError("the run was not interrupted")
    except OSError:
        pass
    monkeypatch.setattr(T, "_rename", plain)
    L.run_all(spark, base, landing, as_of_col())
    full = L.run_all(spark, os.path.join(workdir, "full"), landing, as_of_col())
    for layer, t in (("silver", "cleaned_sensor_readings"), *TABLES):
        def rows(x):
            return [r for r in _contents(spark, x, layer, t)]
        assert len(rows(lay)) == len(rows(full)), t
        if t != "cleaned_sensor_readings":
            assert rows(lay) == rows(full), t


def test_violators_of_earlier_runs_stay(spark, workdir, monkeypatch):
    landing, base = os.path.join(workdir, "landing"), os.path.join(workdir, "lake")
    _landing(landing)
    # readings without a type have no KPI row that keeps the contract
    monkeypatch.setattr(L, "KPI_CONTRACT", L.T.Contract(types=L.KPI_CONTRACT.types, not_null=L.KPI_CONTRACT.not_null,
                                                        ranges={"total_readings": (0, 1)}))
    lay = L.run_all(spark, base, landing, as_of_col())
    path = lay.path("gold", "kpi_contract_violations")
    n = spark.read.parquet(path).count()
    assert n > 0
    _daily_landing(landing, ["HT-001"], ["2024-12-24"])
    L.run_all(spark, base, landing, as_of_col())
    assert spark.read.parquet(path).count() >= n
