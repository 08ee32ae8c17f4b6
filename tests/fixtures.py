"""Typed fixture rows (FIXTURES.md sections 2-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarrysight import schemas

# --- fixed values: registry rows of the reference fleet ---
REGISTRY = [
    ("HT-001", "haul_truck", "Pit-A North", 110.0, 7.0, 400.0),
    ("HT-002", "haul_truck", "Pit-A South", 110.0, 7.0, 400.0),
    ("HT-003", "haul_truck", "Pit-B", 105.0, 6.5, 363.0),
    ("EX-001", "excavator", "Pit-A North", 95.0, 350.0, 120.0),
    ("EX-002", "excavator", "Pit-B", 100.0, 380.0, 110.0),
    ("CV-001", "conveyor", "Pit-A to Crusher", 80.0, None, None),
    ("CV-002", "conveyor", "Crusher to Stockpile", 80.0, None, None),
    ("CR-001", "crusher", "Primary Crusher Station", 90.0, 5.0, None),
    ("CR-002", "crusher", "Secondary Crusher Station", 85.0, 4.5, None),
]

AS_OF = dt.datetime(2024, 9, 2, 0, 0, 0)
INGEST = dt.datetime(2024, 9, 1, 12, 0, 0)


def registry_df(spark):
    rows = [
        {"equipment_id": e, "equipment_type": t, "model": f"M-{e}", "manufacturer": "Maker",
         "site_location": s, "commissioned_date": dt.date(2020, 1, 1), "last_maintenance_date": dt.date(2024, 8, 1),
         "operating_hours": 1000.0, "status": "active", "max_engine_temp_c": a, "max_oil_pressure_bar": b,
         "max_payload_tonnes": c}
        for e, t, s, a, b, c in REGISTRY
    ]
    return spark.createDataFrame(rows, schemas.EQUIPMENT_REGISTRY)


def reading(eid, etype, ts, status="loaded", source="f1.json", ingest=INGEST, **sensors):
    row = {f.name: None for f in schemas.RAW_SENSOR_READINGS.fields}
    row.update(equipment_id=eid, equipment_type=etype, timestamp=ts, operating_status=status,
               ingestion_timestamp=ingest, source_file=source, ingestion_date=ingest.date())
    row.update(sensors)
    return row


def sensor_cases():
    """FIXTURES.md section 3, rows 1-22 (bronze form)."""
    r = []
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:00:00", "loaded", engine_temp_c=100.0, fuel_rate_lph=300.0))  # 1
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:01:00", "idle", engine_temp_c=120.0))  # 2
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:02:00", "loaded", engine_temp_c=151.0))  # 3
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:03:00", "loaded", engine_temp_c=150.0))  # 4
    r.append(reading("HT-001", "haul_truck", "INVALID_TS_1234", "loaded", engine_temp_c=90.0))  # 5
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:04:00.5", "loaded", engine_temp_c=90.0))  # 6
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:05:00", "loaded", tire_pressure_psi=49.0))  # 7
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:06:00", "loaded", tire_pressure_psi=49.0, speed_kmh=81.0))  # 8
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:07:00", "loaded", tire_pressure_psi=49.0,
                     fuel_rate_lph=701.0, speed_kmh=81.0))  # 9
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:00:00", "loaded", engine_temp_c=100.0, fuel_rate_lph=300.0))  # 10
    r.append(reading("HT-001", "haul_truck", "2024-09-01T06:00:00", "loaded", engine_temp_c=100.0, source="f0.json"))  # 11
    r.append(reading("HT-002", "haul_truck", "2024-09-01T06:00:00", "loaded", engine_temp_c=float("nan")))  # 12
    r.append(reading("HT-002", "haul_truck", "2024-09-01T06:01:00", None, engine_temp_c=111.0))  # 13
    r.append(reading("HT-002", "haul_truck", "2024-09-01T06:02:00", "down_unplanned", engine_temp_c=111.0))  # 14
    r.append(reading("CV-001", "conveyor", "2024-09-01T06:00:00", "running", vibration_x_mms=2.0, vibration_y_mms=3.0, vibration_z_mms=6.0))  # 15
    r.append(reading("CV-001", "conveyor", "2024-09-01T06:01:00", "running", vibration_x_mms=3.0, vibration_y_mms=4.0, vibration_z_mms=12.0))  # 16
    r.append(reading("CV-001", "conveyor", "2024-09-01T06:02:00", "running", vibration_x_mms=9.0, vibration_y_mms=12.0, vibration_z_mms=20.0))  # 17
    r.append(reading("CV-001", "conveyor", "2024-09-01T06:03:00", "running", vibration_x_mms=8.0, vibration_y_mms=None, vibration_z_mms=0.0))  # 18
    r.append(reading("CV-001", "conveyor", "2024-09-01T06:04:00", "stopped", vibration_x_mms=1.0, vibration_y_mms=1.0, vibration_z_mms=1.0))  # 19
    for i, v in enumerate((8.0, 8.1, 10.1, 15.1)):  # 20
        r.append(reading("CR-001", "crusher", f"2024-09-01T06:0{i}:00", "crushing", crusher_vibration_mms=v))
    for i, v in enumerate((80.0, 81.0, 86.0, 96.0)):  # 21
        r.append(reading("EX-001", "excavator", f"2024-09-01T06:0{i}:00", "digging", hydraulic_oil_temp_c=v))
    r.append(reading("XX-999", "haul_truck", "2024-09-01T06:00:00", "loaded", engine_temp_c=140.0))  # 22
    return r


def bronze_df(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else sensor_cases(), schemas.RAW_SENSOR_READINGS)


def as_of_col():
    return F.lit(AS_OF)
