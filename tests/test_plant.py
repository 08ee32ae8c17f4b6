"""Flotation, failure calibration, vibration signals (FIXTURES 5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarrysight import schemas
from quarrysight.operators import failures as FA
from quarrysight.operators import process as PR
from quarrysight.operators import signals as SG
from tests.fixtures import as_of_col


def _flot(spark, rows):
    full = []
    for r in rows:
        base = {f.name: None for f in schemas.RAW_FLOTATION.fields}
        base.update(r)
        full.append(base)
    return spark.createDataFrame(full, schemas.RAW_FLOTATION)


def test_flotation_date_patterns(spark):
    rows = [{"date": d, "silica_concentrate_pct": 1.0} for d in
            ("2017-03-10 01:00:00", "13/03/2017 01:00", "03/13/2017 01:00", "x", "03/04/2017 01:00")]
    out = PR.clean_flotation(_flot(spark, rows), as_of_col()).collect()
    got = sorted((r.date, r.reading_timestamp) for r in out)
    assert got == sorted([
        ("2017-03-10 01:00:00", dt.datetime(2017, 3, 10, 1)),
        ("13/03/2017 01:00", dt.datetime(2017, 3, 13, 1)),
        ("03/13/2017 01:00", dt.datetime(2017, 3, 13, 1)),
        ("03/04/2017 01:00", dt.datetime(2017, 4, 3, 1)),   # dd/MM wins
    ])


@pytest.mark.parametrize("silica,quality,breach", [(None, 0.5, None), (2.0, 1.0, False), (3.0, 0.8, False),
                                                   (3.1, 0.5, True), (4.0, 0.5, True), (4.1, 0.2, True)])
def test_silica_quality(spark, silica, quality, breach):
    out = PR.clean_flotation(_flot(spark, [{"date": "2017-03-10 01:00:00", "silica_concentrate_pct": silica}]),
                             as_of_col()).collect()[0]
    assert (out.quality_score, out.silica_above_threshold) == (quality, breach)


def test_row_means_null_as_zero(spark):
    r = {"date": "2017-03-10 01:00:00", **{f"flotation_col_0{i}_air_flow": 7.0 for i in range(1, 7)}}
    out = PR.clean_flotation(_flot(spark, [r]), as_of_col()).collect()[0]
    assert out.avg_air_flow == 6.0 and out.avg_column_level == 0.0


def test_hourly_process_score(spark):
    rows = [{"date": "2017-03-10 01:00:00", "silica_concentrate_pct": 3.1},
            {"date": "2017-03-10 01:30:00", "silica_concentrate_pct": 2.1},
            {"date": "2017-03-10 02:00:00", "silica_concentrate_pct": None}]
    q = {r.score_hour: r for r in PR.flotation_hourly_quality(PR.clean_flotation(_flot(spark, rows), as_of_col()),
                                                               as_of_col()).collect()}
    assert q[1].silica_breach_rate_pct == 50.0 and q[1].process_quality_score == 69.0
    assert q[2].process_quality_score == 100.0   # no silica values: no penalty


def test_failure_calibration(spark):
    rows = [(float(t), 300.0, 1500.0, float(t), 10.0 * t, 0, 1, 0, 0, 0) for t in range(1, 11)]
    df = spark.createDataFrame(rows, "air_temperature_k double, process_temperature_k double, "
                                     "rotational_speed_rpm double, torque_nm double, tool_wear_min double, "
                                     "twf int, hdf int, pwf int, osf int, rnf int")
    out = FA.failure_calibration(df, as_of_col()).collect()
    assert [r.failure_type for r in out] == ["Heat Dissipation Failure"]
    r = out[0]
    assert (r.failure_count, r.total_records, r.failure_rate_pct) == (10, 10, 100.0)
    assert r.torque_threshold_nm == 9.0 and r.avg_torque_nm == 5.5


def _sig(spark, signals):
    rows = [(1, 1, i, str(i), [float(x) for x in s], 20480) for i, s in enumerate(signals)]
    return spark.createDataFrame(rows, "experiment_id int, bearing_id int, measurement_index int, timestamp string, "
                                       "vibration_signal array<double>, sample_rate_hz int")


def test_signal_features(spark):
    sigs = [[3, -4, 0], [.1, -.1, .1, -.1], [0.0] * 24 + [0.5], [0.0, 0.0], []]
    f = {r.measurement_index: r for r in SG.bearing_features(_sig(spark, sigs), as_of_col()).collect()}
    assert 4 not in f                                   # empty signal dropped
    a = f[0]
    assert (a.rms_amplitude, a.peak_amplitude, a.crest_factor, a.std_deviation, a.bearing_health_index) == \
        (2.886751, 4.0, 1.3856, 2.867442, 0.0)
    b = f[1]
    assert (b.rms_amplitude, b.peak_amplitude, b.crest_factor, b.std_deviation, b.bearing_health_index) == \
        (0.1, 0.1, 1.0, 0.1, 80.0)
    c = f[2]
    assert (c.rms_amplitude, c.peak_amplitude, c.crest_factor, c.bearing_health_index) == (0.1, 0.5, 5.0, 70.0)
    assert abs(c.std_deviation - 0.09798) < 1e-5
    z = f[3]
    assert (z.rms_amplitude, z.crest_factor, z.bearing_health_index) == (0.0, 0.0, 100.0)
    assert z.kurtosis is None and a.kurtosis == 1.5 and a.sample_count == 3


def test_spectrum_extension(spark):
    import math
    n, rate = 64, 64.0
    s = [math.sin(2 * math.pi * 8 * i / n) for i in range(n)]
    df = _sig(spark, [s]).withColumn("sample_rate_hz", F.lit(64))
    r = SG.bearing_features(df, as_of_col(), with_spectrum=True).collect()[0]
    assert r.dominant_frequency_hz == 8.0
    assert abs(r.spectral_energy - sum(x * x for x in s)) < 1e-6
