"""Moments that merge without losing digits, and z-scores from them."""

import datetime as dt
import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarrysight.functions import moments as M
from quarrysight.operators import anomalies as AN
from tests.fixtures import as_of_col


def exact(values):
    xs = [Fraction(str(v)) for v in values]
    m = sum(xs) / len(xs)
    var = sum((x - m) ** 2 for x in xs) / (len(xs) - 1)
    return m, var


@pytest.mark.parametrize("base,spread", [(1e9, 1.0), (-1e9, 0.001), (0.0, 0.01), (1e6, 250.0), (12345.678, 0.000002)])
def test_merged_groups_are_exact_and_order_free(spark, base, spread):
    rng = random.Random(4)
    rows = [(k % 7, round(base + rng.uniform(-spread, spread), 6)) for k in range(210)]
    m, var = exact([x for _, x in rows])
    seen = set()
    for parts in (1, 5, 13):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
        got = (df.groupBy("g").agg(*M.moment_sums(F.col("x"))).select("g", M.moments().alias("m"))
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("g", "m"))), lambda s: s["m"]).alias("ms"))
               .select(M.merged(F.col("ms")).alias("b"))
               .select(M.mean(F.col("b")).alias("mean"), M.std(F.col("b")).alias("std"),
                       M.distance(F.lit(rows[0][1] * 0 + base + spread), F.col("b")).alias("d")).first())
        seen.add(tuple(got))
        assert math.isclose(got.mean, float(m), rel_tol=1e-15, abs_tol=1e-12)
        assert math.isclose(got.std, math.sqrt(var), rel_tol=1e-12)
        assert math.isclose(got.d, float(Fraction(str(round(base + spread, 6))) - m), rel_tol=1e-9, abs_tol=1e-9)
    assert len(seen) == 1


@pytest.mark.parametrize("values", [(1.0, math.nan), (1e300, 1e300), (math.inf, 1.0), (1e-9, 3e-9, 2e-9), (5e17, -5e17, 4e17)])
def test_other_values_fall_back_to_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(*M.moment_sums(F.col("x"))).select(M.moments().alias("m")).select(
        M.mean(F.col("m")).alias("mean"), M.std(F.col("m")).alias("std")).first()
    plain = df.agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std")).first()
    for a, b in zip(got, plain):
        assert (a is None) == (b is None) or not math.isfinite(b)
        assert a is None or not math.isfinite(a) or math.isclose(a, b, rel_tol=1e-9)


def test_no_readings(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(*M.moment_sums(F.col("x"))).select(M.moments().alias("m")).first().m is None
    assert spark.range(1).select(M.merged(F.array().cast(f"array<{M.TYPE}>")).alias("m")).first().m is None


def test_zscores_of_large_readings(spark):
    rng = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("U", "t", t0 + dt.timedelta(minutes=10 * k), 1e9 + rng.choice([-1.0, 1.0])) for k in range(180)]
    rows.append(("U", "t", t0 + dt.timedelta(hours=30, minutes=5), 1e9 + 40.0))
    seen = []
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "equipment_id string, equipment_type string, reading_timestamp timestamp, v double").repartition(parts)
        seen.append([(r.event_timestamp, r.z_score, r.threshold_value) for r in
                     AN.zscore_anomalies(df, "v", as_of_col(), baseline_hours=24, z_threshold=5.0).collect()])
    assert seen[0] == seen[1] and len(seen[0]) == 1
    before = [x for _, _, t, x in rows if t0 + dt.timedelta(hours=6) <= t < t0 + dt.timedelta(hours=30)]
    want = (rows[-1][3] - statistics.mean(before)) / statistics.stdev(before)
    assert math.isclose(seen[0][0][1], want, rel_tol=1e-9)
