"""Aggregates kept between runs equal one run over all rows."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from quarrysight import config as C
from quarrysight.operators import distinct as DI
from quarrysight.operators import failures as FA
from quarrysight.operators import quality as QU
from quarrysight.operators import sketches as SK
from tests.fixtures import as_of_col

FLAGS = {"twf": "Tool Wear Failure", "hdf": "Heat Dissipation Failure"}
LABELS = "b int, air_temperature_k double, process_temperature_k double, rotational_speed_rpm double, torque_nm double, " \
         "tool_wear_min double, twf int, hdf int"


def test_calibration_of_increments_is_that_of_one_run(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.uniform(290, 310), rng.uniform(300, 320), float(rng.randrange(3000)), round(rng.uniform(3, 70), 1),
             float(rng.randrange(250)) if rng.random() < .9 else None, int(rng.random() < .3), rng.choice([0, 1, None])) for _ in range(900)]
    df = spark.createDataFrame(rows, LABELS)
    parts = [SK.calibration_partials(df.where(F.col("b") == k), FLAGS) for k in range(3)]
    parts.append(SK.calibration_partials(df.where("b > 9"), FLAGS))           # an empty batch
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = sorted(map(tuple, SK.calibration_from(both, as_of_col(), FLAGS).collect()))
    want = sorted(map(tuple, FA.failure_calibration(df, as_of_col(), FLAGS).collect()))
    # fewer rows than the sketch keeps: the percentiles are values of the same rank, or its neighbour
    assert [r[:9] for r in got] == [r[:9] for r in want]
    for g, w in zip(got, want):
        for a, b in zip(g[9:12], w[9:12]):
            assert abs(a - b) <= 3.0


def test_rank_error_of_many_batches(spark):
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_000).cast("double").alias("lag"), (F.col("id") % 20).alias("b"))
    parts = None
    for k in range(20):
        p = SK.latency_partials(df.where(F.col("b") == k), F.col("lag"))
        parts = p if parts is None else parts.unionByName(p)
    got = SK.latency_from(parts).first()
    assert (got.avg_lag_sec, got.max_lag_sec, got.min_lag_sec) == (99999.5, 199999.0, 0.0)
    assert abs(got.p95_lag_sec / 200_000 - C.LATENCY_PERCENTILE) < 0.005


def test_latency_of_increments(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t0, t0 + dt.timedelta(seconds=k * k % 977)) for k in range(300)],
                               "bronze_ingestion_timestamp timestamp, silver_processed_timestamp timestamp")
    lag = F.timestamp_diff("SECOND", F.col("bronze_ingestion_timestamp"), F.col("silver_processed_timestamp"))
    parts = SK.latency_partials(df.limit(0), lag).unionByName(SK.latency_partials(df, lag))
    got, want = SK.latency_from(parts).first(), QU.latency_stats(df).first()
    assert tuple(got)[:3] == tuple(map(float, want[:3])) and abs(got.p95_lag_sec - want[3]) <= 10
    assert tuple(SK.latency_from(SK.latency_partials(df.limit(0), lag)).first()) == (None, None, None, None)


def test_distinct_units_of_any_range(spark):
    rng = random.Random(1)
    d0 = dt.date(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=rng.randrange(30)), rng.choice([0, 1, 32767, 32768, 32769, 10 ** 12, -5, -32768, rng.randrange(90000)]))
            for _ in range(800)] + [(None, 3), (d0, None)]
    df = spark.createDataFrame(rows, "d date, u long").repartition(5)
    halves = [DI.daily_bitmaps(df.where(c), F.col("d"), F.col("u")) for c in ("coalesce(u, 0) % 2 = 0", "coalesce(u, 0) % 2 != 0")]
    bitmaps = DI.add_bitmaps(halves[0].unionByName(halves[1]))
    ranges = [(d0 + dt.timedelta(days=a), d0 + dt.timedelta(days=a + n)) for a in range(-3, 30, 4) for n in (0, 3, 40)]
    ranges.append((d0 + dt.timedelta(days=5), d0))
    got = {(r[0], r[1]): r.units for r in DI.distinct_in_ranges(
        bitmaps, spark.createDataFrame(ranges, "first date, last date")).collect()}
    for a, b in ranges:
        assert got[a, b] == len({u for d, u in rows if d is not None and u is not None and a <= d <= b}), (a, b)


def test_numbers_of_text_ids_stay(spark):
    def units(*u):
        return spark.createDataFrame([(x,) for x in u], "unit string")
    first = DI.unit_ids(None, units("b", "a", "a", None))
    again = DI.unit_ids(first, units("c", "a", "0"))
    a, b = ({r.unit: r.id for r in x.collect()} for x in (first, again))
    assert sorted(a.values()) == [0, 1] and {k: b[k] for k in a} == a and sorted(b.values()) == [0, 1, 2, 3]


def test_no_label_is_read_twice(spark, workdir):
    from quarrysight.plans import layers as L
    from tests.test_layers import _landing
    landing = os.path.join(workdir, "landing")
    _landing(landing)
    lay = L.run_all(spark, os.path.join(workdir, "lake"), landing, as_of_col())
    partials = lay.path("gold", "failure_partials")
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(partials) for f in fs if f.endswith(".parquet")}
    with open(os.path.join(landing, "maintenance", "more.csv"), "w") as fh:
        fh.write(",".join(C.LABEL_HEADER_MAP) + "\n")
        for i in range(11, 16):
            fh.write(f"{i},P{i},M,300,{300 + i},1500,{i},{10 * i},1,0,1,0,0,0\n")
    L.run_all(spark, os.path.join(workdir, "lake"), landing, as_of_col())
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(partials) for f in fs if f.endswith(".parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    got = spark.read.parquet(lay.path("gold", "failure_predictions")).drop("calculated_at").collect()
    full = FA.failure_calibration(spark.read.parquet(lay.path("bronze", "raw_maintenance_labels")), as_of_col()).drop("calculated_at").collect()
    assert [tuple(r)[:9] for r in got] == [tuple(r)[:9] for r in full] and got[0].total_records == 15
