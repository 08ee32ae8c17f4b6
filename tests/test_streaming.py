"""Streaming: hourly windows under a watermark, de-duplication inside it."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quarrysight.streaming.ingest import stream_parquet_once
from quarrysight.streaming.windows import hourly_window_kpis


def test_window_kpis_emit_closed_windows_and_dedup(spark, workdir):
    src = os.path.join(workdir, "src")
    base = dt.datetime(2024, 1, 1, 0, 0)
    rows = []
    for h in range(6):
        for m in (5, 35):
            rows.append((base + dt.timedelta(hours=h, minutes=m), 1, "click", float(h)))
    rows.append((base + dt.timedelta(hours=0, minutes=5), 1, "click", 0.0))   # repeated message
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user_id long, event_type string, value double")
    df.write.parquet(src)

    out = os.path.join(workdir, "out")
    stream_parquet_once(
        spark, src, df.schema, out, os.path.join(workdir, "ckpt"),
        lambda s: hourly_window_kpis(s, "ts", "user_id", "value", "event_type", ("click",), "2 hours",
                                     dedup_keys=("user_id", "ts")))
    got = spark.read.parquet(out).orderBy("window_start").collect()
    # watermark = 05:35 - 2h = 03:35 -> windows ending at or before it are final
    assert [r.total_readings for r in got] == [2, 2, 2]
    assert [r.avg_value for r in got] == [0.0, 1.0, 2.0]
    assert all(r.utilization_pct == 100.0 for r in got)


def test_stream_silver_drops_copies_and_hard_breaches(spark, workdir):
    from quarrysight import schemas
    from quarrysight.streaming.windows import stream_silver
    from tests.fixtures import bronze_df, sensor_cases

    src = os.path.join(workdir, "bronze")
    bronze_df(spark, sensor_cases()).write.parquet(src)
    out = os.path.join(workdir, "silver")
    stream_parquet_once(spark, src, schemas.RAW_SENSOR_READINGS, out, os.path.join(workdir, "ckpt2"),
                        lambda s: stream_silver(s))
    got = spark.read.parquet(out)
    # 28 messages: 4 quarantined (2 bad timestamps, 151 C, NaN), 2 copies of 06:00 dropped
    assert got.count() == 22
    assert got.groupBy("equipment_id", "parsed_ts").count().filter("count > 1").count() == 0
    assert {r.quality_score for r in got.filter(F.col("equipment_id") == "HT-001").collect()} == {1.0, 0.7, 0.4, 0.1}


def test_stream_tables_do_not_depend_on_batches(spark, workdir):
    from quarrysight.plans import bindings as B
    sf = "/root/testdata/sf0.001"
    for name, query in (("lineitem", B.q_stream_silver), ("events", B.q_stream_hourly_window)):
        folder = os.path.join(workdir, name)
        # two files in an order of their own, so that each holds late rows
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(2).write.parquet(os.path.join(folder, name + ".parquet"))
        parts = os.path.join(folder, name + ".parquet")
        one = sorted(map(str, query(spark, sf).collect()))
        table = B.table
        try:
            B.table = lambda s, d, n: table(s, sf, name)
            many = sorted(map(str, query(spark, parts, files_per_trigger=1, glob="*.parquet").collect()))
        finally:
            B.table = table
        assert many == one
        if name == "events":
            total = query(spark, sf).agg(F.sum("total_readings")).first()[0]
            assert total == spark.read.parquet(f"{sf}/events.parquet").count()


STATE = "k string, q double, tie long, day string, seen timestamp"


def _best(df):
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy(F.col("q").desc(), F.col("tie"))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def test_keyed_state_gives_the_batch_table(spark, workdir):
    """One and several files a trigger, a restart, and copies that come after the state
    has let their key go."""
    import random

    from quarrysight.streaming import state as SS
    from quarrysight.streaming import tables as ST
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    files = [[(f"k{rng.randrange(40)}", rng.choice([0.1, 0.4, 0.7, 1.0]), rng.randrange(1000), f"d{rng.randrange(3)}",
               t0 + dt.timedelta(days=4 * f)) for _ in range(60)] for f in range(4)]
    src, order = os.path.join(workdir, "src"), [-F.col("q"), F.col("tie")]
    whole = _best(spark.createDataFrame([r for rows in files for r in rows], STATE))
    want = sorted(tuple(r)[:4] for r in whole.collect())

    def run(name, per_trigger):
        stream = ST.read_files(spark, src, whole.schema, files_per_trigger=per_trigger)
        SS.write_best_copies(spark, stream, os.path.join(workdir, name, "log"), ["k"], order,
                             os.path.join(workdir, name, "checkpoint"), keep="7 days", seen=F.col("seen"))

    for k, rows in enumerate(files):
        spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(src)
        if k in (1, 3):          # the second run takes up the first one's state
            run("resumed", 1)
    run("whole", None)
    for name in ("resumed", "whole"):
        log = spark.read.parquet(os.path.join(workdir, name, "log"))
        assert sorted(tuple(r)[:4] for r in SS.best_rows(log, _best).select("k", "q", "tie", "day").collect()) == want
        assert log.count() <= 240
    # one batch writes each key at most once for each period
    log = spark.read.parquet(os.path.join(workdir, "whole", "log"))
    assert log.groupBy("k").count().where("count > 3").isEmpty()
    SS.compact(spark, os.path.join(workdir, "resumed", "log"), os.path.join(workdir, "table"), _best, "day")
    got = _best(spark.read.parquet(os.path.join(workdir, "table")).select("k", "q", "tie", "day", "seen"))
    assert sorted(tuple(r)[:4] for r in got.collect()) == want


def test_the_state_lets_keys_go(spark, workdir):
    from quarrysight.streaming import state as SS
    from quarrysight.streaming import tables as ST
    src = os.path.join(workdir, "src")
    t0 = dt.datetime(2024, 1, 1)
    rows = [[(f"k{f}-{i}", 1.0, 0, "d", t0 + dt.timedelta(days=20 * f)) for i in range(30)] for f in range(4)]
    for r in rows:
        spark.createDataFrame(r, STATE).coalesce(1).write.mode("append").parquet(src)
    spark.conf.set(SS.PROVIDER, SS.ROCKSDB)
    try:
        stream = ST.read_files(spark, src, spark.createDataFrame([], STATE).schema, files_per_trigger=1)
        q = (SS.best_copies(stream, ["k"], [-F.col("q")], "7 days", F.col("seen")).writeStream.outputMode("update")
             .format("noop").option("checkpointLocation", os.path.join(workdir, "c")).trigger(availableNow=True).start())
        q.awaitTermination()
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    finally:
        spark.conf.unset(SS.PROVIDER)
    assert max(kept) <= 60 and kept[-1] <= 30        # of 120 keys
