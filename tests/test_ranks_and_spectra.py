"""Gapless ranks by ranges, batched spectra, file statistics."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from quarrysight.operators import quality as QU
from quarrysight.operators import signals as SG
from quarrysight.operators.ranks import gapless_rank
from quarrysight.sources import files as SF
from tests.fixtures import as_of_col


def test_ranks_are_gapless_whatever_the_partitions(spark):
    rows = [(g, f"n{(i * 37) % 101:03d}", i) for g in ("a", "b", None) for i in range(101 if g != "b" else 7)]
    df = spark.createDataFrame(rows, "g string, name string, x int").repartition(6)
    got = {}
    for r in gapless_rank(df, ["g"], ["name"], "rank").collect():
        got.setdefault(r.g, []).append((r.rank, r.name))
    assert {g: [n for _, n in sorted(v)] for g, v in got.items()} == {
        g: sorted(n for h, n, _ in rows if h == g) for g in ("a", "b", None)}
    assert all(sorted(k for k, _ in v) == list(range(len(v))) for v in got.values())
    assert gapless_rank(df.where("x < 0"), ["g"], ["name"]).collect() == []


def test_no_window_holds_a_group(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("string").alias("name"))
    plan = gapless_rank(df, ["g"], ["name"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "_part" in window.split("\n")[0] and "Aggregate" in window       # over one row per partition and group


def test_spectra_of_mixed_lengths(spark):
    rng = np.random.default_rng(0)
    signals = [rng.normal(size=n).tolist() for n in (1, 2, 3, 8, 9, 64, 65, 64, 8)]
    signals += [[1.0] * 16, np.sin(np.arange(50) * 2 * np.pi * 7 / 50).tolist(), [], None, [1.0, None, 2.0]]
    df = spark.createDataFrame([(i, s, 100.0) for i, s in enumerate(signals)], "i int, s array<double>, r double").repartition(3)
    got = {r.i: r for r in df.select("i", SG.dominant_frequency("s", "r").alias("f"),
                                     SG.G.signal_energy("s").alias("e")).collect()}
    for i, s in enumerate(signals[:11]):
        x = np.array(s)
        bins = [abs(sum((x - x.mean()) * np.exp(-2j * np.pi * k * np.arange(len(x)) / len(x)))) for k in range(1, len(x) // 2 + 1)]
        want = (int(np.argmax(bins)) + 1) * 100.0 / len(x) if bins and max(bins) > 1e-9 else 0.0
        assert abs(got[i].f - want) < 1e-9 or (len(set(s)) == 1 and got[i].f == 0.0), (i, got[i].f, want)
        assert abs(got[i].e - float((np.abs(np.fft.fft(x)) ** 2).sum() / len(x))) < 1e-9 * max(1, len(x))
    assert got[10].f == 14.0 and got[11].f is None and got[12].f is None and got[13].f is None


def test_table_stats_open_no_file(spark, workdir):
    path = os.path.join(workdir, "t")
    spark.range(100).repartition(3).write.parquet(path)
    got = QU.table_stats(spark, {"t": path}).first()
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    assert got.num_files == len(files) == 3
    assert got.size_mb == round(sum(map(os.path.getsize, files)) / 1048576, 2)
    assert abs(got.last_modified - dt.datetime.fromtimestamp(max(map(os.path.getmtime, files)), dt.timezone.utc).replace(tzinfo=None)
               ) < dt.timedelta(seconds=1)
    plan = QU.table_stats(spark, {"t": path})._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_vibration_files_of_several_experiments(spark, workdir):
    files = spark.createDataFrame([(f"{e}/f{k:02d}", f"{k}\t1\t2\t3\nbad\t1\t2\t3") for e in ("1st_test", "2nd_test", "other")
                                   for k in (5, 1, 3)], "path string, text string")
    assert SF.write_text_files(files, workdir) == 9
    got = SF.read_vibration_files(spark, workdir, as_of_col())
    rows = {(r.experiment_id, r.timestamp): r.measurement_index for r in got.collect()}
    assert rows == {(e, f"f{k:02d}"): i for e in (1, 2) for i, k in enumerate((1, 3, 5))}
    assert {tuple(r[0]) for r in got.where("bearing_id = 1 and measurement_index = 2").select("vibration_signal").collect()} == {(5.0,)}
