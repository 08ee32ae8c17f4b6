"""Keyed upserts into partitions of any value, and interrupted swaps."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarrysight.sources import tables as T


def rows(spark, kind, *r):
    return spark.createDataFrame(list(r), f"k long, p {kind}, quality_score double, v string")


def stored(spark, path, kind):
    return sorted((tuple(r) for r in T.read_partitioned(spark, path, {"p": kind}).select("k", "p", "quality_score", "v").collect()),
                  key=str)


STAMP = dt.datetime(2024, 3, 10, 10, 30, 15, 250000)


@pytest.mark.parametrize("kind,value,other", [
    ("string", "10:00", "11:00"), ("string", "007", "7"), ("string", "a/b", "a%2Fb"), ("string", "a=b c\n{}#?*'\"\\", "x"),
    ("string", "__HIVE_DEFAULT_PARTITION", "null"), ("string", "2024-01-01", "1e3"), ("timestamp_ntz", STAMP, STAMP.replace(hour=11)),
    ("timestamp", STAMP, STAMP.replace(minute=0)), ("date", dt.date(1, 1, 1), dt.date(9999, 12, 31)), ("boolean", True, False),
    ("int", -7, 0), ("string", "ü 日本", "u"),
])
def test_two_loads_into_one_partition(spark, workdir, kind, value, other):
    path = os.path.join(workdir, "t")
    T.merge_upsert(spark, path, rows(spark, kind, (1, value, 0.5, "old"), (2, value, 0.5, "old"), (9, other, 0.5, "old")), ["k"], "p")
    T.merge_upsert(spark, path, rows(spark, kind, (2, value, 0.9, "new"), (1, value, 0.1, "new"), (3, value, 0.5, "new")), ["k"], "p")
    of = rows(spark, kind).schema["p"].dataType
    want = [(1, value, 0.5, "old"), (2, value, 0.9, "new"), (3, value, 0.5, "new"), (9, other, 0.5, "old")]
    assert stored(spark, path, of) == sorted(want, key=str)
    assert os.listdir(path + T.STAGING) == []


def test_null_and_empty_texts_are_one_partition(spark, workdir):
    path = os.path.join(workdir, "t")
    T.merge_upsert(spark, path, rows(spark, "string", (1, "", 0.5, "old"), (2, None, 0.5, "old"), (3, "x", 0.5, "old")), ["k"], "p")
    T.merge_upsert(spark, path, rows(spark, "string", (2, "", 0.9, "new"), (4, None, 0.5, "new")), ["k"], "p")
    T.merge_upsert(spark, path, rows(spark, "string", (5, None, 0.9, "new")), ["k"], "p")
    got = stored(spark, path, StringType())
    assert [(r[0], r[1], r[3]) for r in sorted(got)] == [(1, None, "old"), (2, None, "new"), (3, "x", "old"), (4, None, "new"), (5, None, "new")]


def test_a_column_added_upstream(spark, workdir):
    path = os.path.join(workdir, "t")
    first = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.5)], "k long, p string, quality_score double")
    T.merge_upsert(spark, path, first, ["k"], "p")
    T.merge_upsert(spark, path, rows(spark, "string", (3, "a", 0.5, "new")), ["k"], "p")
    T.merge_upsert(spark, path, first.where("k = 1"), ["k"], "p")
    got = stored(spark, path, StringType())
    assert got == [(1, "a", 0.5, None), (2, "b", 0.5, None), (3, "a", 0.5, "new")]


@pytest.mark.parametrize("at", range(7))
def test_an_interrupted_swap_loses_nothing(spark, workdir, monkeypatch, at):
    """A failure at any rename, or before the first: the next writer finishes the swap."""
    path = os.path.join(workdir, "t")
    T.merge_upsert(spark, path, rows(spark, "string", *[(i, f"p{i % 3}", 0.5, "old") for i in range(9)]), ["k"], "p")
    plain, calls = T._rename, []

    def breaks(*args):
        calls.append(args)
        if len(calls) == at + 1:
            raise OSError("lost")
        plain(*args)

    monkeypatch.setattr(T, "_rename", breaks)
    change = rows(spark, "string", *[(i, f"p{i % 3}", 0.9, "new") for i in (0, 1, 2)])
    try:
        T.merge_upsert(spark, path, change, ["k"], "p")
        assert at >= 6                       # two renames for each of three partitions
    except OSError:
        assert at < 6
    monkeypatch.setattr(T, "_rename", plain)
    T.merge_upsert(spark, path, rows(spark, "string", (20, "p9", 0.5, "later")), ["k"], "p")
    got = {r[0]: r[3] for r in stored(spark, path, StringType())}
    assert got == {**{i: "new" if i < 3 else "old" for i in range(9)}, 20: "later"}
    assert os.listdir(path + T.STAGING) == []


def test_an_unfinished_write_is_no_part_of_the_table(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "t")
    T.merge_upsert(spark, path, rows(spark, "string", (1, "a", 0.5, "old")), ["k"], "p")
    monkeypatch.setattr(T, "_swap", lambda *a: (_ for _ in ()).throw(AssertionError))
    broken = rows(spark, "string", (1, "a", 0.9, "new")).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        T.replace_partitions(spark, broken, path, ("p",))
    monkeypatch.undo()
    assert T.finish_swaps(spark, path) == 0
    assert [r[3] for r in stored(spark, path, StringType())] == ["old"]


def test_days_without_rows_go(spark, workdir):
    path = os.path.join(workdir, "t")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    T.replace_days(spark, rows(spark, "date", *[(i, d, 1.0, "a") for i, d in enumerate(days)]), path, "p", days)
    T.replace_days(spark, rows(spark, "date", (7, days[0], 1.0, "b")), path, "p", days[:2])
    assert [(r.k, r.v) for r in spark.read.parquet(path).orderBy("k").collect()] == [(2, "a"), (7, "b")]
    T.replace_days(spark, rows(spark, "date"), path, "p", days)
    assert T._leaves(spark, path) == []
    T.merge_upsert(spark, path, rows(spark, "date", (1, days[0], 1.0, "c")), ["k"], "p")
    assert spark.read.parquet(path).count() == 1


def test_partitions_of_two_columns(spark, workdir):
    path = os.path.join(workdir, "t")
    df = spark.createDataFrame([(1, "a:b", 1), (2, "a:b", 2), (3, "c", 1)], "k long, p string, q int")
    T.replace_partitions(spark, df, path, ("p", "q"))
    T.replace_partitions(spark, df.where("k = 2").withColumn("k", F.lit(5).cast("long")), path, ("p", "q"))
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 3, 5]
