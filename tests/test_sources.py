"""Readers, rescued data, upsert, contracts, streaming ingest."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarrysight import schemas
from quarrysight.sources import files as SF
from quarrysight.sources import tables as T
from quarrysight.sources.rescue import rescue_json
from quarrysight.streaming.ingest import ingest_json_stream


def test_decimal_comma(spark):
    df = spark.createDataFrame([("d", "1,5", "1.234,5", None)], "date string, a string, b string, c string")
    r = SF.decimal_comma_to_double(df).collect()[0]
    assert (r.date, r.a, r.b, r.c) == ("d", 1.5, None, None)


def test_rename_and_cast(spark):
    df = spark.createDataFrame([("1", "x", "7")], "UDI string, Other string, TWF string")
    out = SF.cast_columns(SF.rename_columns(df, {"UDI": "uid", "TWF": "twf", "Missing": "m"}), {"twf": "int"})
    assert out.columns == ["uid", "Other", "twf"] and out.collect()[0].twf == 7
    bad = SF.cast_columns(spark.createDataFrame([("zz",)], "twf string"), {"twf": "int"}).collect()[0]
    assert bad.twf is None


def test_rescue_json(spark):
    schema = StructType([StructField("a", StringType()), StructField("x", DoubleType())])
    lines = spark.createDataFrame([('{"a": "1", "x": 2.5}',), ('{"a": "1", "x": "bad", "extra": 3}',),
                                   ("not json",), ('{"a": null}',)], "value string")
    got = rescue_json(lines.withColumn("line", F.col("value")), schema).collect()
    out = {r.line: r for r in got}
    assert out['{"a": "1", "x": 2.5}']._rescued_data is None
    assert json.loads(out['{"a": "1", "x": "bad", "extra": 3}']._rescued_data) == {"x": "bad", "extra": "3"}
    assert out['{"a": "1", "x": "bad", "extra": 3}'].a == "1"
    assert out["not json"]._rescued_data == "not json" and out["not json"].a is None
    assert out['{"a": null}']._rescued_data is None


def test_read_or_empty(spark, workdir):
    df = SF.read_or_empty(spark, os.path.join(workdir, "missing"), schemas.RAW_LABELS, spark.read.parquet)
    assert df.count() == 0 and df.schema == schemas.RAW_LABELS


def _tbl(spark, rows):
    return spark.createDataFrame(rows, "k string, ts int, quality_score double, v string")


def test_upsert_semantics(spark):
    target = _tbl(spark, [("a", 1, 0.7, "old"), ("b", 1, 1.0, "old")])
    updates = _tbl(spark, [("a", 1, 1.0, "new"), ("b", 1, 1.0, "new"), ("c", 1, 0.4, "new")])
    out = {r.k: r.v for r in T.upsert_rows(target, updates, ["k", "ts"]).collect()}
    assert out == {"a": "new", "b": "old", "c": "new"}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 2), st.sampled_from([0.1, 0.4, 0.7, 1.0])),
                min_size=1, max_size=12))
def test_upsert_idempotent_and_never_lowers_quality(spark, rows):
    uniq = {}
    for k, ts, q in rows:
        uniq[(k, ts)] = q
    target = _tbl(spark, [(k, ts, q, "t") for (k, ts), q in uniq.items()])
    updates = _tbl(spark, [(k, ts, 1.0 - q + 0.1, "u") for (k, ts), q in uniq.items()])
    once = T.upsert_rows(target, updates, ["k", "ts"])
    twice = T.upsert_rows(once, updates, ["k", "ts"])
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    for k, ts, q, _ in a:
        assert q >= uniq[(k, ts)]


def test_merge_upsert_on_storage(spark, workdir):
    path = os.path.join(workdir, "t")
    rows = lambda v, q: spark.createDataFrame([("a", 1, q, v, "2024-01-01")],
                                              "k string, ts int, quality_score double, v string, d string")
    T.merge_upsert(spark, path, rows("first", 0.7), ["k", "ts"], "d")
    T.merge_upsert(spark, path, rows("better", 1.0), ["k", "ts"], "d")
    T.merge_upsert(spark, path, rows("equal", 1.0), ["k", "ts"], "d")
    got = spark.read.parquet(path).collect()
    assert len(got) == 1 and got[0].v == "better"


def test_contract_split_and_strict(spark):
    df = spark.createDataFrame([("a", 0.5, 3), (None, 0.5, 4), ("b", 1.5, 5)], "id string, q double, n long")
    c = T.Contract(types={"n": "int"}, not_null=("id",), ranges={"q": (0.0, 1.0)})
    good, bad = T.enforce_contract(df, c)
    assert [r.id for r in good.collect()] == ["a"] and bad.count() == 2
    assert good.schema["n"].dataType.simpleString() == "int"
    with pytest.raises(Exception):
        T.assert_contract(df, c).collect()


def test_stream_ingest_is_incremental(spark, workdir):
    landing, table, ckpt = (os.path.join(workdir, x) for x in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    line = lambda i: json.dumps({"equipment_id": f"U{i}", "equipment_type": "conveyor",
                                 "timestamp": "2024-09-01T06:00:00", "belt_speed_mps": 1.0 * i})
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write("\n".join(line(i) for i in range(3)) + "\n")
    ingest_json_stream(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == 3
    ingest_json_stream(spark, landing, table, ckpt)          # restart: nothing new
    assert spark.read.parquet(table).count() == 3
    with open(os.path.join(landing, "b.json"), "w") as fh:
        fh.write(line(7) + "\n")
    ingest_json_stream(spark, landing, table, ckpt)
    t = spark.read.parquet(table)
    assert t.count() == 4
    assert t.filter(F.col("source_file").endswith("b.json")).collect()[0].belt_speed_mps == 7.0
    batch = rescue_json(spark.read.text(landing), schemas.SENSOR_JSON).select("equipment_id", "belt_speed_mps")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, t.select("equipment_id", "belt_speed_mps").collect()))


def test_cluster_conf_sizes_partitions():
    from quarrysight.session import cluster_conf
    c = cluster_conf(100 << 40, 8000)          # 100 TB on 8,000 cores
    assert int(c["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(c["spark.sql.shuffle.partitions"]) * (128 << 20) >= 100 << 40
    assert cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "8"


def test_upsert_accepts_a_new_column(spark):
    target = _tbl(spark, [("a", 1, 0.7, "old")])
    updates = _tbl(spark, [("a", 1, 1.0, "new"), ("b", 1, 0.4, "new")]).withColumn("extra", F.lit(5))
    out = {r.k: (r.v, r.extra) for r in T.upsert_rows(target, updates, ["k", "ts"]).collect()}
    assert out == {"a": ("new", 5), "b": ("new", 5)}
    kept = {r.k: r.extra for r in T.upsert_rows(updates, target, ["k", "ts"]).collect()}
    assert kept == {"a": 5, "b": 5}


def test_table_stats_counts_files_and_bytes(spark, workdir):
    from quarrysight.operators.quality import table_stats
    path = os.path.join(workdir, "stats")
    spark.range(1000).repartition(3).write.parquet(path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    size_mb = round(sum(os.path.getsize(os.path.join(path, f)) for f in files) / (1024 * 1024), 2)
    r = table_stats(spark, {"t": path}).collect()[0]
    assert (r.table_name, r.num_files, r.size_mb) == ("t", len(files), size_mb)
    assert r.last_modified is not None
