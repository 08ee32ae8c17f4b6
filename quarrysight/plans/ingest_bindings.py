"""The ingest and storage operators bound to the benchmark tables: columns of
the tables are landed as JSON lines, CSV and registry files in the shared
folder, and read back through the library's readers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from .. import config as C
from ..operators import clean as CL
from ..sources import files as SF
from ..sources import tables as T
from ..streaming.ingest import ingest_json_stream
from . import bindings as B


def _run(spark, name: str) -> str:
    return os.path.join(B.shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def q_json_ingest(spark, sf_dir):
    """Events as JSON lines; every seventh has an unknown key, every
    eleventh a value of the wrong type, and one line in 500 is no JSON."""
    run = _run(spark, "json")
    e = B.table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 11 == 0, F.lit("bad")).otherwise(F.col("value").cast("string"))
    quoted = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","value":'), quoted, F.when(F.col("event_id") % 7 == 0, F.lit(',"extra":"x"')).otherwise(F.lit("")), F.lit("}"))
    e.select(F.when(F.col("event_id") % 500 == 3, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
             .otherwise(line).alias("value")).write.text(f"{run}/landing")
    schema = StructType([StructField("event_id", LongType()), StructField("event_type", StringType()),
                         StructField("value", DoubleType())])
    for _ in range(2):      # the second run finds nothing new
        ingest_json_stream(spark, f"{run}/landing", f"{run}/table", f"{run}/checkpoint", schema)
    return spark.read.parquet(f"{run}/table").select("event_id", "event_type", "value", "_rescued_data")


def q_csv_ingest(spark, sf_dir):
    """Orders as CSV with decimal commas and foreign headers."""
    run = _run(spark, "csv")
    o = B.table(spark, sf_dir, "orders")
    o.select(F.col("o_orderkey").cast("string").alias("Order Key"),
             F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("Total Price"),
             F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
             ).write.option("header", "true").csv(f"{run}/landing")
    raw = SF.read_csv_strings(spark, f"{run}/landing")
    df = SF.rename_columns(SF.decimal_comma_to_double(raw), {"Order Key": "order_key", "Total Price": "price", "Absent": "x"})
    df = SF.cast_columns(df, {"order_key": "bigint", "date": "date"})
    absent = SF.read_or_empty(spark, f"{run}/nowhere", df.schema, lambda p: SF.read_csv_strings(spark, p))
    out = SF.with_ingest_metadata(df.unionByName(absent), B.as_of(), "landing")
    return out.select("order_key", "price", F.col("date").alias("order_date"), "ingestion_date", "source_file")


def q_registry_csv(spark, sf_dir):
    """Suppliers as a registry file."""
    run = _run(spark, "registry")
    s, n = B.table(spark, sf_dir, "supplier"), B.table(spark, sf_dir, "nation")
    s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.concat(F.lit("S-"), "s_suppkey").alias("equipment_id"), F.lit("supplier").alias("equipment_type"),
        F.col("s_name").alias("model"), F.lit("m").alias("manufacturer"), F.col("n_name").alias("site_location"),
        F.lit("2020-01-31").alias("commissioned_date"), F.col("s_suppkey").cast("double").alias("operating_hours"),
        F.lit("active").alias("status"), (F.col("s_acctbal") / 100).alias("max_engine_temp_c"),
        F.lit(None).cast("double").alias("max_oil_pressure_bar"), F.lit(1.5).alias("max_payload_tonnes"),
    ).write.option("header", "true").csv(f"{run}/registry")
    reg = SF.read_registry_csv(spark, f"{run}/registry", as_of_date=F.to_date(B.as_of()))
    return reg.select("equipment_id", "model", "site_location", "commissioned_date", "operating_hours",
                      F.round("max_engine_temp_c", 4).alias("max_engine_temp_c"), "max_oil_pressure_bar", "last_maintenance_date")


def q_stored_upsert(spark, sf_dir):
    """T1, T2 on storage: closed lines are loaded, then open lines merged in,
    then one year of closed lines again, which must change nothing. The
    partition is an hour (the one a month begins with), whose text needs
    escaping in a folder's name."""
    path = os.path.join(_run(spark, "upsert"), "table")
    f = B.li_flagged(spark, sf_dir).withColumn("reading_hour", F.date_trunc("month", CL.PARSED).cast("timestamp_ntz"))

    def load(status: str, name: str):
        return B._li_dedup(f.filter(F.col("equipment_type") == status)).withColumn("load", F.lit(name))

    keys = ["equipment_id", CL.PARSED]
    T.merge_upsert(spark, path, load("F", "target"), keys, "reading_hour")
    T.merge_upsert(spark, path, load("O", "update"), keys, "reading_hour")
    T.merge_upsert(spark, path, load("F", "again").filter("year(reading_hour) = 1994"), keys, "reading_hour")
    return T.read_partitioned(spark, path, {"reading_hour": TimestampNTZType()}).select(
        "equipment_id", F.col(CL.PARSED).alias("reading_timestamp"), "l_orderkey", "l_linenumber", "quality_score", "load")


def q_contract_split(spark, sf_dir):
    """Defaults, declared types, NOT NULL and ranges; rows by verdict."""
    df = B.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_suppkey")).alias("unit"),
        F.col("l_quantity").cast("string").alias("quantity"), "l_discount",
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("status"))
    c = T.Contract(types={"quantity": "double"}, not_null=("unit",), ranges={"l_discount": (0.01, 0.09)},
                   defaults={"status": "returned"})
    good, bad = T.enforce_contract(df, c)
    both = good.withColumn("verdict", F.lit("good")).unionByName(bad.withColumn("verdict", F.lit("bad")))
    return both.groupBy("verdict", "status").agg(F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity"))


def q_sensor_rules(spark, sf_dir):
    """The fleet's own range rules on lineitem columns under the fleet's
    names, with values past either end and NULLs."""
    base = B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 10 - 60).alias("engine_temp_c"),
        (F.nullif(F.col("l_quantity"), F.lit(3.0)) * 12 - 20).alias("hydraulic_pressure_bar"),
        (F.col("l_quantity") * 4 - 40).alias("hydraulic_oil_temp_c"))
    named = {r.column for r in C.SENSOR_RULES} & set(base.columns)
    rules = tuple(r for r in C.SENSOR_RULES if r.column in named)
    return CL.flag_quality(base, rules).select(
        "l_orderkey", "l_linenumber", F.array_join("anomaly_reasons", "|").alias("reasons"), "is_anomaly", "quality_score")


QUERIES = {
    "json_ingest": q_json_ingest,
    "csv_ingest": q_csv_ingest,
    "registry_csv": q_registry_csv,
    "stored_upsert": q_stored_upsert,
    "contract_split": q_contract_split,
    "sensor_rules": q_sensor_rules,
}

ORACLE = {
    "json_ingest": """
SELECT CASE WHEN j THEN event_id END AS event_id, CASE WHEN j THEN event_type END AS event_type,
       CASE WHEN j AND event_id % 11 <> 0 THEN value END AS value,
       CASE WHEN NOT j THEN 'not json ' || event_id
            WHEN event_id % 77 = 0 THEN '{"value":"bad","extra":"x"}'
            WHEN event_id % 11 = 0 THEN '{"value":"bad"}'
            WHEN event_id % 7 = 0 THEN '{"extra":"x"}' END AS _rescued_data
FROM (SELECT *, event_id % 500 <> 3 AS j FROM events)""",
    "csv_ingest": """
SELECT o_orderkey AS order_key, o_totalprice AS price, CAST(o_orderdate AS DATE) AS order_date,
       DATE '2024-02-01' AS ingestion_date, 'landing' AS source_file FROM orders""",
    "registry_csv": """
SELECT 'S-' || s_suppkey AS equipment_id, s_name AS model, n_name AS site_location, DATE '2020-01-31' AS commissioned_date,
       CAST(s_suppkey AS DOUBLE) AS operating_hours, round(s_acctbal / 100, 4) AS max_engine_temp_c,
       CAST(NULL AS DOUBLE) AS max_oil_pressure_bar, DATE '2024-01-02' AS last_maintenance_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "contract_split": """
SELECT CASE WHEN l_linenumber = 7 OR l_discount < 0.01 OR l_discount > 0.09 THEN 'bad' ELSE 'good' END AS verdict,
       CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE l_returnflag END AS status,
       count(*) AS n_rows, sum(CAST(l_quantity AS DOUBLE)) AS quantity
FROM lineitem GROUP BY 1, 2""",
    # fixed values: engine -40..150, hydraulic pressure 0..420, hydraulic oil -20..120
    "sensor_rules": """
WITH v AS (
  SELECT l_orderkey, l_linenumber, l_quantity * 10 - 60 AS e, nullif(l_quantity, 3.0) * 12 - 20 AS p, l_quantity * 4 - 40 AS o
  FROM lineitem
), f AS (
  SELECT l_orderkey, l_linenumber, coalesce(e < -40 OR e > 150, FALSE) AS fe, coalesce(p < 0 OR p > 420, FALSE) AS fp,
         coalesce(o < -20 OR o > 120, FALSE) AS fo
  FROM v
)
SELECT l_orderkey, l_linenumber,
       concat_ws('|', CASE WHEN fe THEN 'engine_temp_c_out_of_range' END, CASE WHEN fp THEN 'hydraulic_pressure_bar_out_of_range' END,
                 CASE WHEN fo THEN 'hydraulic_oil_temp_c_out_of_range' END) AS reasons,
       fe OR fp OR fo AS is_anomaly,
       CASE CAST(fe AS INT) + CAST(fp AS INT) + CAST(fo AS INT) WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.4 ELSE 0.1 END AS quality_score
FROM f""",
}
