"""The layered run on a base folder: landed files -> bronze -> silver -> gold.

Folder layout under ``base``::

    bronze/raw_sensor_readings        (append, partitioned by ingestion_date)
    bronze/raw_flotation_readings     bronze/raw_maintenance_labels
    bronze/raw_bearing_vibration
    silver/equipment_registry         silver/cleaned_sensor_readings (upsert by reading_date)
    silver/quarantine_records         silver/anomaly_events
    silver/cleaned_flotation_readings silver/bearing_features
    gold/hourly_equipment_kpis        gold/equipment_health_scores
    gold/maintenance_alerts           gold/fleet_summary_daily
    gold/flotation_quality_scores     gold/failure_predictions

Each stage reads the previous layer's files, so stages can run as separate
jobs and a failed stage is rerun from durable input. The run is incremental
and idempotent: bronze sensor ingest is checkpointed (a file is ingested
once); silver takes only bronze rows past the last run's ingestion
high-water mark and upserts them by key; quarantine rows are appended only
when new; events and the sensor gold tables are recomputed for the days the
batch touched, and for the days on which a unit's health trend now compares
with another row (its next stored day); all other day partitions stay as they
are. Partitions are written beside the table and then swapped in
(``sources/tables.replace_partitions``), so a crash loses nothing. The high-water
mark is advanced after gold, so a failed run is rerun as a whole. ``base`` should
be on shared storage (the cluster's checkpoint folder or a table location).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..operators import alerts as AL
from ..operators import anomalies as AN
from ..operators import clean as CL
from ..operators import enrich as EN
from ..operators import fleet as FL
from ..operators import health as HE
from ..operators import kpis as KP
from ..operators import process as PR
from ..operators import signals as SG
from ..operators import sketches as SK
from ..sources import files as SF
from ..sources import tables as T
from ..streaming.ingest import ingest_csv_stream, ingest_json_stream


@dataclass(frozen=True)
class Layout:
    base: str
    metrics: dict = field(default_factory=dict, compare=False)

    def path(self, layer: str, table: str) -> str:
        return os.path.join(self.base, layer, table)

    @property
    def checkpoints(self) -> str:
        return os.path.join(self.base, "_checkpoints")


def _exists(spark: SparkSession, path: str) -> bool:
    return SF.path_exists(spark, path)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return SF.read_or_empty(spark, path, schema, spark.read.parquet)


# ------------------------------------------------------------------ bronze

def bronze(spark: SparkSession, lay: Layout, landing: str, as_of: Column) -> None:
    """Ingest whatever is landed: sensor JSON, flotation and label CSVs as
    incremental file streams (each file once), vibration files and the
    registry as batch reads; a missing folder skips its branch."""
    sensors = os.path.join(landing, "sensors")
    if _exists(spark, sensors):
        ingest_json_stream(spark, sensors, lay.path("bronze", "raw_sensor_readings"),
                           os.path.join(lay.checkpoints, "bronze_sensors"))
    flot = os.path.join(landing, "flotation")
    if _exists(spark, flot):
        ingest_csv_stream(spark, flot, lay.path("bronze", "raw_flotation_readings"),
                          os.path.join(lay.checkpoints, "bronze_flotation"),
                          ["date", *C.FLOTATION_HEADER_MAP], lambda df, src, ts: SF.flotation_bronze(df, src, ts))
    labels = os.path.join(landing, "maintenance")
    if _exists(spark, labels):
        ingest_csv_stream(spark, labels, lay.path("bronze", "raw_maintenance_labels"),
                          os.path.join(lay.checkpoints, "bronze_labels"),
                          list(C.LABEL_HEADER_MAP), lambda df, src, ts: SF.label_bronze(df, src, ts))
    bearing = os.path.join(landing, "bearing")
    if _exists(spark, bearing):
        # the files are read whole each time, so the whole table is replaced
        T.write_table(SF.read_vibration_files(spark, bearing, as_of), lay.path("bronze", "raw_bearing_vibration"))
    registry = os.path.join(landing, "registry")
    if _exists(spark, registry):
        reg = SF.read_registry_csv(spark, registry, as_of_date=F.to_date(as_of))
        T.write_table(reg.select(*schemas.EQUIPMENT_REGISTRY.fieldNames()), lay.path("silver", "equipment_registry"))


# ------------------------------------------------------------------ silver

SILVER_CONTRACT = T.Contract(not_null=schemas.SILVER_NOT_NULL, ranges={"quality_score": (0.0, 1.0)})


def _state(spark: SparkSession, lay: Layout, name: str = "silver"):
    """Bronze ingestion high-water mark of the last completed run (or None)."""
    path = lay.path("_state", name)
    if not _exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max("hwm")).first()[0]


def silver(spark: SparkSession, lay: Layout, as_of: Column) -> dict:
    """Process the bronze rows ingested after the last run's high-water mark.

    Returns the stage counts - gathered while the tables are written
    (``DataFrame.observe``), not by extra count jobs - plus ``days``, the
    reading dates the batch touched, and ``hwm``, the batch's ingestion
    high-water mark.
    """
    raw = _read(spark, lay.path("bronze", "raw_sensor_readings"), schemas.RAW_SENSOR_READINGS)
    hwm = _state(spark, lay)
    if hwm is not None:
        # ingestion_date is the bronze partition column: prunes old folders
        raw = raw.filter((F.col("ingestion_date") >= F.to_date(F.lit(hwm)))
                         & (F.col("ingestion_timestamp") > F.lit(hwm)))
    b_obs = Observation("batch")
    raw = raw.observe(b_obs, F.max("ingestion_timestamp").alias("hwm"))

    # one partition per batch (its lower high-water mark): a rerun overwrites
    # it, so repeated messages are all kept and none is written twice
    batch = _batch_id(hwm)
    registry = spark.read.parquet(lay.path("silver", "equipment_registry"))
    enriched = EN.enrich_with_registry(CL.silver_readings(raw), registry, as_of)
    # written once: the good rows, the bad ones and the merge all read it
    staged = lay.path("_batch", "silver")
    T.write_table(enriched, staged)
    good, bad = T.enforce_contract(spark.read.schema(enriched.schema).parquet(staged), SILVER_CONTRACT)
    q_obs = Observation("quarantine")
    quarantine = CL.quarantine_records(raw, as_of).unionByName(_violators(bad, as_of)) \
        .observe(q_obs, F.count(F.lit(1)).alias("new_quarantined"))
    T.write_table(quarantine.withColumn("batch_id", F.lit(batch)), lay.path("silver", "quarantine_records"),
                  "overwrite", ("batch_id",))
    s_obs = Observation("silver")
    good = good.observe(s_obs, F.count(F.lit(1)).alias("clean_readings"),
                        F.count_if(F.col("is_anomaly")).alias("flagged_readings"))
    T.merge_upsert(spark, lay.path("silver", "cleaned_sensor_readings"), good,
                   ["equipment_id", "reading_timestamp"], "reading_date")
    metrics = {**q_obs.get, **s_obs.get, "hwm": b_obs.get.get("hwm"), "days": _days(good, "reading_date")}

    if metrics["days"]:
        # threshold events are per reading: recompute the touched days only
        readings = _of_days(spark.read.parquet(lay.path("silver", "cleaned_sensor_readings")), "reading_date", metrics["days"])
        events = AN.threshold_events(readings, C.FLEET_THRESHOLD_SPECS, as_of) \
            .withColumn("event_date", F.to_date("event_timestamp"))
        T.replace_days(spark, events, lay.path("silver", "anomaly_events"), "event_date", metrics["days"])
        stored = spark.read.schema(events.schema).parquet(lay.path("silver", "anomaly_events"))
        metrics["anomaly_events"] = _of_days(stored, "event_date", metrics["days"]).count()

    flot_path = lay.path("bronze", "raw_flotation_readings")
    if _exists(spark, flot_path):
        metrics.update(silver_flotation(spark, lay, as_of, flot_path))
    bear_path = lay.path("bronze", "raw_bearing_vibration")
    if _exists(spark, bear_path):
        feats = SG.bearing_features(spark.read.parquet(bear_path), as_of)
        T.write_table(feats.select(*SG.FEATURE_COLUMNS), lay.path("silver", "bearing_features"))
    return metrics


def _days(df: DataFrame, col: str) -> list:
    """The days of ``df``: partition values, so no more than a table has folders."""
    return sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)


def _of_days(df: DataFrame, col: str, days: list) -> DataFrame:
    """The rows of some day partitions; the others are pruned."""
    return df.where(F.col(col).isin([F.lit(d) for d in days]) if days else F.lit(False))


def _batch_id(hwm) -> str:
    return "start" if hwm is None else f"after-{hwm:%Y%m%dT%H%M%S%f}"


def _violators(bad: DataFrame, as_of: Column) -> DataFrame:
    """Quarantine rows of readings that break the table contract."""
    return bad.select(
        "equipment_id", "equipment_type",
        F.col("reading_timestamp").cast("string").alias("raw_timestamp"),
        F.lit(C.REASON_CONTRACT).alias("quarantine_reason"),
        F.to_json(F.struct(*bad.columns)).alias("raw_record"),
        as_of.alias("quarantined_at"))


def _after(df: DataFrame, hwm) -> DataFrame:
    if hwm is None:
        return df
    return df.filter((F.col("ingestion_date") >= F.to_date(F.lit(hwm))) & (F.col("ingestion_timestamp") > F.lit(hwm)))


def silver_flotation(spark: SparkSession, lay: Layout, as_of: Column, flot_path: str) -> dict:
    """New flotation bronze rows -> cleaned rows, one ``batch_id`` partition per
    batch: a rerun after a failure overwrites it, and repeated readings (the
    date column is hourly) are all kept. Returns ``flot_days`` (the touched
    days) and ``flot_hwm``."""
    hwm = _state(spark, lay, "flotation")
    raw = _after(spark.read.parquet(flot_path), hwm)
    obs = Observation("flotation")
    raw = raw.observe(obs, F.max("ingestion_timestamp").alias("flot_hwm"))
    value_cols = ["date", *schemas.FLOTATION_COLUMNS]
    key = F.sha2(F.concat_ws("|", F.col("source_file"), F.to_json(F.struct(*value_cols))), 256)
    batch, path = _batch_id(hwm), lay.path("silver", "cleaned_flotation_readings")
    cleaned = PR.clean_flotation(raw, as_of).withColumn("record_key", key).withColumn("batch_id", F.lit(batch))
    T.write_table(cleaned, path, "overwrite", ("batch_id", "reading_date"))
    # written without rows there is nothing to read
    own = spark.read.schema(cleaned.schema).parquet(path).where(F.col("batch_id") == batch)
    return {**obs.get, "flot_days": _days(own, "reading_date")}


# -------------------------------------------------------------------- gold

KPI_CONTRACT = T.Contract(types=schemas.HOURLY_KPI_TYPES, not_null=schemas.HOURLY_KPI_NOT_NULL)


def gold(spark: SparkSession, lay: Layout, as_of: Column, days: list = (), flot_days: list = ()) -> dict:
    """Recompute the gold tables for the touched ``days``, and health, alerts and fleet
    also for the days on which a unit's trend changes with them. Each table is partitioned
    by its day column and only these partitions are replaced, so a run costs the days it
    touches, not the history after them."""
    if days:
        readings = _of_days(spark.read.parquet(lay.path("silver", "cleaned_sensor_readings")), "reading_date", days)
        kpis, broken = T.enforce_contract(KP.hourly_kpis(readings), KPI_CONTRACT)
        kpath = lay.path("gold", "hourly_equipment_kpis")
        T.replace_days(spark, broken, lay.path("gold", "kpi_contract_violations"), "kpi_date", days)
        T.replace_days(spark, kpis, kpath, "kpi_date", days)

        kpis = spark.read.schema(kpis.schema).parquet(kpath)
        registry = spark.read.parquet(lay.path("silver", "equipment_registry"))
        daily = EN.join_limits(KP.daily_rollup(_of_days(kpis, "kpi_date", days)), registry)
        health, more = _health(spark, lay, daily, as_of, days)
        days = sorted({*days, *more})

        health, kpis = _of_days(health, "score_date", days), _of_days(kpis, "kpi_date", days)
        new_alerts = AL.all_alerts(health, as_of)
        apath = lay.path("gold", "maintenance_alerts")
        T.replace_days(spark, new_alerts, apath, "alert_date", days)
        # read back with the known schema: a day without alerts leaves no files
        alerts = _of_days(spark.read.schema(new_alerts.schema).parquet(apath), "alert_date", days)
        T.replace_days(spark, FL.fleet_summary(health, alerts, kpis, as_of), lay.path("gold", "fleet_summary_daily"),
                       "summary_date", days)

    flot = lay.path("silver", "cleaned_flotation_readings")
    if flot_days:
        readings = _of_days(spark.read.parquet(flot), "reading_date", flot_days)
        T.replace_days(spark, PR.flotation_hourly_quality(readings, as_of), lay.path("gold", "flotation_quality_scores"),
                       "score_date", flot_days)
    return {"labels_hwm": _failures(spark, lay, as_of)}


def _failures(spark: SparkSession, lay: Layout, as_of: Column):
    """Calibration from the stored aggregates of all label batches and the new batch, whose
    high-water mark is returned (None: nothing new); no label is read twice."""
    path, partials = lay.path("bronze", "raw_maintenance_labels"), lay.path("gold", "failure_partials")
    if not _exists(spark, path):
        return None
    hwm = _state(spark, lay, "labels")
    new = _after(spark.read.parquet(path), hwm)
    mark = new.agg(F.max("ingestion_timestamp")).first()[0]
    if mark is not None:
        batch = SK.calibration_partials(new).withColumn("batch_id", F.lit(_batch_id(hwm)))
        T.write_table(batch, partials, "overwrite", ("batch_id",))
        T.write_table(SK.calibration_from(spark.read.schema(batch.schema).parquet(partials), as_of), lay.path("gold", "failure_predictions"))
    return mark


HEALTH_KEY = ("equipment_id", "equipment_type", "score_date", "site_location")


def _health(spark: SparkSession, lay: Layout, daily: DataFrame, as_of: Column, days: list) -> tuple[DataFrame, list]:
    """Replace the health rows of ``days`` and those whose trend follows them; the table,
    and the further days that changed. A day that only some units change keeps the other
    units' rows."""
    path = lay.path("gold", "equipment_health_scores")
    T.finish_swaps(spark, path)
    stored = None
    if _exists(spark, path):
        schema = HE.health_scores(daily, as_of).schema
        stored = spark.read.schema(schema).parquet(path).where(~F.col("score_date").isin([F.lit(d) for d in days]))
    changes = HE.health_scores_touching(daily, stored, as_of)
    staged = lay.path("_batch", "health")
    T.write_table(changes, staged)
    changes = spark.read.schema(changes.schema).parquet(staged)
    rows, more = changes.drop(HE.STORED), _days(changes.where(HE.STORED), "score_date")
    if more:
        done = changes.where(HE.STORED).select(*[F.col(c).alias(f"_{c}") for c in HEALTH_KEY])
        same = F.lit(True)
        for c in HEALTH_KEY:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        rows = rows.unionByName(_of_days(stored, "score_date", more).join(done, same, "left_anti"))
    T.replace_days(spark, rows, path, "score_date", [*days, *more])
    return spark.read.schema(rows.schema).parquet(path), more


def run_all(spark: SparkSession, base: str, landing: str, as_of: Column) -> Layout:
    """bronze -> silver (new bronze rows only) -> gold (touched days only);
    the high-water mark is advanced last, so a failed run is simply rerun."""
    lay = Layout(base)
    bronze(spark, lay, landing, as_of)
    m = silver(spark, lay, as_of)
    lay.metrics.update(m)
    m.update(gold(spark, lay, as_of, m["days"], m.get("flot_days", [])))
    for name, mark in (("silver", m.get("hwm")), ("flotation", m.get("flot_hwm")), ("labels", m["labels_hwm"])):
        if mark is not None:
            spark.createDataFrame([(mark,)], "hwm timestamp").write.mode("append").parquet(lay.path("_state", name))
    return lay
