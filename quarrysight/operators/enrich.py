"""Registry enrichment (left joins to a dimension table). How to join is left
to the planner: a small registry is broadcast by its size, a large one shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


REGISTRY_COLS = ("model", "manufacturer", "site_location")
LIMIT_COLS = ("max_engine_temp_c", "max_oil_pressure_bar", "max_payload_tonnes")


def enrich_with_registry(
    readings: DataFrame,
    registry: DataFrame,
    as_of: Column,
    key: str = "equipment_id",
    ts_col: str = "parsed_ts",
    registry_cols: tuple[str, ...] = REGISTRY_COLS,
    limit_cols: tuple[str, ...] = LIMIT_COLS,
    drop_cols: tuple[str, ...] = ("timestamp", "ingestion_timestamp", "source_file", "ingestion_date", "_rescued_data"),
) -> DataFrame:
    """Left join to the registry (unmatched readings keep NULL attributes) and
    shape the silver row: ``reading_timestamp``, ``reading_date``,
    ``bronze_ingestion_timestamp``, ``silver_processed_timestamp``."""
    reg = registry.select(
        key,
        *[F.col(c) for c in registry_cols],
        *[F.col(c).alias(f"_reg_{c}") for c in limit_cols],
    )
    joined = readings.join(reg, on=key, how="left")
    ingest = F.col("ingestion_timestamp") if "ingestion_timestamp" in readings.columns else F.lit(None).cast("timestamp")
    out = joined.withColumns(
        {
            "reading_timestamp": F.col(ts_col),
            "reading_date": F.to_date(F.col(ts_col)),
            "bronze_ingestion_timestamp": ingest,
            "silver_processed_timestamp": as_of,
            **{c: F.col(f"_reg_{c}") for c in limit_cols},
        }
    )
    gone = [ts_col, *[c for c in drop_cols if c in out.columns], *[f"_reg_{c}" for c in limit_cols]]
    # keep an existing measure column of the same name out of the way
    return out.drop(*gone)


def join_limits(daily: DataFrame, registry: DataFrame, key: str = "equipment_id",
                temp_col: str = "max_engine_temp_c", pressure_col: str = "max_oil_pressure_bar") -> DataFrame:
    """Daily aggregates + the unit's safe limits (``max_safe_temp/pressure``);
    a registry without a limit column yields NULL for it."""
    def limit(c: str):
        return F.col(c) if c in registry.columns else F.lit(None).cast("double")
    reg = registry.select(key, limit(temp_col).alias("max_safe_temp"), limit(pressure_col).alias("max_safe_pressure"))
    return daily.join(reg, on=key, how="left")
