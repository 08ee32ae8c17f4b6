"""Silver cleaning: parse, quarantine, flag, de-duplicate.

One scan of the raw table feeds both outputs: the parsed timestamp and the
hard-limit test are computed once and the two complementary filters read the
same projection (no ``subtract``/EXCEPT, which would shuffle whole rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import SilverSpec
from ..functions.checks import flag_reasons, hard_violation, quality_from_flag_count
from ..functions.timestamps import parse_timestamp

PARSED = "parsed_ts"
_HARD = "_hard_violation"


def with_parsed_timestamp(df: DataFrame, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """Adds ``parsed_ts`` (strict patterns, NULL when none matches)."""
    return df.withColumn(PARSED, parse_timestamp(spec.raw_ts_col, spec.ts_patterns, spec.ts_type))


def _routed(df: DataFrame, spec: SilverSpec) -> DataFrame:
    parsed = with_parsed_timestamp(df, spec)
    return parsed.withColumn(_HARD, F.coalesce(hard_violation(spec.rules), F.lit(False)))


def quarantine_records(df: DataFrame, as_of: Column, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """Rows with an unparseable timestamp or a hard-limit breach, with the
    reason and the whole record (incl. the parsed timestamp) as JSON."""
    r = _routed(df, spec)
    record_cols = [c for c in r.columns if c != _HARD]
    return r.filter(F.col(PARSED).isNull() | F.col(_HARD)).select(
        F.col(spec.unit_col).alias("equipment_id"),
        F.col(spec.type_col).alias("equipment_type"),
        F.col(spec.raw_ts_col).cast("string").alias("raw_timestamp"),
        F.when(F.col(PARSED).isNull(), F.lit(C.REASON_BAD_TS)).otherwise(F.lit(C.REASON_HARD_LIMIT)).alias("quarantine_reason"),
        F.to_json(F.struct(*record_cols)).alias("raw_record"),
        as_of.alias("quarantined_at"),
    )


def passing_records(df: DataFrame, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """Rows with a parsed timestamp and no hard-limit breach (``parsed_ts`` kept)."""
    r = _routed(df, spec)
    return r.filter(F.col(PARSED).isNotNull() & ~F.col(_HARD)).drop(_HARD)


def flag_quality(df: DataFrame, rules: tuple = C.SENSOR_RULES) -> DataFrame:
    """``anomaly_reasons`` in rule order, ``is_anomaly``, ``quality_score``."""
    reasons = flag_reasons(rules)
    return df.withColumns(
        {
            "anomaly_reasons": reasons,
            "is_anomaly": F.size(reasons) > 0,
            "quality_score": quality_from_flag_count(F.size(reasons)),
        }
    )


def completeness(cols: list[str]) -> Column:
    """Number of non-null values among ``cols``."""
    total = F.lit(0)
    for c in cols:
        total = total + F.when(F.col(c).isNotNull(), 1).otherwise(0)
    return total


def dedup_keep_best(df: DataFrame, keys: list[str], spec: SilverSpec = C.FLEET_SILVER,
                    ties: tuple[str, ...] | None = None) -> DataFrame:
    """One row per key: best quality, then the more complete row, then the
    smallest of the ``ties`` columns; by default the earliest ingestion, the
    source file and a row hash, so the result does not depend on partitioning.

    Catalyst plans ``row_number() = 1`` with a partial WindowGroupLimit before
    the shuffle, so a key with many copies is cut down map-side.
    """
    measure_cols = list(spec.completeness_cols or [r.column for r in spec.rules])
    order = [F.col("quality_score").desc(), completeness(measure_cols).desc()]
    if ties is not None:
        order += [F.col(c).asc() for c in ties]
    elif spec.ingest_ts_col and spec.ingest_ts_col in df.columns:
        order.append(F.col(spec.ingest_ts_col).asc_nulls_last())
    if ties is None and spec.source_col and spec.source_col in df.columns:
        order.append(F.col(spec.source_col).asc_nulls_last())
    if ties is None:
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def silver_readings(df: DataFrame, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """Parse -> drop quarantined -> flag -> de-duplicate on (unit, parsed_ts)."""
    good = passing_records(df, spec)
    flagged = flag_quality(good, spec.rules)
    return dedup_keep_best(flagged, [spec.unit_col, PARSED], spec)


def stage_counts(df: DataFrame, spec: SilverSpec = C.FLEET_SILVER, rescued_col: str = "_rescued_data") -> DataFrame:
    """One row: how many records came, stay after quarantine and de-duplication, are
    quarantined, and were rescued. One scan, one parse and one shuffle of the keys; a key's
    copies are combined before it."""
    rescued = F.count_if(F.col(rescued_col).isNotNull()) if rescued_col in df.columns else F.lit(0)
    good = F.count_if(F.col(PARSED).isNotNull() & ~F.col(_HARD))
    keys = _routed(df, spec).groupBy(spec.unit_col, PARSED).agg(
        F.count("*").alias("_all"), good.alias("_good"), rescued.cast("bigint").alias("_rescued"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return keys.agg(total(F.col("_all")).alias("bronze_records"), F.count_if(F.col("_good") > 0).alias("silver_records"),
                    total(F.col("_all") - F.col("_good")).alias("quarantined_records"), total(F.col("_rescued")).alias("rescued_records"))


def split_bad_timestamps(df: DataFrame, as_of: Column, spec: SilverSpec = C.FLEET_SILVER) -> tuple[DataFrame, DataFrame]:
    """(rows with a parsed timestamp, quarantine rows of the others)."""
    parsed = with_parsed_timestamp(df, spec)
    bad = quarantine_records(df, as_of, spec).filter(F.col("quarantine_reason") == C.REASON_BAD_TS)
    return parsed.filter(F.col(PARSED).isNotNull()), bad


def quarantine_hard_limits(df: DataFrame, as_of: Column, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """P5: quarantine rows of readings that parse but break a hard rule."""
    return quarantine_records(df, as_of, spec).filter(F.col("quarantine_reason") == C.REASON_HARD_LIMIT)


def drop_quarantined(df: DataFrame, spec: SilverSpec = C.FLEET_SILVER) -> DataFrame:
    """The complement of both quarantine reasons (a filter, not EXCEPT)."""
    return passing_records(df, spec)
