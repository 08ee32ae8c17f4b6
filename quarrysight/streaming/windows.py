"""(Extension) streaming silver/gold: watermark, de-duplication and hourly
window KPIs over a reading stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.checks import exact_avg


def hourly_window_kpis(stream: DataFrame, ts_col: str, unit_col: str, value_col: str, status_col: str,
                       operating: tuple[str, ...], watermark: str = "2 hours",
                       dedup_keys: tuple[str, ...] | None = None) -> DataFrame:
    """Tumbling 1-hour windows per unit, emitted once the watermark passes
    the window end (append mode). With ``dedup_keys`` repeated messages are
    dropped inside the watermark (``dropDuplicatesWithinWatermark``).

    ``withWatermark`` needs a TIMESTAMP. A wall-clock (NTZ) column is moved
    to the instant that shows the same wall clock in UTC, so windows (aligned
    to epoch hours) fall on its wall-clock hours whatever the session zone;
    the window bounds are moved back and returned as NTZ.
    """
    ntz = isinstance(stream.schema[ts_col].dataType, TimestampNTZType)
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    if ntz:
        stream = stream.withColumn(ts_col, F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), zone))
    df = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    if dedup_keys:
        df = df.dropDuplicatesWithinWatermark(list(dedup_keys))
    g = df.groupBy(F.window(ts_col, "1 hour").alias("w"), F.col(unit_col)).agg(
        F.count("*").alias("total_readings"),
        F.sum(F.when(F.col(status_col).isin(*operating), 1).otherwise(0)).alias("operating_readings"),
        exact_avg(value_col).alias("avg_value"),
        F.max(value_col).alias("max_value"),
    )
    def bound(c):
        return F.to_utc_timestamp(c, zone).cast("timestamp_ntz") if ntz else c

    return g.select(
        bound(F.col("w.start")).alias("window_start"), bound(F.col("w.end")).alias("window_end"), unit_col,
        "total_readings", "operating_readings",
        F.round(F.col("operating_readings") / F.col("total_readings") * 100, 2).alias("utilization_pct"),
        "avg_value", "max_value",
    )


def stream_silver(stream: DataFrame, spec=None, watermark: str = "2 hours") -> DataFrame:
    """(Extension) the silver stage on a reading stream: strict timestamp
    parse, hard-limit breaches dropped, quality flags, then repeated
    messages of one (unit, time) dropped while the watermark holds them.

    Streaming de-duplication keeps the first copy that arrives, not the best
    one (the batch stage's rule needs every copy at once); a better late
    copy is reconciled by the batch upsert.
    """
    from .. import config as C
    from ..operators.clean import PARSED, flag_quality, passing_records

    spec = spec or C.FLEET_SILVER
    good = passing_records(stream, spec).withColumn(PARSED, F.col(PARSED).cast("timestamp"))
    flagged = flag_quality(good, spec.rules).withWatermark(PARSED, watermark)
    return flagged.dropDuplicatesWithinWatermark([spec.unit_col, PARSED])
