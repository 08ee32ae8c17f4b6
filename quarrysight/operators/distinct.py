"""A12 over any range of days: exact distinct units from stored bitmaps.

A unit's whole-number id falls into a bucket of 32,768 ids and is one bit there. A day has a
bitmap for each bucket it meets, at most 4 KB for 32,768 units; a range's count is that of
the days' bitmaps OR-ed bucket by bucket. No range is counted from its readings, and none
needs the days' units sent anywhere. Units with text ids get numbers from :func:`unit_ids`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import gapless_rank


def daily_bitmaps(df: DataFrame, day: Column, unit: Column) -> DataFrame:
    """(day, bucket, bitmap) of the units met on each day; NULL units and days count as none."""
    ids = df.select(day.alias("day"), unit.cast("bigint").alias("_id")).where("day is not null and _id is not null")
    return (ids.groupBy("day", F.bitmap_bucket_number("_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bitmap")))


def add_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Several batches' bitmaps as one per day and bucket."""
    return bitmaps.groupBy("day", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_in_ranges(bitmaps: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (first, last) with ``units``, the number of distinct units in those days."""
    r = ranges.select("first", "last").distinct()
    days = r.where(F.col("first") <= F.col("last")).select("first", "last", F.explode(F.sequence("first", "last")).alias("_day"))
    per_bucket = (
        days.join(bitmaps, F.col("_day") == F.col("day"))
        .groupBy("first", "last", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n")))
    counts = per_bucket.groupBy(F.col("first").alias("_f"), F.col("last").alias("_l")).agg(F.sum("n").alias("units"))
    same = F.col("first").eqNullSafe(F.col("_f")) & F.col("last").eqNullSafe(F.col("_l"))
    return r.join(counts, same, "left").select("first", "last", F.coalesce("units", F.lit(0)).alias("units"))


def unit_ids(known: DataFrame | None, units: DataFrame) -> DataFrame:
    """(unit, id): numbers of text ids. Known units keep theirs, new ones go on from there."""
    new = units.select(F.col("unit")).where("unit is not null").distinct()
    start = 0
    if known is not None:
        new = new.join(known.select(F.col("unit").alias("_u")), F.col("unit") == F.col("_u"), "left_anti")
        start = (known.agg(F.max("id")).first()[0] if not known.isEmpty() else -1) + 1
    numbered = gapless_rank(new.withColumn("_all", F.lit(0)), ["_all"], ["unit"], "id").select("unit", (F.col("id") + start).alias("id"))
    return numbered if known is None else known.select("unit", "id").unionByName(numbered)
