"""Gapless ranks without a window over the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def gapless_rank(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with the position (0, 1, ...) of each row within its ``group``, by ``order``
    and, for a total order, the other columns' hash.

    Rows are dealt by ranges of (group, order), so a large group lies in many partitions,
    and numbered in their partition as they are stored. What a group has in the partitions
    before is a sum over a table of one row per partition and group. No window or task ever
    holds a group. Meant for narrow tables: keep wide columns out and join them."""
    ties = F.xxhash64(*df.columns)
    dealt = (
        df.withColumn("_tie", ties).repartitionByRange(*group, *order, "_tie").sortWithinPartitions(*group, *order, "_tie")
        .withColumns({"_id": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))
    # stored: the numbers must not change between the two uses
    rows = materialize(dealt.drop("_tie"), "ranked")
    pieces = rows.groupBy(*group, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(starts, same).select(*df.columns, (F.col("_id") - F.col("_first") + F.col("_before")).alias(name))
