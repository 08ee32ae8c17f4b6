"""Sharding by weighted rendezvous hashing (built-in expressions only).

Each shard ``i`` of weight ``w`` draws ``-ln(u(key, i)) / w`` with ``u`` a hash
of key and shard in (0, 1); the smallest draw wins. A shard gets keys in
proportion to its weight, and one more shard only takes rows to itself: the
other draws do not change.

Defined cases: a null key is one key of its own; null text has size 8 and the
crc32 of no bytes; rows with equal keys go to one shard and get different slots
(rows equal in all columns are interchangeable); an empty table gives no rows;
other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, utf8

ROW_OVERHEAD = 8  # bytes a row takes besides its text


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard (int) of a key among ``len(weights)`` shards; a shard of weight 0
    takes no rows."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight")
    draws = [
        F.struct(
            # 53 hash bits, centred, so that 0 < u < 1
            (-F.log((F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + F.lit(0.5))
                    / F.lit(float(1 << 53))) / F.lit(float(w))).alias("draw"),
            F.lit(i).alias("shard"),
        )
        for i, w in enumerate(weights) if w > 0
    ]
    return F.array_min(F.array(*draws))["shard"]


def with_slots(df: DataFrame, group: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Gapless positions from 0 within ``group``, in ``order``, without bringing
    a group to one task: rows are ranged over (group, order), so a large group
    spans many tasks; each then needs only the counts of the tasks before it.
    The salt splits runs of equal rows."""
    ranged = (
        df.withColumn("_salt", F.monotonically_increasing_id())
        .repartitionByRange(group, *order, "_salt")
        .sortWithinPartitions(group, *order)
        .drop("_salt")
    )
    # positions count rows within stored partitions, so these must not move
    rows = (
        checkpointed(ranged)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        rows.groupBy(F.col("_part").alias("_p"), F.col(group).alias("_g"))
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    return (
        rows.join(runs, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
        .withColumn(slot, F.col("_at") - F.col("_first") + F.col("_base"))
        .drop("_part", "_at", "_p", "_g", "_n", "_first", "_base")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float],
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, slot and size of each document: (doc_id, size, text_crc32, law,
    shard, slot, grown_shard). ``grown`` are the weights after growth. Texts are
    read once and never shuffled; only these narrow rows are."""
    key, raw = F.col(id_col), utf8(text_col)
    narrow = docs.select(
        key.alias("doc_id"),
        (F.octet_length(raw).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, grown).alias("grown_shard"),
    )
    return with_slots(checkpointed(narrow), "shard", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
