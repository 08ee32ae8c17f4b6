"""Session settings for running the operators at scale.

``cluster_conf`` sizes shuffle partitions from the input volume so a
partition stays near ``target_partition_mb`` (spill-free on a few GB of
executor memory), and turns on the adaptive features the operators rely
on: AQE re-planning (runtime broadcast of small join sides, coalescing of
small post-shuffle partitions) and skew-join splitting.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 128) -> dict[str, str]:
    parts = max(total_cores, math.ceil(input_bytes / (target_partition_mb << 20)))
    # round up to a multiple of the core count so waves are full
    parts = math.ceil(parts / total_cores) * total_cores
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "10m",
    }


def apply(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark
