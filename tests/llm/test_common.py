import glob
import time

from pyspark.sql import functions as F

from quarrysight.llm import common


def test_a_stored_table_leaves_no_shuffle_files(spark):
    dirs = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    was, before = spark.conf.get(common.CLEANUP, None), files()
    out = common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")), "test")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(common.CLEANUP, None) == was
    assert sum(r.n for r in out.collect()) == 1000
