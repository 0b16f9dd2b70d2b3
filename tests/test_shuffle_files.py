"""Files of shuffles that are over."""

import os
import time

from pyspark.sql import functions as F

from strandforge.session import CLEANUP, cut_lineage


def test_shuffle_files_go_when_a_table_is_written(spark):
    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle")}

    rows = spark.range(100_000).withColumn("h", F.xxhash64("id")).groupBy("h").agg(F.max("id").alias("m"))
    before, option = files(), spark.conf.get(CLEANUP, None)
    told = cut_lineage(rows)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(CLEANUP, None) == option
    assert told.count() == rows.count() == 100_000  # the rows themselves can still be asked
