"""Files left by inputs that are written once."""

import os
import time

from checks import inputs


def test_staged_texts_leave_no_shuffle_files(spark, tmp_path):
    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle")}

    spark.createDataFrame([(i, "s", f"text number {i}") for i in range(500)], "doc_id BIGINT, source STRING, text STRING").write.parquet(
        str(tmp_path / "documents.parquet"))
    before = files()
    told = inputs.transcripts(spark, str(tmp_path))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and told.count() == 500
    assert inputs.transcripts(spark, str(tmp_path)).inputFiles() == told.inputFiles()
