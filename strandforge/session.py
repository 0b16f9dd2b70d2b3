"""Session helpers: shipped code, shared scratch space, lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch that a kernel gets; 10,000 rows of text, as Spark deals them, are many times that on both sides of the pipe.
ARROW_BYTES = "4m"
#: Spark's option to delete shuffle files when the statement that made them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SHIPPED: set[str] = set()
_SCRATCH: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; one of our own only where that is unset and all tasks run in this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="strandforge-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table in the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(clear_scratch)
    _SCRATCH.append((spark, path))
    return path


def clear_scratch() -> None:
    """Delete the scratch tables of this driver; those of sessions that have ended stay for the folder's owner."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session is gone: nothing can be reached any more
            return


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is planned and run in here as soon as each statement ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later loss replays only the read.

    The shuffles of the write are of no use after it; Spark deletes their files as soon as the table is written, not when the driver happens
    to collect its garbage, so that disk holds those of one write at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    told = spark.read.schema(df.schema).parquet(path)
    told.scratch = path
    return told


def drop_cuts(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that no plan reads any more: all that was made from them is written itself."""
    for df in tables:
        spark, path = df.sparkSession, df.scratch
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if (spark, path) in _SCRATCH:
            _SCRATCH.remove((spark, path))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that kernels import wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="strandforge-code-"), "strandforge.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("strandforge", os.path.relpath(path, top)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def tune(spark: SparkSession) -> None:
    """Ship the code, bound the Arrow batches of kernels by bytes, and let adaptive execution hash the smaller side of a shuffled join when each
    of its partitions is small.

    The check is on real sizes at run time; larger partitions are still sorted and merged, which can spill.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
