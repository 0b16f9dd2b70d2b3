import os

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("strandforge")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
