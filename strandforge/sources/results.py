"""Result tables: flat projections, runs side by side, barcode tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.panels import barcode_column, default_barcodes

FLAT = ["gene", "probe", "pos", "g_content", "tm", "strategy", "evalue", "identity", "alignment_count"]


def flat_sites(sites: DataFrame) -> DataFrame:
    """The flat columns of a result table, as far as they are there; nested ones are left out."""
    return sites.select(*[c for c in FLAT if c in sites.columns])


def write_table(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet, JSON lines or csv with a header."""
    writer = rows.write.option("header", True) if fmt == "csv" else rows.write
    writer.format(fmt).save(path)


def read_runs(spark: SparkSession, root: str, table: str = "probes") -> DataFrame:
    """The same table from every run folder under ``root``; runs without it are skipped.

    Columns that a run lacks are null in its rows; ``run`` is the folder name.
    """
    rows = spark.read.option("mergeSchema", True).parquet(f"{root.rstrip('/')}/*/{table}")
    return rows.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+)/{table}/[^/]*$", 1))


def read_barcodes(spark: SparkSession, path: str | None, panel: str) -> DataFrame:
    """barcodes(idx, barcode_name, barcode) from a csv, else the numbered placeholders of the panel."""
    if path is None:
        return default_barcodes(spark, panel)
    rows = spark.read.csv(path, header=True)
    return rows.select(F.col("idx").cast("bigint").alias("idx"), "barcode_name", F.col(barcode_column(panel)).alias("barcode"))
