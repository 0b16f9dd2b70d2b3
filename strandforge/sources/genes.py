"""Gene lists: tables with a gene column, plain lines, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_gene_table(spark: SparkSession, path: str, column: str = "gene_name") -> DataFrame:
    """Clean gene names from a csv with a header, or from a headerless tab-separated txt.

    Blank names, ``0`` and ``nan`` are dropped; duplicates stay. ``row_no`` keeps the order of the file.
    """
    if path.rstrip("/").lower().endswith(".csv"):
        rows = spark.read.csv(path, header=True)
        if column not in rows.columns:
            raise ValueError(f"column '{column}' not found, available: {rows.columns}")
    else:
        rows = spark.read.csv(path, sep="\t", schema=f"{column} STRING")
    name = F.trim(F.col(column))
    return (rows.select(name.alias("gene_name"), F.monotonically_increasing_id().alias("row_no"))
            .filter(F.col("gene_name").isNotNull() & ~F.col("gene_name").isin("", "0", "nan")))


def read_gene_lines(spark: SparkSession, path: str) -> DataFrame:
    """One gene per line that is not blank."""
    return (spark.read.text(path).select(F.trim("value").alias("gene_name"), F.monotonically_increasing_id().alias("row_no"))
            .filter("gene_name <> ''"))


def write_gene_list(genes: DataFrame, path: str) -> None:
    """csv with a header for a path ending in .csv, else one name per line."""
    names = genes.select("gene_name")
    if path.rstrip("/").lower().endswith(".csv"):
        names.write.csv(path, header=True)
    else:
        names.write.text(path)
