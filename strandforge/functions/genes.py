"""Gene names matched against a gene list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_base_name(rows: DataFrame, genes: DataFrame, name: str = "gene_name", out: str = "base_name",
                   strip_when_full_listed: bool = False) -> DataFrame:
    """Drop a trailing ``-digits`` when the rest is listed, ignoring case.

    ``strip_when_full_listed`` is the earlier rule, which also strips when only the full name is listed.
    """
    listed = genes.select(F.upper("gene_name").alias("_listed")).distinct()
    base = F.regexp_extract(name, r"^(.+)-(\d+)$", 1)
    out_rows = (rows.withColumn("_base", base)
                .join(listed.withColumn("_hit", F.lit(True)), F.upper("_base") == F.col("_listed"), "left").drop("_listed"))
    strip = F.col("_hit").isNotNull()
    if strip_when_full_listed:
        out_rows = out_rows.join(listed.withColumn("_full", F.lit(True)), F.upper(name) == F.col("_listed"), "left").drop("_listed")
        strip = strip | F.col("_full").isNotNull()
    return (out_rows.withColumn(out, F.when((F.col("_base") != "") & strip, F.col("_base")).otherwise(F.col(name)))
            .drop("_base", "_hit", "_full"))
