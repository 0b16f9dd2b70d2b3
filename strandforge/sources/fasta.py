"""FASTA in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.sequence import fixed_point
from ..operators.ranking import ranked


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``name`` (up to the first blank), ``header`` and ``seq`` with its lines joined."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("r"))
    end = F.locate("\n", F.col("r"))
    header = F.regexp_replace(F.when(end > 0, F.left("r", end - 1)).otherwise(F.col("r")), r"^\s+|\s+$", "")
    body = F.when(end > 0, F.col("r").substr(end + 1, F.length("r"))).otherwise(F.lit(""))
    return (records.select(header.alias("header"), F.regexp_replace(body, r"\s", "").alias("seq"))
            .filter("header <> ''")
            .select(F.split("header", " ")[0].alias("name"), "header", "seq"))


def site_header(short: bool = False) -> Column:
    """``gene_n|pos=|gpos=|g_content=|tm=`` of saved sites, or the short form for an aligner.

    Numbers are rounded from their exact binary value.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    parts = [F.concat(F.col("gene"), F.lit("_"), F.col("site_no").cast("string")), F.concat(F.lit("pos="), text("pos"))]
    if not short:
        parts.append(F.concat(F.lit("gpos="), text("genomic_start"), F.lit("-"), text("genomic_end")))
    parts.append(F.concat(F.lit("g_content="), fixed_point("g_content", 2, 60)))
    if not short:
        parts.append(F.concat(F.lit("tm="), fixed_point("tm", 1)))
    return F.concat_ws("|", *parts)


def fasta_lines(header: Column, seq: Column | str) -> Column:
    return F.concat(F.lit(">"), header, F.lit("\n"), F.col(seq) if isinstance(seq, str) else seq)


def write_fasta(records: DataFrame, path: str, header: Column, seq: str, per: str | None = None) -> None:
    """Records as FASTA text; ``per`` writes one folder per value of that column."""
    lines = records.select(*([per] if per else []), fasta_lines(header, seq).alias("value"))
    (lines.write.partitionBy(per) if per else lines.write).text(path)


def with_batch(records: DataFrame, size: int, block: Column, order: list) -> DataFrame:
    """0-based ``batch`` of ``size`` records each, in ``order`` over the whole table."""
    return (ranked(records, [], block, order, "_n")
            .withColumn("batch", F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_n", "_n_of"))
