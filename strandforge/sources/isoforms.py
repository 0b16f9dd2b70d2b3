"""Transcript JSON: isoforms with their exons, and gene -> sequence files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = ("id STRING, gene STRING, external_name STRING, biotype STRING, seq STRING, seq_region_name STRING, start BIGINT, "
          "`end` BIGINT, strand INT, Exon ARRAY<STRUCT<start: BIGINT, `end`: BIGINT>>")


def scan_isoforms(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(transcripts, exons) from JSON lines of transcript lookups."""
    raw = spark.read.schema(SCHEMA).json(path)
    tx = raw.select("gene", F.col("id").alias("tx_id"), F.coalesce("external_name", F.lit("")).alias("tx_name"),
                    F.coalesce("biotype", F.lit("")).alias("biotype"), F.coalesce("seq", F.lit("")).alias("seq"),
                    F.length(F.coalesce("seq", F.lit(""))).cast("bigint").alias("length"),
                    F.col("seq_region_name").alias("region"), "start", "end", "strand")
    exons = raw.select("gene", F.col("id").alias("tx_id"), F.explode("Exon").alias("x")).select(
        "gene", "tx_id", F.col("x.start").alias("exon_start"), F.col("x.end").alias("exon_end"))
    return tx, exons


def write_sequences(seqs: DataFrame, path: str) -> None:
    seqs.write.json(path)


def read_sequences(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
