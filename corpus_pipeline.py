"""From raw documents to packed training sequences: every stage works on all that the one before it kept.

STAGES maps names to functions (spark, docs, sf_dir) -> DataFrame. Each result is written as Parquet to the shared folder and read again, so a
lost executor replays one stage at most. All stages but the last return the columns of ``documents``; the last returns the pieces of sequences.

Nulls: a null text passes every filter, is one empty line, links with nothing and packs as its closing token alone. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandforge.llm import decontaminate, jaccard, line_dedup, packing, queries, toxicity
from strandforge.session import cut_lineage, tune


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window reaches the threshold go."""
    tune(spark)
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest doc_id that holds them; n_chars follows the text."""
    tune(spark)
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.lit(0).cast("bigint"))).select(docs.columns)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the smallest doc_id stays."""
    tune(spark)
    return jaccard.drop_similar(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words inside benchmark windows go."""
    tune(spark)
    return decontaminate.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 1024 tokens."""
    tune(spark)
    return packing.pack_documents(docs, queries.ranks_path())


STAGES = [
    ("toxicity", _toxicity),
    ("line_dedup", _line_dedup),
    ("jaccard_join", _near_duplicates),
    ("decontamination", _decontamination),
    ("packing", _packing),
]
#: Scores, tokens and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
