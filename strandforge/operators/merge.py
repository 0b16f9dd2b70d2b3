"""Merging runs, and what is still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ranking import first_per


def merge_runs(rows: DataFrame, sequence: str, order: list) -> DataFrame:
    """One row per binding sequence: the first in ``order`` (run, then place in the run).

    With ``order`` = (gene, position) it is the earlier rule, which sorts before it drops repeats. The row
    limit works on the map side, so a sequence found in very many runs does not travel as a whole.
    """
    return first_per(rows, [sequence], order)


def sorted_result(merged: DataFrame, gene: str = "gene", pos: str = "pos") -> DataFrame:
    return merged.orderBy(gene, pos)


def missing_genes(genes: DataFrame, results: DataFrame, gene: str = "gene") -> DataFrame:
    """Listed genes without a result, ignoring case; repeats in the list stay."""
    found = results.select(F.upper(gene).alias("_g")).distinct()
    return genes.withColumn("_g", F.upper("gene_name")).join(found, "_g", "left_anti").drop("_g")
