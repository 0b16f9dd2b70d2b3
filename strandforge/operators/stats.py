"""Counts and averages of sites and panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _or_zero(c: str):
    return F.coalesce(F.col(c), F.lit(0.0)).alias(c)


def site_stats(sites: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """Sites, mean G content and mean Tm per listed gene; zeros for genes without sites."""
    per_gene = sites.groupBy(gene).agg(F.count("*").alias("total_sites"), F.avg("g_content").alias("avg_g_content"),
                                       F.avg("tm").alias("avg_tm"))
    return (genes.select(gene).distinct().join(per_gene, gene, "left")
            .select(gene, F.coalesce("total_sites", F.lit(0).cast("bigint")).alias("total_sites"),
                    _or_zero("avg_g_content"), _or_zero("avg_tm")))


def run_stats(sites: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """One row for a whole run, over the listed genes."""
    per_gene = sites.groupBy(gene).agg(
        F.count("*").alias("n"), F.sum("g_content").alias("g_sum"), F.sum("tm").alias("tm_sum"),
        F.min("g_content").alias("g_min"), F.max("g_content").alias("g_max"),
        F.min("tm").alias("tm_min"), F.max("tm").alias("tm_max"))
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return (genes.select(gene).distinct().join(per_gene, gene, "left").agg(
        F.count("*").alias("total_genes"), total.alias("total_binding_sites"), F.count("n").alias("genes_with_sites"),
        F.try_divide(total.cast("double"), F.count("*")).alias("avg_sites_per_gene"),
        F.try_divide(F.sum("g_sum"), F.sum("n")).alias("avg_g_content"), F.try_divide(F.sum("tm_sum"), F.sum("n")).alias("avg_tm"),
        F.min("g_min").alias("min_g_content"), F.max("g_max").alias("max_g_content"),
        F.min("tm_min").alias("min_tm"), F.max("tm_max").alias("max_tm")).fillna(0.0))


def panel_stats(probes: DataFrame) -> DataFrame:
    """Total probes, distinct genes, mean probe length, G content and Tm of an assembled panel."""
    return probes.agg(F.count("*").alias("total_probes"), F.count_distinct("gene").alias("unique_genes"),
                      F.avg(F.length("probe")).alias("avg_probe_length"), F.avg("g_content").alias("avg_g_content"),
                      F.avg("tm").alias("avg_tm"))


def merge_stats(merged: DataFrame, gene: str = "gene") -> DataFrame:
    """Probes, distinct genes, probes per gene and averages of a merged result."""
    return (merged.agg(F.count("*").alias("total_probes"), F.count_distinct(gene).alias("genes"),
                       F.avg("g_content").alias("avg_g_content"), F.avg("tm").alias("avg_tm"))
            .withColumn("probes_per_gene", F.when(F.col("genes") > 0, F.col("total_probes") / F.col("genes"))))


def candidate_counts(sites: DataFrame, *keys: str) -> DataFrame:
    return sites.groupBy(*keys).agg(F.count("*").alias("candidates"))
