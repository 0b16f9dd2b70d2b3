"""Barcoded probe panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.sequence import suffix_prefix_overlap
from ..session import cut_lineage
from .ranking import first_per, ranked

# Primers, barcode columns and placeholder counts of the panels.
PRIMER_LEFT = "TCCCTACACGACGCTCTTCCGATCT"
PRIMER_RIGHT = "CATTCCTGCTGAACCGCTCTTCCGA"
PANELS = {"PRISM": ("Barcode (82bp)", 31, 2), "SPRINTseq": ("Barcode(70bp)", 369, 3)}
SITE_LENGTH = 40


def barcode_column(panel: str) -> str:
    return PANELS[panel][0]


def composite_barcode(code: Column, left: str = PRIMER_LEFT, right: str = PRIMER_RIGHT) -> Column:
    return F.concat(F.lit(left), code, F.lit(right), code)


def default_barcodes(spark: SparkSession, panel: str) -> DataFrame:
    """Placeholder barcodes(idx, barcode_name, barcode), ``idx`` from 0; none for other panels."""
    _, count, width = PANELS.get(panel, ("", 0, 1))
    number = (F.col("id") + 1).cast("string")
    code = F.concat(F.lit("Barcode_"), F.lpad(number, width, "0"))
    return spark.range(count).select(F.col("id").alias("idx"), F.concat(F.lit(f"{panel}_"), number).alias("barcode_name"),
                                     (composite_barcode(code) if panel == "SPRINTseq" else code).alias("barcode"))


def gene_numbers(genes: DataFrame, order: str, width: int = 65536) -> DataFrame:
    """(gene, gene_no): 0-based place of every gene in the list, genes without sites included."""
    return (ranked(genes.select("gene", order), [], F.floor(F.col(order) / width), [order], "_n")
            .select("gene", (F.col("_n") - 1).alias("gene_no")))


def assign_barcodes(numbered: DataFrame, barcodes: DataFrame, count: int) -> DataFrame:
    """The i-th gene takes barcode ``i mod count``."""
    return (numbered.withColumn("idx", F.col("gene_no") % count).join(barcodes, "idx").drop("idx"))


def first_sites(sites: DataFrame, order: list) -> DataFrame:
    return first_per(sites, ["gene"], order)


def split_site(site: str = "binding") -> tuple[Column, Column]:
    return F.lower(F.left(site, F.lit(20))), F.lower(F.substring(F.col(site), 21, 2**31 - 1))


def prism_probes(sites: DataFrame) -> DataFrame:
    """Lower back of the site + upper barcode + lower front of the site."""
    front, back = split_site()
    return (sites.withColumn("binding_left", front).withColumn("binding_right", back)
            .withColumn("probe", F.concat("binding_right", F.upper("barcode"), "binding_left")))


def sprintseq_probes(sites: DataFrame) -> DataFrame:
    return sites.withColumn("probe", F.concat("binding", "barcode"))


def custom_probes(sites: DataFrame) -> DataFrame:
    return sites.withColumn("probe", F.col("binding"))


def assemble(sites: DataFrame, genes: DataFrame, panel: str, barcodes: DataFrame | None = None, count: int | None = None,
             site_order: str = "pos", gene_order: str = "gene_order") -> DataFrame:
    """One probe per gene from its first site. PRISM, SPRINTseq, or the bare site for any other panel."""
    chosen = first_sites(sites, [site_order])
    if panel not in PANELS:
        return custom_probes(chosen)
    if barcodes is None:
        barcodes, count = default_barcodes(sites.sparkSession, panel), PANELS[panel][1]
    with_code = assign_barcodes(chosen.join(gene_numbers(genes, gene_order), "gene"), barcodes, count)
    return prism_probes(with_code) if panel == "PRISM" else sprintseq_probes(with_code)


def zip_barcodes(probes: DataFrame, barcodes: DataFrame, start: int = 0) -> DataFrame:
    """n-th probe with the barcode of ``idx = start + n``; stops at the shorter side. Needs ``probe_no``."""
    return probes.withColumn("idx", F.col("probe_no") + start).join(barcodes, "idx")


def multi_site_panel(sites: DataFrame, genes: DataFrame, barcodes: DataFrame, panel: str = "PRISM", per_gene: int = 3,
                     site_order: str = "pos", gene_order: str = "gene_order") -> tuple[DataFrame, DataFrame]:
    """(probes, rejects): up to ``per_gene`` sites per gene, all with the barcode of the gene.

    Rejects bear a ``reason``: ``length`` for sites that have not that of a panel site, ``no barcode`` for the sites of genes beyond the
    barcode table. ``barcodes.idx`` is 0-based by gene with sites. The sites are written once, as several steps read them.
    """
    sites = cut_lineage(sites, "sites")
    good = F.coalesce(F.length("binding") == SITE_LENGTH, F.lit(False))
    with_sites = genes.join(sites.select("gene").distinct(), "gene", "left_semi")
    few = first_per(sites.filter(good), ["gene"], [site_order], per_gene)
    # at most per_gene rows per gene are left, so numbering them is a small window
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("gene").orderBy(site_order)))
    codes = gene_numbers(with_sites, gene_order).join(barcodes.withColumnRenamed("idx", "gene_no"), "gene_no")
    coded = few.join(codes, "gene")
    rejects = (sites.filter(~good).withColumn("reason", F.lit("length"))
               .unionByName(sites.filter(good).join(codes.select("gene"), "gene", "left_anti").withColumn("reason", F.lit("no barcode"))))
    tag = "PR" if panel == "PRISM" else "Seq"
    front, back = split_site()
    code = (F.col("gene_no") + 1).cast("string")
    return (coded.withColumn(panel, F.concat(F.lit(f"{panel}_"), code))
            .withColumn("probe_name", F.concat_ws("_", F.lit(tag), code, "gene", F.col("n").cast("string")))
            .withColumn("probe", F.concat(back, F.col("barcode"), front)), rejects)


def circular_neighbours(panel: DataFrame, group: str, order: str) -> DataFrame:
    """Worst overlap of each probe with the next one of its group, the last with the first.

    ``order`` is 0-based inside the group, so the neighbour is found by an equi-join on (group, next).
    """
    size = panel.groupBy(group).agg(F.count("*").alias("_size"))
    left = panel.join(size, group).withColumn("_next", (F.col(order) + 1) % F.col("_size"))
    right = panel.select(group, F.col(order).alias("_next"), F.col("binding").alias("next_binding"))
    both = left.join(right, [group, "_next"])
    return both.withColumn("degree", F.greatest(suffix_prefix_overlap("binding", "next_binding"),
                                                suffix_prefix_overlap("next_binding", "binding"))).drop("_size")


def panel_report(quality: DataFrame) -> DataFrame:
    """Per gene: probes, whether all are valid, and its errors and warnings prefixed with the gene.

    ``quality`` holds probe rows with ``warnings``, ``errors`` and ``is_valid``. Repeated messages are listed once
    per gene, so a gene with many probes still gives a short list.
    """
    def said(c: str) -> Column:
        return F.array_sort(F.array_distinct(F.transform(
            F.flatten(F.collect_set(c)), lambda m: F.concat(F.col("gene"), F.lit(": "), m))))

    return quality.groupBy("gene").agg(
        F.count("*").alias("probes"), F.bool_and("is_valid").alias("is_valid"),
        said("errors").alias("errors"), said("warnings").alias("warnings"))


def gene_coverage(probes: DataFrame) -> DataFrame:
    return probes.groupBy("gene").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("total_genes"), F.sum((F.col("n") > 0).cast("bigint")).alias("genes_with_probes"),
        (F.sum("n") / F.count("*")).alias("avg_probes_per_gene"))
