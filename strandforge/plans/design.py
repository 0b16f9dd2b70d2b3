"""Whole searches as one lazy plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.sequence import revcomp
from ..operators.filters import Thresholds, passing
from ..operators.offtarget import specific_by_search
from ..operators.ranking import first_per
from ..operators.spacing import selected_arrays
from ..operators.windows import windows_at, windows_bruteforce, windows_junction
from ..session import cut_lineage


def brute_force_sites(seqs: DataFrame, t: Thresholds, key: str = "gene", share: float = 0.1) -> DataFrame:
    """Windows -> limits -> even spacing per gene, in the site schema.

    With ``start``, ``end`` and ``strand`` present the genomic coordinates are the approximate ones of the
    coding sequence laid on the whole transcript (introns are not counted).
    """
    place = [c for c in ("start", "end", "strand") if c in seqs.columns]
    chosen = selected_arrays(passing(windows_bruteforce(seqs, [key], t.length, share, limits=t), t), key, "pos", t.max_sites)
    # The chosen starts go back to the sequences, not to the passing windows: those would move about fourteen
    # bytes per base through a shuffle, the sequences move one.
    sites = windows_at(seqs.join(chosen, key), [key, *place], "picks", t.length)
    if len(place) == 3:
        g_start = (F.when(F.col("strand") == 1, F.col("start") + F.col("pos"))
                   .when(F.col("strand") == -1, F.col("end") - F.col("pos") - t.length))
    else:
        g_start = F.lit(None).cast("bigint")
    return (sites.withColumn("sequence", revcomp("target")).withColumn("genomic_start", g_start)
            .withColumn("genomic_end", F.col("genomic_start") + t.length).withColumn("position", F.col("pos"))
            .withColumn("length", F.lit(t.length)).withColumn("strategy", F.lit("brute_force"))
            .drop("pos", "n_bad", *[c for c in place if c != "strand"]))


def junction_sites(seqs: DataFrame, t: Thresholds, key: str = "gene") -> DataFrame:
    """Windows around the supposed junctions -> limits -> the first of each gene, in the site schema; no genomic places."""
    found = passing(windows_junction(seqs, [key], t.length), t)
    none = F.lit(None).cast("bigint")
    return (first_per(found, [key], ["ord"], t.max_sites).withColumn("sequence", revcomp("target"))
            .withColumn("genomic_start", none).withColumn("genomic_end", none).withColumn("position", F.col("pos"))
            .withColumn("length", F.lit(t.length)).withColumn("strategy", F.lit("exon_junction")).drop("pos", "ord", "n_bad"))


def screened_sites(seqs: DataFrame, t: Thresholds, reference: DataFrame, mismatches: int = 1) -> DataFrame:
    """Brute-force sites that bind nowhere in ``reference`` (gene, seq) but in their own gene.

    The sites, a small fixed number per gene, are written once: the search asks for their targets, the
    result for the rest of their columns. Sites have ``t.length`` known letters, so all of them can be searched and there are no
    rejects beside them.
    """
    if t.length <= mismatches:
        raise ValueError("a site of no more bases than mismatches matches everywhere")
    sites = cut_lineage(brute_force_sites(seqs, t))
    return specific_by_search(sites, reference, mismatches)[0]
