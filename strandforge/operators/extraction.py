"""Sequence extraction and choice of transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.sequence import revcomp
from .ranking import first_per
from .windows import cut_pieces


def genome_chunks(seqs: DataFrame, region: str = "region", seq: str = "seq", size: int = 10000) -> DataFrame:
    """genome(region, chunk_no, chunk_start, chunk): fixed-size pieces, 1-based ``chunk_start``, no overlap."""
    return cut_pieces(seqs.select(F.col(region).alias("region"), seq), seq, 0, size).select(
        "region", F.col("piece_no").cast("bigint").alias("chunk_no"),
        (F.col("piece_start") + 1).alias("chunk_start"), F.col("piece").alias("chunk"))


def fetch_regions(intervals: DataFrame, genome: DataFrame, size: int = 10000, start: str = "start", end: str = "end",
                  out: str = "seq") -> DataFrame:
    """``region:start..end``, 1-based and inclusive, for every interval row; positions off the region give nothing.

    An interval is joined only to the chunks it touches, on (region, chunk), and its parts are put together in
    chunk order. Equal intervals are fetched once.
    """
    s, e = F.col(start), F.col(end)
    asked = intervals.select("region", s.alias("_s"), e.alias("_e")).distinct().filter("_e >= _s AND _e >= 1")
    first = F.floor((F.greatest(F.col("_s"), F.lit(1)) - 1) / size).cast("bigint")
    touched = asked.withColumn("chunk_no", F.explode(F.sequence(first, F.floor((F.col("_e") - 1) / size).cast("bigint"))))
    lo, hi = F.greatest("_s", "chunk_start"), F.least(F.col("_e"), F.col("chunk_start") + F.length("chunk") - 1)
    parts = touched.join(genome, ["region", "chunk_no"]).withColumn(
        "part", F.col("chunk").substr((lo - F.col("chunk_start") + 1).cast("int"), F.greatest(hi - lo + 1, F.lit(0)).cast("int")))
    whole = parts.groupBy("region", "_s", "_e").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk_no", "part"))), lambda x: x["part"]), "").alias(out))
    return (intervals.join(whole.withColumnRenamed("_s", start).withColumnRenamed("_e", end), ["region", start, end], "left"))


def fetch_flanked(intervals: DataFrame, genome: DataFrame, gap: int = 50, size: int = 10000) -> DataFrame:
    """Interval plus ``gap`` bases on both sides, reverse-complemented on strand -1."""
    wide = intervals.withColumn("_ws", F.greatest(F.col("start") - gap, F.lit(1))).withColumn("_we", F.col("end") + gap)
    got = fetch_regions(wide, genome, size, "_ws", "_we")
    return got.withColumn("seq", F.when(F.col("strand") == -1, revcomp("seq")).otherwise(F.col("seq"))).drop("_ws", "_we")


def longest_transcript(tx: DataFrame, gene: str = "gene", order: str = "tx_order") -> DataFrame:
    """Per gene the transcript with the longest sequence; the first one wins ties; empty ones are skipped."""
    return first_per(drop_empty(tx), [gene], [F.length("seq").desc(), order])


def shortest_named_isoform(tx: DataFrame, gene: str = "gene", name: str = "tx_name", order: str = "tx_order",
                           below: int = 10**6) -> DataFrame:
    """Per gene the shortest transcript whose name holds the gene, ignoring case; the first one wins ties."""
    named = tx.filter(F.contains(F.upper(name), F.upper(gene)) & (F.length("seq") < below))
    return first_per(named, [gene], [F.length("seq"), order])


def drop_empty(tx: DataFrame, seq: str = "seq") -> DataFrame:
    return tx.filter(F.col(seq).isNotNull() & (F.col(seq) != ""))


def coding_sequence(records: DataFrame, features: DataFrame, last: bool = False) -> DataFrame:
    """The CDS of every record, or its full sequence where it has none (or an empty one).

    ``features(record, feature_no, type, part_start, part_end, strand)`` has one row per part, 1-based inclusive.
    The first CDS counts (``last=True``: the last, as in the earlier version); parts join in transcript order.
    """
    cds = features.filter(F.col("type") == "CDS")
    pick = F.max("feature_no") if last else F.min("feature_no")
    chosen = cds.groupBy("record").agg(pick.alias("feature_no"))
    parts = (cds.join(chosen, ["record", "feature_no"]).groupBy("record")
             .agg(F.sort_array(F.collect_list(F.struct("part_start", "part_end"))).alias("_parts"),
                  F.min("strand").alias("_strand")))
    joined = F.array_join(F.transform("_parts", lambda p: F.col("seq").substr(
        p["part_start"].cast("int"), (p["part_end"] - p["part_start"] + 1).cast("int"))), "")
    cds_seq = F.when(F.col("_strand") == -1, revcomp(joined)).otherwise(joined)
    return (records.join(parts, "record", "left")
            .withColumn("cds", F.coalesce(F.nullif(cds_seq, F.lit("")), F.col("seq"))).drop("_parts", "_strand"))


def genomic_context(records: DataFrame, features: DataFrame, loci: DataFrame) -> DataFrame:
    """Where a record lies: from its own features when it is genomic, else from the first gene locus.

    Genomic records have an accession NC_, NG_, NW_ or NT_; the first mRNA counts, else the first CDS; a
    ``chromosome`` replaces the accession as the region name.
    """
    spans = (features.filter(F.col("type").isin("mRNA", "CDS")).groupBy("record", "feature_no", "type", "strand")
             .agg(F.min("part_start").alias("start"), F.max("part_end").alias("end")))
    best = first_per(spans, ["record"], [F.when(F.col("type") == "mRNA", 0).otherwise(1), "feature_no"])
    own = (records.filter(F.col("accession").rlike("^(NC_|NG_|NW_|NT_)")).join(best, "record")
           .select("record", F.coalesce(F.nullif(F.col("chromosome"), F.lit("")), F.col("accession")).alias("o_region"),
                   F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                   F.when(F.col("strand").isin(1, -1), F.col("strand")).alias("o_strand")))
    locus = first_per(loci, ["record"], ["locus_no"]).select(
        "record", F.col("region").alias("l_region"), F.col("start").alias("l_start"),
        F.col("end").alias("l_end"), F.col("strand").alias("l_strand"))
    found = F.col("o_region").isNotNull()
    return (records.select("record", "accession").join(own, "record", "left").join(locus, "record", "left")
            .select("record", "accession", *[F.when(found, F.col(f"o_{c}")).otherwise(F.col(f"l_{c}")).alias(c)
                                             for c in ("region", "start", "end", "strand")]))


def attach_sequence(genes: DataFrame, candidates: DataFrame, sequences: DataFrame) -> DataFrame:
    """Listed genes with their sequence (first candidate id of each), or the reason why there is none."""
    first = first_per(candidates, ["gene_name"], ["candidate_no"]).select("gene_name", "record")
    got = genes.join(first, "gene_name", "left").join(sequences, "record", "left")
    return got.withColumn("status", F.when(F.col("record").isNull(), "no record found")
                          .when(F.col("seq").isNull() | (F.col("seq") == ""), "no sequence").otherwise("ok"))


def transcripts_of_gene(asked: DataFrame, catalog: DataFrame, strands: DataFrame | None = None) -> DataFrame:
    """All transcripts of the genes to which the asked transcripts belong, with the strand by gene if given.

    Asked transcripts are reduced to their genes first, so a gene asked for many times is listed once.
    """
    genes = catalog.join(asked.select("tx_id"), "tx_id", "left_semi").select("gene").distinct()
    out = catalog.join(genes, "gene", "left_semi")
    return out.join(strands, "gene", "left") if strands is not None else out


def isoform_bounds(tx: DataFrame, exons: DataFrame) -> DataFrame:
    """isoforms(gene, tx_id, tx_order, name, start, end, strand, region); those without exons drop out."""
    bounds = (exons.filter("exon_start IS NOT NULL AND exon_end IS NOT NULL").groupBy("gene", "tx_id")
              .agg(F.min("exon_start").alias("start"), F.max("exon_end").alias("end")))
    return (tx.join(bounds, ["gene", "tx_id"])
            .select("gene", "tx_id", "tx_order", F.coalesce(F.nullif(F.col("tx_name"), F.lit("")), F.col("tx_id")).alias("name"),
                    "start", "end", F.coalesce("strand", F.lit(1)).alias("strand"), F.coalesce("region", F.lit("1")).alias("region")))
