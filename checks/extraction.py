"""Sequence extraction and choice of transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.operators import extraction as ex

from .inputs import exons, listed, sql_revcomp, table, transcripts
from .registry import cte, query, using

SIZE = 1000


def genome(spark, sf_dir):
    return ex.genome_chunks(transcripts(spark, sf_dir), "gene", "seq", SIZE)


def intervals(spark, sf_dir):
    return exons(spark, sf_dir).select(F.col("gene").alias("region"), "tx_id", "tx_no", F.col("exon_start").alias("start"),
                                       F.col("exon_end").alias("end"), "strand")


@query("region_fetch", using("exons transcripts", """SELECT e.gene AS region, tx_id, exon_start AS start, exon_end AS "end",
  substr(seq, exon_start, exon_end - exon_start + 1) AS seq FROM exons e JOIN transcripts t ON t.gene = e.gene"""))
def _(spark, sf_dir):
    return ex.fetch_regions(intervals(spark, sf_dir), genome(spark, sf_dir), SIZE).select("region", "tx_id", "start", "end", "seq")


@query("region_batch", using("exons transcripts", """SELECT e.gene AS region, lo AS start, hi AS "end", substr(seq, lo, hi - lo + 1) AS seq
  FROM (SELECT gene, tx_id, min(exon_start) AS lo, max(exon_end) AS hi FROM exons GROUP BY 1, 2) e JOIN transcripts t ON t.gene = e.gene"""))
def _(spark, sf_dir):
    spans = exons(spark, sf_dir).groupBy("gene", "tx_id").agg(F.min("exon_start").alias("start"), F.max("exon_end").alias("end"))
    return ex.fetch_regions(spans.withColumnRenamed("gene", "region"), genome(spark, sf_dir), SIZE).select("region", "start", "end", "seq")


@query("region_flanked", using("exons transcripts", f"""SELECT region, tx_id, start, "end", strand, CASE strand WHEN -1 THEN {sql_revcomp('s')} ELSE s END AS seq FROM (
  SELECT e.gene AS region, tx_id, exon_start AS start, exon_end AS "end", e.strand,
    substr(seq, greatest(exon_start - 50, 1), exon_end + 50 - greatest(exon_start - 50, 1) + 1) AS s FROM exons e JOIN transcripts t ON t.gene = e.gene)"""))
def _(spark, sf_dir):
    return ex.fetch_flanked(intervals(spark, sf_dir), genome(spark, sf_dir), 50, SIZE).select("region", "tx_id", "start", "end", "strand", "seq")


def catalog(spark, sf_dir):
    """Four transcripts per gene symbol; some without a name, some without a sequence."""
    return transcripts(spark, sf_dir).selectExpr(
        "concat('F', doc_id div 4) AS gene", "concat('T', doc_id) AS tx_id", "doc_id % 4 AS tx_order",
        "CASE doc_id % 4 WHEN 3 THEN concat('novel', doc_id) ELSE concat('f', doc_id div 4, '-20', doc_id % 4) END AS tx_name", "seq")


cte("catalog", """SELECT concat('F', doc_id // 4) AS gene, concat('T', doc_id) AS tx_id, doc_id % 4 AS tx_order,
  CASE doc_id % 4 WHEN 3 THEN concat('novel', doc_id) ELSE concat('f', doc_id // 4, '-20', doc_id % 4) END AS tx_name, seq FROM transcripts""", "transcripts")


@query("longest_transcript", using("catalog", """SELECT gene, tx_id, length(seq) AS len FROM (SELECT *, row_number() OVER
  (PARTITION BY gene ORDER BY length(seq) DESC, tx_order) AS n FROM catalog WHERE seq <> '') WHERE n = 1"""))
def _(spark, sf_dir):
    return ex.longest_transcript(catalog(spark, sf_dir)).select("gene", "tx_id", F.length("seq").cast("bigint").alias("len"))


@query("shortest_named_isoform", using("catalog", """SELECT gene, tx_id, length(seq) AS len FROM (SELECT *, row_number() OVER
  (PARTITION BY gene ORDER BY length(seq), tx_order) AS n FROM catalog WHERE contains(upper(tx_name), upper(gene)) AND length(seq) < 1000000) WHERE n = 1"""))
def _(spark, sf_dir):
    return ex.shortest_named_isoform(catalog(spark, sf_dir)).select("gene", "tx_id", F.length("seq").cast("bigint").alias("len"))


@query("drop_empty_seq", using("transcripts", "SELECT doc_id, length(seq) AS len FROM transcripts WHERE seq <> ''"))
def _(spark, sf_dir):
    return ex.drop_empty(transcripts(spark, sf_dir)).select("doc_id", F.length("seq").cast("bigint").alias("len"))


def records(spark, sf_dir):
    return transcripts(spark, sf_dir).selectExpr(
        "gene AS record", "concat(CASE doc_id % 3 WHEN 0 THEN 'NC_' WHEN 1 THEN 'NM_' ELSE 'NG_' END, doc_id) AS accession",
        "CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS chromosome", "seq")


def features(spark, sf_dir):
    return exons(spark, sf_dir).selectExpr("gene AS record", "tx_no AS feature_no",
                                           "CASE WHEN tx_no = 1 THEN 'mRNA' ELSE 'CDS' END AS type",
                                           "exon_start AS part_start", "exon_end AS part_end", "strand")


cte("records", """SELECT gene AS record, concat(CASE doc_id % 3 WHEN 0 THEN 'NC_' WHEN 1 THEN 'NM_' ELSE 'NG_' END, doc_id) AS accession,
  CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS chromosome, seq FROM transcripts""", "transcripts")
cte("features", """SELECT gene AS record, tx_no AS feature_no, CASE WHEN tx_no = 1 THEN 'mRNA' ELSE 'CDS' END AS type,
  exon_start AS part_start, exon_end AS part_end, strand FROM exons""", "exons")


def _cds(pick: str) -> str:
    return f"""SELECT r.record, CASE WHEN c.s IS NULL THEN r.seq WHEN c.strand = -1 THEN {sql_revcomp('c.s')} ELSE c.s END AS cds
      FROM records r LEFT JOIN (SELECT record, strand, string_agg(substr(seq, part_start, part_end - part_start + 1), '' ORDER BY part_start) AS s
        FROM features JOIN records USING (record) WHERE (record, feature_no) IN
          (SELECT record, {pick}(feature_no) FROM features WHERE type = 'CDS' GROUP BY 1) GROUP BY 1, 2) c USING (record)"""


@query("coding_sequence", using("records features", f"""SELECT a.record, a.cds, b.cds AS cds_last FROM ({_cds('min')}) a JOIN ({_cds('max')}) b USING (record)"""))
def _(spark, sf_dir):
    r, f = records(spark, sf_dir), features(spark, sf_dir)
    first = ex.coding_sequence(r, f).select("record", "cds")
    return first.join(ex.coding_sequence(r, f, last=True).select("record", F.col("cds").alias("cds_last")), "record")


cte("spans", "SELECT record, feature_no, type, strand, min(part_start) AS s, max(part_end) AS e FROM features GROUP BY 1, 2, 3, 4", "features")
cte("best_span", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record ORDER BY CASE type WHEN 'mRNA' THEN 0 ELSE 1 END, feature_no) AS n FROM spans) WHERE n = 1", "spans")
cte("loci", "SELECT record, arg_min(s, feature_no) AS s, arg_min(e, feature_no) AS e, any_value(strand) AS strand FROM spans GROUP BY 1", "spans")


@query("genomic_context", using("records best_span loci", """SELECT r.record, r.accession, CASE WHEN b.record IS NOT NULL THEN CASE WHEN chromosome <> '' THEN chromosome ELSE accession END WHEN l.record IS NOT NULL THEN concat('chr', r.record) END AS region,
    CASE WHEN b.record IS NOT NULL THEN b.s ELSE l.s END AS start, CASE WHEN b.record IS NOT NULL THEN b.e ELSE l.e END AS "end",
    CASE WHEN b.record IS NOT NULL THEN b.strand ELSE l.strand END AS strand
  FROM records r LEFT JOIN best_span b ON b.record = r.record AND r.accession NOT LIKE 'NM%' LEFT JOIN loci l ON l.record = r.record"""))
def _(spark, sf_dir):
    loci = (features(spark, sf_dir).groupBy("record", F.col("feature_no").alias("locus_no"), "strand")
            .agg(F.min("part_start").alias("start"), F.max("part_end").alias("end")).withColumn("region", F.concat(F.lit("chr"), "record")))
    return ex.genomic_context(records(spark, sf_dir), features(spark, sf_dir), loci)


@query("attach_sequence", using("listed records", """SELECT l.gene_name, r.record, coalesce(length(seq), 0) AS len,
  CASE WHEN c.rec IS NULL THEN 'no record found' WHEN seq IS NULL OR seq = '' THEN 'no sequence' ELSE 'ok' END AS status
  FROM listed l LEFT JOIN (SELECT concat('G', doc_id) AS gene_name, min(quality) AS q, concat('G', doc_id) AS rec FROM labels GROUP BY 1, 3) c USING (gene_name)
  LEFT JOIN records r ON r.record = c.rec"""))
def _(spark, sf_dir):
    cand = table(spark, sf_dir, "labels").selectExpr("concat('G', doc_id) AS gene_name", "concat('G', doc_id) AS record", "quality AS candidate_no")
    got = ex.attach_sequence(listed(spark, sf_dir).select("gene_name"), cand, records(spark, sf_dir).select("record", "seq"))
    return got.select("gene_name", F.when(F.col("seq").isNotNull(), F.col("record")).alias("record"),
                      F.coalesce(F.length("seq"), F.lit(0)).cast("bigint").alias("len"), "status")


@query("transcripts_of_gene", using("catalog", """SELECT gene, tx_id, CASE WHEN length(gene) % 2 = 0 THEN 1 ELSE -1 END AS strand
  FROM catalog WHERE gene IN (SELECT gene FROM catalog JOIN labels ON tx_id = concat('T', doc_id) WHERE quality = 1)"""))
def _(spark, sf_dir):
    c = catalog(spark, sf_dir).select("gene", "tx_id")
    strands = c.select("gene").distinct().withColumn("strand", F.expr("CASE WHEN length(gene) % 2 = 0 THEN 1 ELSE -1 END"))
    asked = table(spark, sf_dir, "labels").filter("quality = 1").selectExpr("concat('T', doc_id) AS tx_id")
    return ex.transcripts_of_gene(asked, c, strands)


@query("isoform_bounds", using("exons transcripts", """SELECT gene, tx_id, CASE WHEN t % 2 = 0 THEN concat('iso', t) ELSE tx_id END AS name, lo AS start, hi AS "end", strand,
  CASE WHEN t = 2 THEN '1' ELSE source END AS region FROM (SELECT e.gene, tx_id, tx_no AS t, strand, source, min(exon_start) AS lo, max(exon_end) AS hi
  FROM exons e JOIN transcripts USING (doc_id) GROUP BY ALL)"""))
def _(spark, sf_dir):
    tx = transcripts(spark, sf_dir).select("doc_id", "gene", "source", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("t")).selectExpr(
        "gene", "concat(gene, '_', t) AS tx_id", "t AS tx_order", "CASE WHEN t % 2 = 0 THEN concat('iso', t) ELSE '' END AS tx_name",
        "CASE WHEN doc_id % 2 = 0 THEN NULL ELSE -1 END AS strand", "CASE WHEN t = 2 THEN NULL ELSE source END AS region")
    return ex.isoform_bounds(tx, exons(spark, sf_dir)).drop("tx_order")
