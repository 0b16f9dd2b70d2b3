"""Sources and sinks: tables written in a reference format to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.functions.sequence import revcomp
from strandforge.operators.panels import default_barcodes
from strandforge.session import scratch_path
from strandforge.sources import alignments, fasta, genes, isoforms, results

from .inputs import codes, exons, hits, listed, table, transcripts
from .registry import cte, query, using
from .windows import passed, sites

_MESSY = ("CASE WHEN o_orderstatus = 'F' THEN concat('  G', o_orderkey, ' ') WHEN o_orderpriority = '1-URGENT' THEN '0' "
          "WHEN o_orderpriority = '2-HIGH' THEN 'nan' WHEN o_orderpriority = '5-LOW' THEN '   ' ELSE concat('G', o_custkey) END AS gene_name")


@query("gene_list", f"SELECT trim(gene_name) AS gene_name FROM (SELECT {_MESSY} FROM orders) WHERE trim(gene_name) NOT IN ('', '0', 'nan')")
def _(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(_MESSY)
    out = scratch_path(spark, "genes") + ".csv"
    raw.write.csv(out, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return genes.read_gene_table(spark, out).select("gene_name")


@query("gene_list_lines", f"SELECT trim(gene_name) AS gene_name FROM (SELECT {_MESSY} FROM orders) WHERE trim(gene_name) <> ''")
def _(spark, sf_dir):
    out = scratch_path(spark, "lines")
    table(spark, sf_dir, "orders").selectExpr(_MESSY).write.text(out)
    return genes.read_gene_lines(spark, out).select("gene_name")


@query("fasta_scan", using("transcripts", "SELECT gene AS name, concat(gene, '|', source, '|', doc_id) AS header, seq FROM transcripts"))
def _(spark, sf_dir):
    out = scratch_path(spark, "fasta")
    tx = transcripts(spark, sf_dir).withColumn("folded", F.regexp_replace("seq", "(.{70})", "$1\n"))
    fasta.write_fasta(tx, out, F.concat(F.concat_ws("|", F.concat("gene", F.lit(" ")), "source", F.col("doc_id").cast("string"))), "folded")
    got = fasta.scan_fasta(spark, out)
    return got.select("name", F.replace("header", F.lit(" "), F.lit("")).alias("header"), "seq")


@query("blast_xml_scan", using("hits", """SELECT concat('S', site_no) AS query_id, row_number() OVER (PARTITION BY site_no ORDER BY hit_no, hit_id, hit_def, score, evalue, identity, frame) AS hit_rank,
    CAST(1 AS BIGINT) AS hsp_no, hit_id, hit_def, evalue, round(round(identity * 100) / 100.0::DOUBLE, 6) AS identity, score, 1 AS query_frame, frame FROM hits"""))
def _(spark, sf_dir):
    hsp = F.struct(F.lit(1).cast("bigint").alias("Hsp_num"), F.col("score").alias("Hsp_score"), F.col("evalue").alias("Hsp_evalue"),
                   F.round(F.col("identity") * 100).cast("bigint").alias("Hsp_identity"), F.lit(100).cast("bigint").alias("Hsp_align-len"),
                   F.lit(1).alias("Hsp_query-frame"), F.col("frame").alias("Hsp_hit-frame"))
    hit = F.struct(F.col("hit_no").alias("Hit_num"), F.col("hit_id").alias("Hit_id"), F.col("hit_def").alias("Hit_def"),
                   F.struct(F.array(hsp).alias("Hsp")).alias("Hit_hsps"))
    records = (hits(spark, sf_dir).groupBy("site_no").agg(F.sort_array(F.collect_list(hit)).alias("Hit"))
               .select(F.concat(F.lit("S"), F.col("site_no").cast("string"), F.lit("|pos=1")).alias("Iteration_query-def"),
                       F.struct("Hit").alias("Iteration_hits")))
    out = scratch_path(spark, "xml")
    records.write.format("xml").option("rootTag", "BlastOutput").option("rowTag", "Iteration").option("compression", "gzip").save(out)
    return alignments.scan_alignments(spark, out).withColumn("identity", F.round("identity", 6))


@query("isoform_json_scan", using("exons", "SELECT gene, tx_id, exon_start, exon_end FROM exons"))
def _(spark, sf_dir):
    out = scratch_path(spark, "json")
    (exons(spark, sf_dir).groupBy("gene", "tx_id", "strand")
     .agg(F.collect_list(F.struct(F.col("exon_start").alias("start"), F.col("exon_end").alias("end"))).alias("Exon"))
     .select(F.col("tx_id").alias("id"), "gene", "strand", "Exon").write.json(out))
    return isoforms.scan_isoforms(spark, out)[1]


@query("sequence_json", using("transcripts", "SELECT doc_id, gene, source, seq FROM transcripts"))
def _(spark, sf_dir):
    out, tx = scratch_path(spark, "seqs"), transcripts(spark, sf_dir)
    isoforms.write_sequences(tx, out)
    return isoforms.read_sequences(spark, out, tx.schema)


def numbered_sites(spark, sf_dir):
    from strandforge.operators.ranking import ranked
    s = sites(spark, sf_dir).select("doc_id", "gene", "pos", "probe", "g_content", "tm")
    return (ranked(s, ["gene"], F.floor(F.col("pos") / 65536), ["pos"], "site_no").drop("site_no_of")
            .withColumn("genomic_start", F.lit(None).cast("bigint")).withColumn("genomic_end", F.lit(None).cast("bigint")))


cte("numbered_sites", "SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS site_no FROM sites", "sites")
_LINE = ("'>' || gene || '_' || site_no || '|pos=' || pos || {gpos} || '|g_content=' || printf('%.2f', g_content) {tm} || chr(10) || probe AS value")


@query("write_fasta", using("numbered_sites", "SELECT doc_id, site_no, " + _LINE.format(gpos="'|gpos=None-None'", tm="|| '|tm=' || printf('%.1f', tm)")
                            + ", " + _LINE.format(gpos="''", tm="").replace("AS value", "AS short_value") + " FROM numbered_sites"))
def _(spark, sf_dir):
    return numbered_sites(spark, sf_dir).select(
        "doc_id", "site_no", fasta.fasta_lines(fasta.site_header(), "probe").alias("value"),
        fasta.fasta_lines(fasta.site_header(short=True), "probe").alias("short_value"))


@query("fasta_batches", using("numbered_sites", "SELECT doc_id, pos, (row_number() OVER (ORDER BY doc_id, pos) - 1) // 100 AS batch FROM numbered_sites"))
def _(spark, sf_dir):
    s = numbered_sites(spark, sf_dir).select("doc_id", "pos")
    # a gene has at most the capped number of sites, so a block of 1024 genes stays small
    return fasta.with_batch(s, 100, F.floor(F.col("doc_id") / 1024), ["doc_id", "pos"])


@query("write_table", using("sites", "SELECT gene, probe, pos, round(g_content, 6) AS g_content, round(tm, 6) AS tm FROM sites"))
def _(spark, sf_dir):
    out = scratch_path(spark, "table")
    results.write_table(results.flat_sites(sites(spark, sf_dir)), out)
    return spark.read.parquet(out).withColumns({c: F.round(c, 6) for c in ("g_content", "tm")})


@query("write_gene_list", using("listed", "SELECT gene_name FROM listed"))
def _(spark, sf_dir):
    out = scratch_path(spark, "list") + ".txt"
    genes.write_gene_list(listed(spark, sf_dir), out)
    return genes.read_gene_lines(spark, out).select("gene_name")


@query("results_union", using("passed transcripts", """SELECT source AS run, p.doc_id, p.pos, probe, CASE WHEN source < 'src5' THEN round(tm, 6) END AS tm
  FROM passed p JOIN transcripts t USING (doc_id)"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "runs")
    rows = run_rows(spark, sf_dir).select("source", "doc_id", "pos", "probe", "tm")
    for tag, part in (("early", rows.filter("source < 'src5'")), ("late", rows.filter("source >= 'src5'").drop("tm"))):
        part.write.parquet(f"{root}/{tag}/probes")
    spark.createDataFrame([(1,)], "note INT").write.parquet(f"{root}/broken/other")
    got = results.read_runs(spark, root)
    return got.select(F.col("source").alias("run"), "doc_id", "pos", "probe", F.round("tm", 6).alias("tm"))


def run_rows(spark, sf_dir):
    """Passing windows of every source: the runs that are merged."""
    from strandforge.operators import filters
    from strandforge.operators.windows import windows_bruteforce
    w = windows_bruteforce(transcripts(spark, sf_dir), ["doc_id", "gene", "source"])
    return filters.passing(w, filters.DEMO).withColumn("probe", revcomp("target"))


@query("barcode_scan", using("codes", """SELECT code_no AS idx, concat('PRISM_', code_no) AS barcode_name, code AS barcode FROM codes"""))
def _(spark, sf_dir):
    out = scratch_path(spark, "barcodes")
    codes(spark, sf_dir).select(F.col("code_no").alias("idx"), F.concat(F.lit("PRISM_"), F.col("code_no").cast("string")).alias("barcode_name"),
                                F.col("code").alias("Barcode (82bp)")).write.csv(out, header=True)
    return results.read_barcodes(spark, out, "PRISM")
