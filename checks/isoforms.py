"""Isoform algebra and isoform-aware sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.functions.sequence import base_count, revcomp
from strandforge.operators import isoforms as iso
from strandforge.operators.filters import DEMO

from .inputs import add_spacing, exons, sql_pass, sql_revcomp, sql_windows, transcripts
from .registry import cte, query, using
from .windows import r6

LIMITS = DEMO.but(max_sites=30)


def ex(spark, sf_dir):
    return exons(spark, sf_dir).select("gene", "tx_id", "exon_start", "exon_end", "strand")


def isoforms(spark, sf_dir):
    e = exons(spark, sf_dir)
    return (e.groupBy("gene", "tx_id", F.col("tx_no").alias("tx_order"), "strand")
            .agg(F.min("exon_start").alias("start"), F.max("exon_end").alias("end")).withColumn("region", F.concat(F.lit("r"), "tx_id")))


def loci(spark, sf_dir):
    return transcripts(spark, sf_dir).select("gene", "seq")


cte("isoforms", """SELECT doc_id, gene, tx_id, tx_no, strand, min(exon_start) AS lo, max(exon_end) AS hi FROM exons GROUP BY ALL""", "exons", keep=True)
cte("points", "SELECT DISTINCT gene, p FROM (SELECT gene, exon_start AS p FROM exons UNION ALL SELECT gene, exon_end FROM exons)", "exons", keep=True)
cte("cuts", "SELECT DISTINCT e.gene, exon_start, exon_end, p AS cut FROM exons e JOIN points q ON q.gene = e.gene AND q.p > e.exon_start AND q.p < e.exon_end", "exons", "points")
cte("tx_splices", """SELECT gene, tx_id, tx_no, strand, p AS s, nxt AS e FROM (SELECT e.gene, e.tx_id, e.tx_no, e.strand, e.exon_start, e.exon_end, q.p,
    lead(q.p) OVER (PARTITION BY e.tx_id, e.exon_start ORDER BY q.p) AS nxt
    FROM exons e JOIN points q ON q.gene = e.gene AND q.p >= e.exon_start AND q.p <= e.exon_end) WHERE nxt IS NOT NULL""", "exons", "points", keep=True)
cte("splices", "SELECT gene, s, e, list_sort(list_distinct(list(tx_id))) AS isoforms FROM tx_splices GROUP BY 1, 2, 3", "tx_splices", keep=True)


@query("locus_bounds", using("isoforms", """SELECT gene, min(lo) AS start, max(hi) AS "end", concat('r', arg_min(tx_id, tx_no)) AS region FROM isoforms GROUP BY 1"""))
def _(spark, sf_dir):
    return iso.locus_bounds(isoforms(spark, sf_dir))


@query("exon_cuts", using("cuts", "SELECT * FROM cuts"))
def _(spark, sf_dir):
    return iso.exon_cuts(ex(spark, sf_dir))


@query("exon_splices", using("splices", "SELECT gene, s, e, array_to_string(isoforms, ',') AS isoforms FROM splices"))
def _(spark, sf_dir):
    return iso.exon_splices(ex(spark, sf_dir)).withColumn("isoforms", F.concat_ws(",", "isoforms"))


@query("splice_counts", using("tx_splices", "SELECT gene, tx_id, s, e, count(*) OVER (PARTITION BY gene, s, e) AS n FROM tx_splices"))
def _(spark, sf_dir):
    return iso.splice_counts(ex(spark, sf_dir))


@query("unique_exons", using("tx_splices", "SELECT gene, s, e, min(tx_id) AS tx_id FROM tx_splices GROUP BY 1, 2, 3 HAVING count(*) = 1"))
def _(spark, sf_dir):
    return iso.unique_exons(ex(spark, sf_dir))


cte("introns", """SELECT * FROM (SELECT gene, tx_id, strand, exon_start AS prev_start, exon_end AS i_start, lead(exon_start) OVER w AS i_end, lead(exon_end) OVER w AS next_end
  FROM exons WINDOW w AS (PARTITION BY tx_id ORDER BY exon_start)) WHERE i_end IS NOT NULL""", "exons")


@query("introns", using("introns", "SELECT gene, tx_id, prev_start, i_start, i_end, next_end, count(*) OVER (PARTITION BY gene, i_start, i_end) AS n FROM introns"))
def _(spark, sf_dir):
    return iso.intron_counts(ex(spark, sf_dir))


@query("unique_introns", using("introns", "SELECT gene, i_start, i_end, min(tx_id) AS tx_id FROM introns GROUP BY 1, 2, 3 HAVING count(*) = 1"))
def _(spark, sf_dir):
    return iso.unique_introns(ex(spark, sf_dir)).select("gene", "i_start", "i_end", "tx_id")


cte("merged", """SELECT gene, tx_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY tx_id ORDER BY s) AS island FROM (
  SELECT *, CASE WHEN s = lag(e) OVER (PARTITION BY tx_id ORDER BY s) THEN 0 ELSE 1 END AS new FROM tx_splices)) GROUP BY gene, tx_id, island""", "tx_splices")


@query("merge_adjacent", using("merged", "SELECT * FROM merged"))
def _(spark, sf_dir):
    return iso.merge_adjacent(iso.isoform_splices(ex(spark, sf_dir)), ["gene", "tx_id"])


@query("windows_isoform", using("isoforms", """SELECT gene, tx_id, hi - 40 - lo + 1 AS windows, lo AS first_pos, hi - 40 AS last_pos, CAST((hi - 40 - lo + 1) * (lo + hi + 40) // 2 AS BIGINT) AS end_total
  FROM isoforms WHERE hi - lo >= 40"""))
def _(spark, sf_dir):
    w = iso.windows_isoform(isoforms(spark, sf_dir))
    return w.groupBy("gene", "tx_id").agg(F.count("*").alias("windows"), F.min("pos").alias("first_pos"),
                                          F.max("pos").alias("last_pos"), F.sum("pos_end").alias("end_total"))


@query("window_end", using("isoforms", """SELECT gene, tx_id, lo AS start, lo + 40 AS "end" FROM isoforms"""))
def _(spark, sf_dir):
    return isoforms(spark, sf_dir).select("gene", "tx_id", "start", iso.window_end("start", 40).alias("end"))


def segments(spark, sf_dir):
    return iso.window_segments(iso.exon_splices(ex(spark, sf_dir)), isoforms(spark, sf_dir))


# every window start of a gene once, whichever isoforms it lies in
cte("starts", """SELECT DISTINCT gene, unnest(range(lo, hi - 39)) AS p FROM isoforms WHERE hi - lo >= 40""", "isoforms")
cte("touched", "SELECT w.gene, w.p, x.s, x.e, x.isoforms FROM starts w JOIN splices x ON x.gene = w.gene AND x.s < w.p + 40 AND x.e > w.p", "starts", "splices", keep=True)
cte("sets", """SELECT gene, p, count(*) AS n, list_sort(list_distinct(flatten(list(isoforms)))) AS iso_union FROM touched GROUP BY 1, 2""", "touched", keep=True)
cte("inter", """SELECT gene, p, list_sort(list(tx)) AS iso_inter FROM (SELECT t.gene, t.p, t.tx, any_value(x.n) AS n, count(*) AS c
    FROM (SELECT gene, p, unnest(isoforms) AS tx FROM touched) t JOIN sets x USING (gene, p) GROUP BY 1, 2, 3) WHERE c = n GROUP BY 1, 2""", "touched", "sets")


@query("overlapping_splices", using("touched", """SELECT gene, s AS start, e AS "end", count(*) AS windows, CAST(sum(p) AS BIGINT) AS pos_total FROM touched GROUP BY 1, 2, 3"""))
def _(spark, sf_dir):
    o = iso.overlapping_splices(segments(spark, sf_dir))
    width = F.col("seg_end") - F.col("seg_start")
    total = (F.col("seg_start") + F.col("seg_end") - 1) * width / 2
    return o.groupBy("gene", "start", "end").agg(F.sum(width).alias("windows"), F.sum(total.cast("bigint")).alias("pos_total"))


def _set_counts(seg, c):
    return (seg.filter(F.size(c) > 0).groupBy("gene", F.concat_ws(",", F.array_sort(c)).alias("isoforms"))
            .agg(F.sum(F.col("seg_end") - F.col("seg_start")).alias("windows"), F.min("seg_start").alias("first_pos")))


@query("isoforms_union", using("sets", "SELECT gene, array_to_string(iso_union, ',') AS isoforms, count(*) AS windows, min(p) AS first_pos FROM sets GROUP BY 1, 2"))
def _(spark, sf_dir):
    return _set_counts(segments(spark, sf_dir), "iso_union")


@query("isoforms_intersection", using("inter", "SELECT gene, array_to_string(iso_inter, ',') AS isoforms, count(*) AS windows, min(p) AS first_pos FROM inter GROUP BY 1, 2"))
def _(spark, sf_dir):
    return _set_counts(segments(spark, sf_dir), "iso_inter")


# thermal windows over the span of all isoforms; both strands are read on the locus sequence
_SPAN = """SELECT concat(gene, '') AS id, g_lo, strand, length(s) AS len, CASE strand WHEN -1 THEN {rc} ELSE s END AS seq FROM (
    SELECT i.gene, i.strand, min(lo) AS g_lo, substr(any_value(t.seq), min(lo), max(hi) - min(lo) + 1) AS s
    FROM isoforms i JOIN transcripts t ON t.gene = i.gene GROUP BY 1, 2)""".format(rc=sql_revcomp("s"))
cte("span", _SPAN, "isoforms", "transcripts", keep=True)
cte("span_windows", sql_windows("SELECT id, len, seq FROM span", "0", "len - 39"), "span", keep=True)
cte("span_passed", f"""SELECT id AS gene, CASE strand WHEN -1 THEN g_lo + x.len - 40 - pos ELSE g_lo + pos END AS p, strand, {sql_revcomp('target')} AS sequence, tm, g_content
  FROM span_windows x JOIN span USING (id) WHERE {sql_pass(LIMITS)}""", "span_windows", "span", keep=True)
cte("specific_all", """SELECT w.gene, w.p, w.sequence, w.tm, i.tx_id, w.p - i.lo AS position FROM span_passed w JOIN inter x USING (gene, p)
    JOIN isoforms i ON i.gene = w.gene AND i.tx_id = x.iso_inter[1] WHERE len(x.iso_inter) = 1 AND w.p >= i.lo AND w.p + 40 <= i.hi""",
    "span_passed", "inter", "isoforms", keep=True)
cte("consensus_all", """SELECT w.gene, w.p, w.sequence, w.tm, array_to_string(x.iso_union, ',') AS target_isoforms, len(x.iso_union) AS cover, i.tx_id, w.p - i.lo AS position
    FROM span_passed w JOIN sets x USING (gene, p) JOIN (SELECT s.gene, s.p, arg_min(i.tx_id, tx_no) AS tx_id, arg_min(i.lo, tx_no) AS lo FROM starts s JOIN isoforms i
      ON i.gene = s.gene AND s.p >= i.lo AND s.p + 40 <= i.hi GROUP BY 1, 2) i ON i.gene = w.gene AND i.p = w.p""", "span_passed", "sets", "starts", "isoforms", keep=True)
add_spacing("specific_all", "gene", "p", LIMITS.max_sites)
add_spacing("consensus_all", "gene", "p", LIMITS.max_sites)
_SPEC = """SELECT a.gene, sequence, p AS genomic_start, p + 40 AS genomic_end, position, tx_id AS isoform_id, round(tm, 6) AS tm
  FROM specific_all a JOIN specific_all_picked k ON k.k = a.gene AND k.pos = a.p"""
_CONS = """SELECT a.gene, sequence, p AS genomic_start, p + 40 AS genomic_end, position, tx_id AS isoform_id, target_isoforms, CAST(cover AS BIGINT) AS isoform_overlap_num, round(tm, 6) AS tm
  FROM consensus_all a JOIN consensus_all_picked k ON k.k = a.gene AND k.pos = a.p"""


@query("specific_sites", using("specific_all specific_all_picked", _SPEC))
def _(spark, sf_dir):
    s = iso.specific_sites(loci(spark, sf_dir), isoforms(spark, sf_dir), iso.exon_splices(ex(spark, sf_dir)), LIMITS)
    return s.select("gene", "sequence", "genomic_start", "genomic_end", "position", "isoform_id", r6("tm"))


def consensus(spark, sf_dir):
    return iso.consensus_sites(loci(spark, sf_dir), isoforms(spark, sf_dir), iso.exon_splices(ex(spark, sf_dir)), LIMITS)


@query("consensus_sites", using("consensus_all consensus_all_picked", _CONS))
def _(spark, sf_dir):
    return consensus(spark, sf_dir).select("gene", "sequence", "genomic_start", "genomic_end", "position", "isoform_id",
                                           F.concat_ws(",", "target_isoforms").alias("target_isoforms"),
                                           F.col("isoform_overlap_num").cast("bigint").alias("isoform_overlap_num"), r6("tm"))


@query("order_by_coverage", using("consensus_all consensus_all_picked", f"SELECT gene, genomic_start, isoform_overlap_num FROM ({_CONS}) ORDER BY isoform_overlap_num DESC, genomic_start, gene"))
def _(spark, sf_dir):
    return iso.order_by_coverage(consensus(spark, sf_dir)).select("gene", "genomic_start", F.col("isoform_overlap_num").cast("bigint").alias("isoform_overlap_num"))


@query("dedup_sites", using("isoforms starts", """SELECT gene, p AS genomic_start, p + 40 AS genomic_end, arg_min(tx_id, tx_no) AS tx_id FROM starts s JOIN isoforms i USING (gene)
  WHERE s.p >= i.lo AND s.p + 40 <= i.hi GROUP BY 1, 2, 3"""))
def _(spark, sf_dir):
    w = iso.windows_isoform(isoforms(spark, sf_dir), ranges=True).select("gene", F.col("pos").alias("genomic_start"), F.col("pos_last").alias("genomic_last"),
                                                                         F.col("tx_order").alias("_ord"), "tx_id")
    return iso.window_places(iso.first_strand(w)).select("gene", "genomic_start", "genomic_end", "tx_id")


cte("sites30", "SELECT s.* FROM passed s JOIN passed30_picked k ON k.k = s.doc_id AND k.pos = s.pos", "passed", "passed30_picked")
cte("passed30", "SELECT * FROM passed", "passed")
add_spacing("passed30", "doc_id", "pos", 30)


@query("search_all_genes", using("consensus_all consensus_all_picked sites30 isoforms", f"""SELECT gene, sequence, position, genomic_start, 'isoform_consensus' AS strategy FROM ({_CONS})
  UNION ALL SELECT gene, probe, pos, NULL, 'brute_force' FROM sites30 WHERE gene NOT IN (SELECT gene FROM isoforms)"""))
def _(spark, sf_dir):
    s = iso.search_all(loci(spark, sf_dir), isoforms(spark, sf_dir), iso.exon_splices(ex(spark, sf_dir)), LIMITS, "isoform_consensus")
    return s.select("gene", "sequence", "position", "genomic_start", "strategy")


cte("tx_sums", "SELECT gene, tx_id, s, e, row_number() OVER w AS i, CAST(coalesce(sum(e - s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS p FROM tx_splices WINDOW w AS (PARTITION BY tx_id ORDER BY s)", "tx_splices", keep=True)
cte("min_sums", "SELECT a.gene, a.tx_id, b.i - a.i + 1 AS k, min(b.p + b.e - b.s - a.p) AS min_sum FROM tx_sums a JOIN tx_sums b ON a.tx_id = b.tx_id AND b.i >= a.i GROUP BY 1, 2, 3", "tx_sums")


@query("min_window_sums", using("min_sums", "SELECT * FROM min_sums"))
def _(spark, sf_dir):
    return iso.min_window_sums(ex(spark, sf_dir))


@query("chain_length", using("min_sums", "SELECT gene, max(k) AS needed FROM (SELECT gene, tx_id, min(k) + 1 AS k FROM min_sums WHERE min_sum >= 60 GROUP BY 1, 2) GROUP BY 1"))
def _(spark, sf_dir):
    return iso.chain_length(ex(spark, sf_dir), 60)


cte("chains", """SELECT gene, n, chain, array_to_string(list_sort(list_distinct(list(tx_id))), ',') AS isoforms FROM (
    SELECT a.gene, a.tx_id, b.i - a.i + 1 AS n, string_agg(c.s || '-' || c.e, ',' ORDER BY c.i) AS chain FROM tx_sums a
    JOIN tx_sums b ON a.tx_id = b.tx_id AND b.i BETWEEN a.i AND a.i + 2 JOIN tx_sums c ON c.tx_id = a.tx_id AND c.i BETWEEN a.i AND b.i
    GROUP BY a.gene, a.tx_id, a.i, b.i) GROUP BY 1, 2, 3""", "tx_sums")


@query("splice_chains", using("chains", "SELECT * FROM chains"))
def _(spark, sf_dir):
    return iso.splice_chains(ex(spark, sf_dir), 3).withColumn("isoforms", F.concat_ws(",", "isoforms"))


cte("spliced", """SELECT x.gene, x.tx_id, any_value(x.strand) AS strand, string_agg(substr(t.seq, x.s, x.e - x.s), '' ORDER BY x.s) AS seq
  FROM tx_splices x JOIN transcripts t ON t.gene = x.gene GROUP BY 1, 2""", "tx_splices", "transcripts", keep=True)
cte("walk", """SELECT w.gene, w.tx_id, o, g, a.s + o - a.p AS start, b.s + o + 40 - b.p AS "end", c.i AS t1, d.i AS t2 FROM
    (SELECT * FROM (SELECT gene, tx_id, o, len, CAST(sum(CASE WHEN b = CASE strand WHEN -1 THEN 'C' ELSE 'G' END THEN 1 ELSE 0 END)
        OVER (PARTITION BY tx_id ORDER BY o ROWS BETWEEN CURRENT ROW AND 39 FOLLOWING) AS BIGINT) AS g
      FROM (SELECT gene, tx_id, strand, length(seq) AS len, unnest(string_split(seq, '')) AS b, generate_subscripts(string_split(seq, ''), 1) - 1 AS o FROM spliced))
     WHERE o >= 1 AND o < len - 40) w
    ASOF JOIN tx_sums a ON a.gene = w.gene AND a.tx_id = w.tx_id AND w.o >= a.p
    ASOF JOIN tx_sums b ON b.gene = w.gene AND b.tx_id = w.tx_id AND w.o + 40 >= b.p
    ASOF JOIN tx_sums c ON c.gene = w.gene AND c.tx_id = w.tx_id AND w.o + 10 >= c.p
    ASOF JOIN tx_sums d ON d.gene = w.gene AND d.tx_id = w.tx_id AND w.o + 30 >= d.p""", "spliced", "tx_sums", keep=True)
cte("walk_chain", """SELECT x.tx_id, x.t1, x.t2, string_agg(c.s || '-' || c.e, ',' ORDER BY c.i) AS chain FROM (SELECT DISTINCT tx_id, t1, t2 FROM walk) x
    JOIN tx_sums c ON c.tx_id = x.tx_id AND c.i BETWEEN x.t1 AND x.t2 GROUP BY 1, 2, 3""", "walk", "tx_sums")
cte("walk_iso", """SELECT a.gene, a.chain, array_to_string(list_sort(list_distinct(list(b.tx_id))), ',') AS target_isoforms FROM
    (SELECT DISTINCT split_part(tx_id, '_', 1) AS gene, chain FROM walk_chain) a
    JOIN (SELECT gene, tx_id, ',' || string_agg(s || '-' || e, ',' ORDER BY i) || ',' AS whole FROM tx_sums GROUP BY 1, 2) b
    ON a.gene = b.gene AND contains(b.whole, ',' || a.chain || ',') GROUP BY 1, 2""", "walk_chain", "tx_sums")


cte("walk_named", "SELECT c.tx_id, c.t1, c.t2, i.target_isoforms FROM walk_chain c JOIN walk_iso i ON i.gene = split_part(c.tx_id, '_', 1) AND i.chain = c.chain",
    "walk_chain", "walk_iso", keep=True)


@query("windows_spliced", using("walk walk_named", """SELECT w.gene, w.tx_id, target_isoforms, w.t2 - w.t1 + 1 AS n, count(*) AS windows, CAST(sum(start) AS BIGINT) AS start_total,
    CAST(sum("end") AS BIGINT) AS end_total, CAST(sum(g) AS BIGINT) AS g_total
  FROM walk w JOIN walk_named c ON c.tx_id = w.tx_id AND c.t1 = w.t1 AND c.t2 = w.t2 GROUP BY 1, 2, 3, 4"""))
def _(spark, sf_dir):
    e = ex(spark, sf_dir)
    w = iso.spliced_windows(loci(spark, sf_dir), e)
    return (w.groupBy("gene", "tx_id", F.concat_ws(",", "target_isoforms").alias("target_isoforms"), "n")
            .agg(F.count("*").alias("windows"), F.sum("start").alias("start_total"), F.sum("end").alias("end_total"),
                 F.sum(base_count("target", "G").cast("bigint")).alias("g_total")))


cte("unique_parts", """SELECT gene, tx_id, 'region' AS kind, min(s) AS a1, max(e) AS a2, CAST(NULL AS BIGINT) AS b1, CAST(NULL AS BIGINT) AS b2 FROM (
    SELECT *, sum(new) OVER (PARTITION BY tx_id ORDER BY s) AS island FROM (SELECT *, CASE WHEN s = lag(e) OVER (PARTITION BY tx_id ORDER BY s) THEN 0 ELSE 1 END AS new
      FROM (SELECT gene, s, e, min(tx_id) AS tx_id FROM tx_splices GROUP BY 1, 2, 3 HAVING count(*) = 1))) GROUP BY gene, tx_id, island
  UNION ALL SELECT gene, tx_id, 'junction', greatest(prev_start, i_start - 30), i_start, i_end, least(i_end + 30, next_end) FROM introns
    WHERE (gene, i_start, i_end) IN (SELECT (gene, i_start, i_end) FROM introns GROUP BY gene, i_start, i_end HAVING count(*) = 1)""", "tx_splices", "introns")
cte("unique_seqs", f"""SELECT id, gene, tx_id, kind, strand, a1, a2, b1, length(s) AS len, CASE strand WHEN -1 THEN {sql_revcomp('s')} ELSE s END AS seq FROM (
    SELECT concat(u.tx_id, kind, a1) AS id, u.gene, u.tx_id, kind, i.strand, a1, a2, b1, substr(t.seq, a1, a2 - a1) || CASE WHEN b1 IS NULL THEN '' ELSE substr(t.seq, b1, b2 - b1) END AS s
    FROM unique_parts u JOIN transcripts t ON t.gene = u.gene JOIN isoforms i ON i.tx_id = u.tx_id)""", "unique_parts", "transcripts", "isoforms", keep=True)
cte("unique_windows", sql_windows("SELECT id, len, seq FROM unique_seqs", "CAST(floor(len * 0.1::DOUBLE) AS BIGINT)", "len - CAST(floor(len * 0.1::DOUBLE) AS BIGINT) - 40", False), "unique_seqs", keep=True)


@query("windows_unique_regions", using("unique_windows unique_seqs", """SELECT gene, tx_id, kind, CAST(pos AS BIGINT) AS rna_pos,
    CAST(CASE WHEN f < a2 - a1 OR b1 IS NULL THEN a1 + f ELSE b1 + f - (a2 - a1) END AS BIGINT) AS pos, target, round(tm, 6) AS tm FROM (
    SELECT w.pos, w.target, w.tm, u.*, CASE strand WHEN -1 THEN u.len - 40 - w.pos ELSE w.pos END AS f FROM unique_windows w JOIN unique_seqs u USING (id)
    WHERE NOT contains(target, 'GGGGG') AND g_content BETWEEN 0.3 AND 0.7 AND tm_3 BETWEEN 50 AND 65 AND tm_5 BETWEEN 50 AND 65 AND abs(tm_5 - tm_3) <= 5)"""))
def _(spark, sf_dir):
    from strandforge.operators.filters import passing_target_strand
    w = passing_target_strand(iso.unique_region_windows(loci(spark, sf_dir), ex(spark, sf_dir)))
    return w.select("gene", "tx_id", "kind", "rna_pos", "pos", "target", r6("tm"))
