"""Panels, codes and barcode libraries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.functions import probes as quality
from strandforge.functions.sequence import revcomp
from strandforge.operators import barcodes as bc, panels, ranking, stats
from strandforge.sources.fasta import fasta_lines

from .inputs import codes, listed, sql_revcomp, table, tiles, transcripts
from .registry import cte, query, using
from .sequence import quality_probes
from .sources import numbered_sites
from .windows import passed, r6, sites


def panel_sites(spark, sf_dir):
    return sites(spark, sf_dir).select("gene", "pos", F.col("probe").alias("binding"), "g_content", "tm")


def panel_genes(spark, sf_dir):
    return listed(spark, sf_dir).select(F.col("gene_name").alias("gene"), F.col("row_no").alias("gene_order"))


cte("gene_no", "SELECT gene_name AS gene, row_number() OVER (ORDER BY row_no) - 1 AS gene_no FROM listed", "listed")
cte("first_site", "SELECT gene, min(pos) AS pos, arg_min(probe, pos) AS binding, arg_min(g_content, pos) AS g_content, arg_min(tm, pos) AS tm FROM sites GROUP BY 1", "sites")
cte("prism", """SELECT concat('PRISM_', gene_no % 31 + 1) AS barcode_name, gene, lower(substr(binding, 21)) || upper('Barcode_' || lpad(CAST(gene_no % 31 + 1 AS VARCHAR), 2, '0')) || lower(left(binding, 20)) AS probe,
  binding, pos, g_content, tm FROM first_site JOIN gene_no USING (gene)""", "first_site", "gene_no")
_CODE3 = "'Barcode_' || lpad(CAST(gene_no % 369 + 1 AS VARCHAR), 3, '0')"
cte("sprint", f"""SELECT concat('SPRINTseq_', gene_no % 369 + 1) AS barcode_name, gene, binding || '{panels.PRIMER_LEFT}' || {_CODE3} || '{panels.PRIMER_RIGHT}' || {_CODE3} AS probe, binding, pos
  FROM first_site JOIN gene_no USING (gene)""", "first_site", "gene_no")


@query("panel_prism", using("prism", "SELECT barcode_name, gene, probe, binding, pos, round(g_content, 6) AS g_content, round(tm, 6) AS tm FROM prism"))
def _(spark, sf_dir):
    p = panels.assemble(panel_sites(spark, sf_dir), panel_genes(spark, sf_dir), "PRISM")
    return p.select("barcode_name", "gene", "probe", "binding", "pos", r6("g_content"), r6("tm"))


@query("panel_sprintseq", using("sprint", "SELECT * FROM sprint"))
def _(spark, sf_dir):
    p = panels.assemble(panel_sites(spark, sf_dir), panel_genes(spark, sf_dir), "SPRINTseq")
    return p.select("barcode_name", "gene", "probe", "binding", "pos")


@query("panel_custom", using("first_site", "SELECT gene, binding AS probe, binding, pos FROM first_site"))
def _(spark, sf_dir):
    return panels.assemble(panel_sites(spark, sf_dir), panel_genes(spark, sf_dir), "custom").select("gene", "probe", "binding", "pos")


@query("barcode_assign", using("gene_no", "SELECT gene, gene_no, concat('PRISM_', gene_no % 31 + 1) AS barcode_name FROM gene_no"))
def _(spark, sf_dir):
    numbered = panels.gene_numbers(panel_genes(spark, sf_dir), "gene_order")
    return panels.assign_barcodes(numbered, panels.default_barcodes(spark, "PRISM"), 31).select("gene", "gene_no", "barcode_name")


@query("default_barcodes", using("listed", f"""SELECT row_no, gene_name, '{panels.PRIMER_LEFT}' || c || '{panels.PRIMER_RIGHT}' || c AS barcode
  FROM (SELECT row_no, gene_name, 'Barcode_' || lpad(CAST(row_no % 369 + 1 AS VARCHAR), 3, '0') AS c FROM listed)"""))
def _(spark, sf_dir):
    b = panels.default_barcodes(spark, "SPRINTseq")
    return (listed(spark, sf_dir).withColumn("idx", F.col("row_no") % 369).join(b, "idx").select("row_no", "gene_name", "barcode"))


def ranked_codes(spark, sf_dir):
    """barcodes(idx, barcode): the codes in order, idx from 0."""
    r = ranking.ranked(codes(spark, sf_dir), [], F.floor(F.col("code_no") / 4096), ["code_no"], "n")
    return r.select((F.col("n") - 1).alias("idx"), F.col("code").alias("barcode"))


cte("ranked_codes", "SELECT row_number() OVER (ORDER BY code_no) - 1 AS idx, code AS barcode FROM codes", "codes")


@query("barcode_zip", using("first_site ranked_codes", """SELECT gene, probe_no, idx, lower(substr(binding, 21)) || upper(barcode) || lower(left(binding, 20)) AS probe FROM
  (SELECT *, row_number() OVER (ORDER BY CAST(substr(gene, 2) AS BIGINT)) - 1 AS probe_no FROM first_site) JOIN ranked_codes ON idx = probe_no + 5"""))
def _(spark, sf_dir):
    first = panels.first_sites(panel_sites(spark, sf_dir), ["pos"]).withColumn("g", F.expr("CAST(substring(gene, 2) AS BIGINT)"))
    n = ranking.ranked(first, [], F.floor(F.col("g") / 4096), ["g"], "n").withColumn("probe_no", F.col("n") - 1)
    z = panels.zip_barcodes(n, ranked_codes(spark, sf_dir), start=5)
    return panels.prism_probes(z).select("gene", "probe_no", "idx", "probe")


_SHORT = "CASE WHEN g_content > 0.44 THEN left(probe, 39) ELSE probe END"
cte("multi_sites", f"SELECT gene, doc_id, pos, {_SHORT} AS binding FROM sites", "sites")
cte("multi_codes", """SELECT gene FROM (SELECT gene, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM (SELECT DISTINCT gene, doc_id FROM multi_sites)) c
  JOIN ranked_codes r USING (idx)""", "multi_sites", "ranked_codes")
cte("multi", """SELECT concat('PRISM_', c.gene_no + 1) AS "PRISM", m.gene, concat_ws('_', 'PR', c.gene_no + 1, m.gene, n) AS probe_name,
    lower(substr(binding, 21)) || barcode || lower(left(binding, 20)) AS probe
  FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY pos) AS n FROM multi_sites WHERE length(binding) = 40) m
  JOIN (SELECT gene, row_number() OVER (ORDER BY doc_id) - 1 AS gene_no FROM (SELECT DISTINCT gene, doc_id FROM multi_sites)) c USING (gene)
  JOIN ranked_codes r ON r.idx = c.gene_no WHERE n <= 3""", "multi_sites", "ranked_codes")


def multi(spark, sf_dir):
    s = sites(spark, sf_dir).select("gene", "pos", F.expr(_SHORT).alias("binding"))
    return panels.multi_site_panel(s, panel_genes(spark, sf_dir), ranked_codes(spark, sf_dir))


@query("panel_multi", using("multi", "SELECT * FROM multi"))
def _(spark, sf_dir):
    return multi(spark, sf_dir)[0].select("PRISM", "gene", "probe_name", "probe")


@query("panel_multi_rejects", using("multi_codes multi_sites", """SELECT gene, pos, binding, 'length' AS reason FROM multi_sites WHERE length(binding) <> 40
  UNION ALL SELECT gene, pos, binding, 'no barcode' FROM multi_sites WHERE length(binding) = 40 AND gene NOT IN (SELECT gene FROM multi_codes)"""))
def _(spark, sf_dir):
    return multi(spark, sf_dir)[1].select("gene", "pos", "binding", "reason")


@query("write_probe_fasta", using("prism", "SELECT '>' || gene || '|' || barcode_name || chr(10) || probe AS value FROM prism"))
def _(spark, sf_dir):
    p = panels.assemble(panel_sites(spark, sf_dir), panel_genes(spark, sf_dir), "PRISM")
    return p.select(fasta_lines(F.concat_ws("|", "gene", "barcode_name"), "probe").alias("value"))


@query("panel_stats", using("prism", """SELECT count(*) AS total_probes, count(DISTINCT gene) AS unique_genes, round(avg(length(probe)), 6) AS avg_probe_length,
  round(avg(g_content), 8) AS avg_g_content, round(avg(tm), 6) AS avg_tm FROM prism"""))
def _(spark, sf_dir):
    p = stats.panel_stats(panels.assemble(panel_sites(spark, sf_dir), panel_genes(spark, sf_dir), "PRISM"))
    return p.withColumns({"avg_probe_length": F.round("avg_probe_length", 6), "avg_g_content": F.round("avg_g_content", 8), "avg_tm": F.round("avg_tm", 6)})


cte("neighbour_sites", "SELECT doc_id, site_no - 1 AS place, probe, count(*) OVER (PARTITION BY doc_id) AS n FROM numbered_sites", "numbered_sites", keep=True)
_OVER = "coalesce(list_max(list_filter(range(1, 41), lambda i: right({a}, CAST(i AS BIGINT)) = left({b}, CAST(i AS BIGINT)))), 0)"


@query("circular_neighbours", using("neighbour_sites", f"""SELECT a.doc_id, a.place, CAST(greatest({_OVER.format(a='a.probe', b='b.probe')}, {_OVER.format(a='b.probe', b='a.probe')}) AS BIGINT) AS degree
  FROM neighbour_sites a JOIN neighbour_sites b ON a.doc_id = b.doc_id AND b.place = (a.place + 1) % a.n"""))
def _(spark, sf_dir):
    s = numbered_sites(spark, sf_dir).select("doc_id", (F.col("site_no") - 1).alias("place"), F.col("probe").alias("binding"))
    return panels.circular_neighbours(s, "doc_id", "place").select("doc_id", "place", F.col("degree").cast("bigint").alias("degree"))


cte("probe_report", """SELECT doc_id, count(*) AS probes, bool_and(errors = '') AS is_valid, list_distinct(flatten(list(string_split(errors, ';')))) AS e,
    list_distinct(flatten(list(string_split(warnings, ';')))) AS w FROM quality GROUP BY 1""", "quality")


@query("probe_set_report", using("probe_report", """SELECT concat('G', doc_id) AS gene, probes, is_valid,
  array_to_string(list_sort(list_transform(list_filter(e, lambda x: x <> ''), lambda x: concat('G', doc_id, ': ', x))), ';') AS errors,
  array_to_string(list_sort(list_transform(list_filter(w, lambda x: x <> ''), lambda x: concat('G', doc_id, ': ', x))), ';') AS warnings FROM probe_report"""))
def _(spark, sf_dir):
    q = quality.with_quality(quality_probes(spark, sf_dir).withColumn("gene", F.concat(F.lit("G"), F.col("doc_id").cast("string"))))
    return panels.panel_report(q).withColumns({c: F.concat_ws(";", c) for c in ("errors", "warnings")})


@query("gene_coverage", using("passed", """SELECT count(*) AS total_genes, count(*) AS genes_with_probes, round(sum(n) / CAST(count(*) AS DOUBLE), 6) AS avg_probes_per_gene
  FROM (SELECT gene, count(*) AS n FROM passed GROUP BY 1)"""))
def _(spark, sf_dir):
    return panels.gene_coverage(passed(spark, sf_dir)).withColumn("avg_probes_per_gene", F.round("avg_probes_per_gene", 6))


@query("hamming_pairs", using("codes", """SELECT a.code AS code_a, b.code AS code_b, CAST(hamming(a.code, b.code) AS BIGINT) AS distance
  FROM (SELECT DISTINCT code FROM codes) a JOIN (SELECT DISTINCT code FROM codes) b ON a.code < b.code WHERE hamming(a.code, b.code) < 6"""))
def _(spark, sf_dir):
    return bc.hamming_pairs(codes(spark, sf_dir), 6)


@query("greedy_diverse_set", using("codes", """SELECT u.code_no, u.code FROM (SELECT unnest(list_reduce(list({'code_no': code_no, 'code': code} ORDER BY code_no), lambda a, x:
    CASE WHEN contains(x[1].code, 'GGGGG') OR len(list_filter(a, lambda k: hamming(k.code, x[1].code) < 10)) > 0 THEN a ELSE list_concat(a, x) END,
    CAST([] AS STRUCT(code_no BIGINT, code VARCHAR)[]))) AS u FROM codes)""".replace("list({'code_no': code_no, 'code': code} ORDER BY code_no)", "list([{'code_no': code_no, 'code': code}] ORDER BY code_no)")))
def _(spark, sf_dir):
    return bc.diverse_codes(codes(spark, sf_dir))


@query("random_codes")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code_no"))
    return bc.with_random_code(rows, "code_no", 20, seed=11)


def libraries(spark, sf_dir):
    """20-base codes of every transcript: each is one library."""
    return tiles(spark, sf_dir, 20).select(F.col("doc_id").alias("lib"), F.col("tile_no").alias("code_no"), F.col("target").alias("code"))


cte("slots", "SELECT row_number() OVER (ORDER BY o, g) - 1 AS slot, color, CAST(g AS INTEGER) AS grade, g / CAST(n AS DOUBLE) AS fraction FROM (SELECT o, color, n, unnest(range(0, n + 1)) AS g FROM (VALUES (0, 'Green', 2), (1, 'Red', 5), (2, 'Blue', 5), (3, 'Yellow', 5)) v(o, color, n))")
cte("seq_lib", """SELECT doc_id AS lib, substr(seq, slot * 20 + 1, 20) AS seq, color, grade, fraction FROM transcripts, slots WHERE length(seq) // 20 >= 21""", "transcripts", "slots", keep=True)
_FOUR = ["Green", "Red", "Blue", "Yellow"]
cte("product", "SELECT g.lib, " + ", ".join(f'{c[0].lower()}.grade AS "{c}", {c[0].lower()}.seq AS "{c}seq"' for c in _FOUR)
    + " FROM (SELECT * FROM seq_lib WHERE color = 'Green') g " + " ".join(
        f"JOIN (SELECT * FROM seq_lib WHERE color = '{c}') {c[0].lower()} ON {c[0].lower()}.lib = g.lib" for c in _FOUR[1:]), "seq_lib")


@query("seq_lib", using("seq_lib", "SELECT lib, seq, color, grade, round(fraction, 6) AS fraction FROM seq_lib"))
def _(spark, sf_dir):
    return bc.seq_lib(libraries(spark, sf_dir)).withColumn("fraction", F.round("fraction", 6))


@query("grade_product", using("product", 'SELECT lib, count(*) AS combinations, CAST(sum("Green" + 10 * "Red" + 100 * "Blue" + 1000 * "Yellow") AS BIGINT) AS grades FROM product GROUP BY 1'))
def _(spark, sf_dir):
    p = bc.grade_product(bc.seq_lib(libraries(spark, sf_dir)), _FOUR)
    return p.groupBy("lib").agg(F.count("*").alias("combinations"), F.sum(F.expr("Green + 10 * Red + 100 * Blue + 1000 * Yellow")).alias("grades"))


@query("barcode_lib", using("product", """SELECT lib, "Greenseq" || "Redseq" || "Blueseq" || "Yellowseq" AS barcode, "Green", "Red", "Blue", "Yellow", CAST("Red" + "Yellow" + "Blue" AS BIGINT) AS sum
  FROM product WHERE "Red" + "Yellow" + "Blue" = 5"""))
def _(spark, sf_dir):
    return bc.barcode_lib(bc.seq_lib(libraries(spark, sf_dir)), _FOUR).select("lib", "barcode", *_FOUR, "sum")


@query("seq_lookup", using("seq_lib", "SELECT o_orderkey, l.lib, l.color, l.grade, l.seq FROM orders JOIN seq_lib l ON l.lib = o_custkey AND l.color = CASE o_orderstatus WHEN 'F' THEN 'Red' ELSE 'Blue' END AND l.grade = o_orderkey % 6"))
def _(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS lib", "CASE o_orderstatus WHEN 'F' THEN 'Red' ELSE 'Blue' END AS color",
                                                       "CAST(o_orderkey % 6 AS INT) AS grade")
    return bc.code_lookup(wanted, bc.seq_lib(libraries(spark, sf_dir))).select("o_orderkey", "lib", "color", "grade", "seq")
