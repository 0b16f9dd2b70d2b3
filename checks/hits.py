"""Hits, specificity, off-target search, merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.operators import hits as ht, merge, offtarget as ot, ranking, stats
from strandforge.operators.filters import DEMO
from strandforge.plans.design import screened_sites

from .inputs import hits, listed, sites_for_hits, sql_revcomp, table, transcripts
from .registry import cte, query, using
from .sources import run_rows
from .windows import passed, r6, sites

ORGANISMS = ["NATION_0", "NATION_1"]


def queries_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("site_no"))


@query("hit_summary", using("hits", """SELECT o_orderkey AS site_no, coalesce(min(evalue), CAST('inf' AS DOUBLE)) AS evalue, coalesce(max(identity), 0) AS identity, count(h.site_no) AS alignment_count
  FROM orders LEFT JOIN hits h ON h.site_no = o_orderkey GROUP BY 1"""))
def _(spark, sf_dir):
    return ht.hit_summary(hits(spark, sf_dir), "site_no", queries_of(spark, sf_dir))


@query("hit_report_old", using("hits", """SELECT o_orderkey AS site_no, count(h.site_no) AS align_num, string_agg(split_part(hit_id, '|', 4), '|' ORDER BY hit_no, hit_id, hit_def, frame) AS align_accession,
  string_agg(hit_def, '|' ORDER BY hit_no, hit_id, hit_def, frame) AS align_descrip, string_agg(CAST(frame AS VARCHAR), ',' ORDER BY hit_no, hit_id, hit_def, frame) AS plus_minus
  FROM orders LEFT JOIN hits h ON h.site_no = o_orderkey GROUP BY 1"""))
def _(spark, sf_dir):
    return ht.hit_report(hits(spark, sf_dir), "site_no", ["hit_no", "hit_id", "hit_def", "frame"], queries_of(spark, sf_dir))


@query("hit_score_gate", using("hits", "SELECT o_orderkey AS site_no, coalesce(max(score), 0) < 18 AS passed FROM orders LEFT JOIN hits h ON h.site_no = o_orderkey GROUP BY 1"))
def _(spark, sf_dir):
    return ht.score_gate(hits(spark, sf_dir), "site_no", queries_of(spark, sf_dir))


cte("numbered", "SELECT site_no, gene, concat(gene, '_', row_number() OVER (PARTITION BY gene ORDER BY site_no)) AS query_id FROM sites_for_hits", "sites_for_hits")


@query("sites_with_hits", using("numbered hits", """SELECT n.site_no, n.query_id, evalue, identity, alignment_count, alignment_count IS NOT NULL AS matched FROM numbered n
  LEFT JOIN (SELECT site_no, min(evalue) AS evalue, max(identity) AS identity, count(*) AS alignment_count FROM hits WHERE frame <> 0 GROUP BY 1) h USING (site_no)"""))
def _(spark, sf_dir):
    numbered = ht.numbered_sites(sites_for_hits(spark, sf_dir), F.floor(F.col("site_no") / 4096), ["site_no"])
    named = hits(spark, sf_dir).filter("frame <> 0").join(numbered.select("site_no", "query_id"), "site_no").drop("site_no")
    return ht.sites_with_hits(numbered, ht.hit_summary(named, "query_id")).drop("gene")


_ORG = " OR ".join(f"contains(lower(hit_def), '{o.lower()}')" for o in ORGANISMS)
cte("flags", f"""SELECT s.site_no, s.gene, count(*) AS target_hits, count(*) FILTER (NOT contains(lower(hit_def), lower(gene))) AS other,
    bool_or(contains(lower(hit_def), lower(gene)) AND CASE frame WHEN -1 THEN TRUE WHEN 1 THEN FALSE ELSE identity > 0.95 END) AS compl
  FROM hits h JOIN sites_for_hits s USING (site_no) WHERE {_ORG} GROUP BY 1, 2""", "hits", "sites_for_hits")


@query("specificity_filter", using("flags", "SELECT site_no, gene, target_hits FROM flags WHERE other = 0 AND compl"))
def _(spark, sf_dir):
    return ht.specificity(sites_for_hits(spark, sf_dir), hits(spark, sf_dir), "site_no", ORGANISMS)


_GENE2 = "concat('TX_', gene)"


@query("same_gene", using("hits sites_for_hits", f"""SELECT s.site_no, count(*) AS hits, count(*) FILTER (contains(lower(hit_def), lower(gene))) AS plain,
    count(*) FILTER (contains(lower(hit_def), lower({_GENE2})) OR len(list_filter(string_split(lower({_GENE2}), '_'), lambda p: contains(lower(hit_def), p))) > 0) AS parts
  FROM hits h JOIN sites_for_hits s USING (site_no) GROUP BY 1"""))
def _(spark, sf_dir):
    j = hits(spark, sf_dir).join(sites_for_hits(spark, sf_dir), "site_no")
    parts = F.concat(F.lit("TX_"), F.col("gene"))
    return j.groupBy("site_no").agg(F.count("*").alias("hits"), F.count_if(ht.same_gene(F.col("gene"), F.col("hit_def"))).alias("plain"),
                                    F.count_if(ht.same_gene(parts, F.col("hit_def"))).alias("parts"))


@query("complementary", using("hits", """SELECT site_no, count(*) FILTER (CASE frame WHEN -1 THEN TRUE WHEN 1 THEN FALSE ELSE identity > 0.95 END) AS compl FROM hits GROUP BY 1"""))
def _(spark, sf_dir):
    return hits(spark, sf_dir).groupBy("site_no").agg(F.count_if(ht.complementary(F.col("frame"), F.col("identity"))).alias("compl"))


cte("sieve_sites", """SELECT s.site_no, concat(gene, '-', s.site_no % 3) AS gene, CASE o_orderstatus WHEN 'P' THEN 'DNA' ELSE 'mRNA' END AS mol_type, n_name AS organism
  FROM sites_for_hits s JOIN orders ON o_orderkey = s.site_no JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""", "sites_for_hits")
cte("brand_list", "SELECT concat(b, '-', x) AS gene_name FROM (SELECT DISTINCT p_brand AS b FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#7')), (SELECT unnest([0, 1]) AS x) UNION ALL SELECT 'brand#99'")


def sieve_sites(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    place = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .selectExpr("o_orderkey AS site_no", "CASE o_orderstatus WHEN 'P' THEN 'DNA' ELSE 'mRNA' END AS mol_type", "n_name AS organism"))
    return sites_for_hits(spark, sf_dir).join(place, "site_no").withColumn(
        "gene", F.concat("gene", F.lit("-"), (F.col("site_no") % 3).cast("string")))


def brand_list(spark, sf_dir):
    b = table(spark, sf_dir, "part").filter("p_brand NOT IN ('Brand#3', 'Brand#7')").select("p_brand").distinct()
    names = (b.withColumn("x", F.explode(F.array(F.lit("0"), F.lit("1"))))
             .select(F.concat("p_brand", F.lit("-"), "x").alias("gene_name")))
    unknown = spark.createDataFrame([("brand#99",)], "gene_name STRING")
    return names.unionByName(unknown)



@query("wanted_sieve", using("sieve_sites brand_list hits", """SELECT site_no, gene, CASE WHEN upper(gene) NOT IN (SELECT upper(gene_name) FROM brand_list) THEN 'not in gene list'
    WHEN mol_type <> 'mRNA' THEN 'not mRNA' WHEN n IS NULL THEN 'not found' WHEN other THEN 'not specific' WHEN NOT minus THEN 'not plus/minus' ELSE 'wanted' END AS reason
  FROM sieve_sites LEFT JOIN (SELECT site_no, count(*) AS n, bool_or(contains(hit_def, sieve_sites.organism) AND NOT contains(hit_def, split_part(gene, '-', 1))) AS other,
    bool_or(frame = -1) AS minus FROM hits JOIN sieve_sites USING (site_no) GROUP BY 1) USING (site_no)"""))
def _(spark, sf_dir):
    s = ht.wanted_sieve(sieve_sites(spark, sf_dir), hits(spark, sf_dir), "site_no", brand_list(spark, sf_dir))
    return s.select("site_no", "gene", "reason")


@query("genes_to_search", using("sieve_sites brand_list", "SELECT gene_name FROM brand_list WHERE upper(gene_name) NOT IN (SELECT upper(gene) FROM sieve_sites)"))
def _(spark, sf_dir):
    return merge.missing_genes(brand_list(spark, sf_dir), sieve_sites(spark, sf_dir))


# every 40-base window of every transcript
cte("ref40", """SELECT gene, pos, substr(seq, pos + 1, 20) AS f, substr(seq, pos + 21, 20) AS b FROM (SELECT gene, seq, unnest(range(0, length(seq) - 39)) AS pos FROM transcripts WHERE length(seq) >= 40)""",
    "transcripts", keep=True)
cte("asked", f"""SELECT target, frame, left(x, 20) AS f, substr(x, 21) AS b FROM (SELECT DISTINCT target, -1 AS frame, target AS x FROM sites
  UNION ALL SELECT DISTINCT target, 1, {sql_revcomp('target')} FROM sites)""", "sites", keep=True)
cte("found", """SELECT target, gene, pos, frame, CAST(hamming(r.b, a.b) AS INTEGER) AS mismatches FROM ref40 r JOIN asked a ON r.f = a.f WHERE hamming(r.b, a.b) <= 1
  UNION ALL SELECT target, gene, pos, frame, CAST(hamming(r.f, a.f) AS INTEGER) FROM ref40 r JOIN asked a ON r.b = a.b WHERE hamming(r.f, a.f) = 1""", "ref40", "asked", keep=True)


@query("offtarget_hits", using("found", "SELECT *, round((40 - mismatches) / 40.0::DOUBLE, 6) AS identity, CAST(40 - 4 * mismatches AS DOUBLE) AS score FROM found"))
def _(spark, sf_dir):
    h = ot.offtarget_hits(sites(spark, sf_dir), transcripts(spark, sf_dir).select("gene", "seq"), "gene")
    return h.withColumn("identity", F.round("identity", 6))


@query("specific_by_search", using("found sites", """SELECT s.gene, s.pos, s.probe, CAST(a.n AS BIGINT) AS all_hits FROM sites s JOIN (SELECT target, count(*) AS n FROM found GROUP BY 1) a USING (target)
  JOIN (SELECT target, gene, count(*) AS n, bool_or(frame = -1) AS compl FROM found GROUP BY 1, 2) o ON o.target = s.target AND o.gene = s.gene WHERE compl AND o.n = a.n"""))
def _(spark, sf_dir):
    ref = transcripts(spark, sf_dir).select("gene", "seq")
    found = screened_sites(ref, DEMO, ref)
    return found.select("gene", F.col("position").alias("pos"), F.col("sequence").alias("probe"), "all_hits")


cte("run_rows", "SELECT p.*, t.source FROM passed p JOIN transcripts t USING (doc_id)", "passed", "transcripts")
cte("merged_runs", """SELECT probe, source, doc_id, gene, pos, g_content, tm FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY source, doc_id, pos) AS n FROM run_rows) WHERE n = 1""", "run_rows", keep=True)


def merged(spark, sf_dir):
    return merge.merge_runs(run_rows(spark, sf_dir), "probe", ["source", "doc_id", "pos"])


@query("merge_dedup", using("merged_runs", "SELECT probe, source, gene, pos FROM merged_runs ORDER BY gene, pos"))
def _(spark, sf_dir):
    return merge.sorted_result(merged(spark, sf_dir)).select("probe", "source", "gene", "pos")


@query("merge_dedup_old", using("run_rows", "SELECT probe, source, gene, pos FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY gene, pos) AS n FROM run_rows) WHERE n = 1 ORDER BY gene, pos"))
def _(spark, sf_dir):
    rows = merge.merge_runs(run_rows(spark, sf_dir), "probe", ["gene", "pos"])
    return merge.sorted_result(rows).select("probe", "source", "gene", "pos")


@query("merge_stats", using("merged_runs", """SELECT count(*) AS total_probes, count(DISTINCT gene) AS genes, round(count(*) / CAST(count(DISTINCT gene) AS DOUBLE), 6) AS probes_per_gene,
  round(avg(g_content), 8) AS avg_g_content, round(avg(tm), 6) AS avg_tm FROM merged_runs"""))
def _(spark, sf_dir):
    m = stats.merge_stats(merged(spark, sf_dir))
    return m.withColumns({"probes_per_gene": F.round("probes_per_gene", 6), "avg_g_content": F.round("avg_g_content", 8), "avg_tm": F.round("avg_tm", 6)})


@query("missing_genes", using("listed merged_runs", "SELECT row_no, gene_name FROM listed WHERE upper(gene_name) NOT IN (SELECT upper(gene) FROM merged_runs)"))
def _(spark, sf_dir):
    return merge.missing_genes(listed(spark, sf_dir), merged(spark, sf_dir).withColumn("gene", F.lower("gene")))


@query("distinct_genes", "SELECT p_brand AS gene, min(p_partkey) AS row_no FROM part GROUP BY 1")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene"), F.col("p_partkey").alias("row_no"))
    zero = rows.withColumn("gene", F.lit("0"))
    return ranking.distinct_genes(rows.unionByName(zero), "gene", "row_no")
