"""Window generators, thermal filters, spacing and per-gene statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandforge.functions.sequence import revcomp, rounded
from strandforge.operators import filters, ranking, stats
from strandforge.operators.filters import DEMO
from strandforge.plans.design import brute_force_sites
from strandforge.operators.spacing import selected_positions, spaced_selection
from strandforge.operators.windows import (windows_bruteforce, windows_junction, windows_random,
                                           windows_on_strand, windows_tiled)

from .inputs import add_spacing, sql_pass, sql_revcomp, sql_windows, table, tiles, transcripts
from .registry import cte, query, using


def r6(c: str):
    return rounded(c, 6).alias(c)


def all_windows(spark, sf_dir, **only) -> DataFrame:
    return windows_bruteforce(transcripts(spark, sf_dir), ["doc_id", "gene"], **only)


def passed(spark, sf_dir) -> DataFrame:
    return filters.passing(all_windows(spark, sf_dir, limits=DEMO), DEMO)


def sites(spark, sf_dir) -> DataFrame:
    found = brute_force_sites(transcripts(spark, sf_dir).select("doc_id", "seq"), DEMO, "doc_id")
    return found.select("doc_id", F.concat(F.lit("G"), F.col("doc_id").cast("string")).alias("gene"), F.col("position").alias("pos"),
                        "target", F.col("sequence").alias("probe"), "g_content", "tm", "tm_5", "tm_3")


@query("windows_bruteforce", using("windows", """SELECT id AS doc_id, count(*) AS windows, min(pos) AS first_pos, max(pos) AS last_pos,
  CAST(sum(g) AS BIGINT) AS g_total FROM windows GROUP BY 1"""))
def _(spark, sf_dir):
    w = all_windows(spark, sf_dir).withColumn("g", F.round(F.col("g_content") * 40).cast("bigint"))
    return w.groupBy("doc_id").agg(F.count("*").alias("windows"), F.min("pos").alias("first_pos"),
                                   F.max("pos").alias("last_pos"), F.sum("g").alias("g_total"))


@query("thermal_rolling", using("windows", """SELECT id AS doc_id, pos, round(g_content, 6) AS g_content, round(tm, 6) AS tm,
  round(tm_5, 6) AS tm_5, round(tm_3, 6) AS tm_3 FROM windows"""))
def _(spark, sf_dir):
    w = windows_bruteforce(transcripts(spark, sf_dir), ["doc_id"], target=False)
    return w.select("doc_id", "pos", r6("g_content"), r6("tm"), r6("tm_5"), r6("tm_3"))


@query("thermal_filter", using("windows", f"""SELECT failed, count(*) AS windows FROM (SELECT concat_ws(',',
    CASE WHEN NOT (g_content BETWEEN 0.3 AND 0.7) THEN 'g_content' END,
    CASE WHEN contains(substr(target, 21, 20) || substr(target, 1, 20), 'CCCC') THEN 'consecutive_g' END,
    CASE WHEN NOT (tm BETWEEN 50 AND 80) THEN 'tm_range' END,
    CASE WHEN NOT (tm_3 BETWEEN 50 AND 80) THEN 'tm_3prime_range' END,
    CASE WHEN NOT (tm_5 BETWEEN 50 AND 80) THEN 'tm_5prime_range' END,
    CASE WHEN abs(tm_5 - tm_3) > 10 THEN 'tm_diff' END) AS failed FROM windows) GROUP BY 1"""))
def _(spark, sf_dir):
    w = filters.with_failed_checks(all_windows(spark, sf_dir), DEMO)
    return w.groupBy(F.concat_ws(",", "failed_checks").alias("failed")).agg(F.count("*").alias("windows"))


@query("pre_align_filter", using("passed", """SELECT doc_id, pos, probe, round(g_content, 6) AS g_content, round(tm, 6) AS tm,
  round(tm_3, 6) AS tm_3, round(tm_5, 6) AS tm_5, round(abs(tm_5 - tm_3), 6) AS tm_diff FROM passed"""))
def _(spark, sf_dir):
    return passed(spark, sf_dir).select("doc_id", "pos", revcomp("target").alias("probe"), r6("g_content"), r6("tm"),
                                        r6("tm_3"), r6("tm_5"), r6("tm_diff"))


@query("filter_counts", using("windows", f"SELECT id AS doc_id, count(*) AS before, count(*) FILTER ({sql_pass()}) AS after FROM windows GROUP BY 1"))
def _(spark, sf_dir):
    return filters.filter_counts(filters.with_failed_checks(all_windows(spark, sf_dir), DEMO), "doc_id")


@query("spaced_selection", using("sites", "SELECT doc_id, pos, probe FROM sites"))
def _(spark, sf_dir):
    chosen = spaced_selection(passed(spark, sf_dir), "doc_id", "pos", DEMO.max_sites)
    return chosen.select("doc_id", "pos", revcomp("target").alias("probe"))


@query("brute_force_sites", using("sites transcripts", """SELECT s.gene, pos AS position, probe AS sequence, round(tm, 6) AS tm,
  CASE WHEN doc_id % 2 = 0 THEN 1000 + pos ELSE 1000 + length(seq) - pos - 40 END AS genomic_start,
  CASE WHEN doc_id % 2 = 0 THEN 1000 + pos ELSE 1000 + length(seq) - pos - 40 END + 40 AS genomic_end FROM sites s JOIN transcripts USING (doc_id)"""))
def _(spark, sf_dir):
    placed = transcripts(spark, sf_dir).selectExpr("gene", "seq", "CAST(1000 AS BIGINT) AS start", "1000 + CAST(length(seq) AS BIGINT) AS end",
                                                   "CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END AS strand")
    found = brute_force_sites(placed, DEMO)
    return found.select("gene", "position", "sequence", r6("tm"), "genomic_start", "genomic_end")


@query("site_stats", using("sites transcripts", """SELECT t.gene, count(s.pos) AS total_sites,
  round(coalesce(avg(g_content), 0), 10) AS avg_g_content, round(coalesce(avg(tm), 0), 6) AS avg_tm
  FROM transcripts t LEFT JOIN sites s ON s.doc_id = t.doc_id GROUP BY 1"""))
def _(spark, sf_dir):
    genes = transcripts(spark, sf_dir).select("gene")
    return stats.site_stats(sites(spark, sf_dir), genes).select("gene", "total_sites",
                                                                           F.round("avg_g_content", 10).alias("avg_g_content"), r6("avg_tm"))


@query("chunk_sequence", using("transcripts", """SELECT doc_id, CAST(t AS BIGINT) AS piece_no, substr(seq, CAST(t * 500 + 1 AS BIGINT), 539) AS piece
  FROM transcripts, LATERAL (SELECT unnest(range(0, (length(seq) + 499) // 500)) AS t) WHERE length(seq) > 0
  UNION ALL SELECT doc_id, 0, '' FROM transcripts WHERE seq = ''"""))
def _(spark, sf_dir):
    from strandforge.operators.windows import cut_pieces
    return cut_pieces(transcripts(spark, sf_dir).select("doc_id", "seq"), "seq", 39, 500).select(
        "doc_id", F.col("piece_no").cast("bigint").alias("piece_no"), "piece")


# junction windows need any start, not only the inner 80 %
cte("windows_any", sql_windows("SELECT doc_id AS id, length(seq) AS len, seq FROM transcripts", "0", "len - 39"), "transcripts", keep=True)
cte("junction", f"""SELECT * FROM (SELECT w.*, row_number() OVER (PARTITION BY id ORDER BY centre, pos) AS n FROM (
    SELECT DISTINCT id, centre, centre_no, greatest(centre - 100, 0) AS first, least(len - 40, centre + 100) AS last FROM (
      SELECT id, len, unnest([len // 3, 2 * len // 3]) AS centre, unnest([0, 1]) AS centre_no FROM (SELECT doc_id AS id, length(seq) AS len FROM transcripts)))
    c JOIN windows_any w USING (id) WHERE pos >= first AND pos < last AND (pos - first) % 5 = 0 AND {sql_pass()}) WHERE n <= 100""",
    "windows_any", "transcripts")


@query("windows_junction", using("junction", f"SELECT id AS doc_id, pos, {sql_revcomp('target')} AS probe, round(tm, 6) AS tm FROM junction"))
def _(spark, sf_dir):
    w = filters.passing(windows_junction(transcripts(spark, sf_dir), ["doc_id"]), DEMO)
    return ranking.first_per(w, ["doc_id"], ["ord"], DEMO.max_sites).select("doc_id", "pos", revcomp("target").alias("probe"), r6("tm"))


cte("tiled", f"""SELECT doc_id, CAST(t AS BIGINT) AS tile_no, st + t * 40 AS pos, substr(minus, CAST(st + t * 40 + 1 AS BIGINT), 40) AS binding FROM (
    SELECT doc_id, {sql_revcomp('seq')} AS minus, least(length(seq) // 40, 60) AS n, length(seq) // 2 - (least(length(seq) // 40, 60) * 40) // 2 AS st
    FROM transcripts), LATERAL (SELECT unnest(range(0, n)) AS t)""", "transcripts")


@query("windows_tiled", using("tiled", """SELECT doc_id, tile_no, CAST(pos AS BIGINT) AS pos, binding FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tile_no) AS n FROM tiled
    WHERE NOT contains(binding, 'GGGGG') AND (40 - length(replace(binding, 'G', ''))) / 40.0::DOUBLE BETWEEN 0.3 AND 0.7) WHERE n <= 30"""))
def _(spark, sf_dir):
    t = windows_tiled(transcripts(spark, sf_dir), ["doc_id"]).filter(filters.simple_g_test("binding"))
    return ranking.first_per(t, ["doc_id"], ["tile_no"], 30)


@query("windows_random")
def _(spark, sf_dir):
    return windows_random(transcripts(spark, sf_dir), ["doc_id"], 40, 5, seed=7)


cte("stranded", "SELECT doc_id, seq, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END AS strand FROM transcripts", "transcripts")
cte("windows_turned", sql_windows(f"SELECT doc_id AS id, length(seq) AS len, CASE strand WHEN 1 THEN seq ELSE {sql_revcomp('seq')} END AS seq, strand FROM stranded",
                                  "floor(len * 0.1::DOUBLE)", "len - floor(len * 0.1::DOUBLE) - 39", False), "stranded", keep=True)
_OLD = ("NOT contains(target, 'GGGGG') AND g_content BETWEEN 0.3 AND 0.7 AND tm_3 BETWEEN 50 AND 65 AND tm_5 BETWEEN 50 AND 65 "
        "AND abs(tm_5 - tm_3) <= 5")


@query("windows_on_strand", using("windows_turned stranded", f"""SELECT doc_id, strand, start, start + 40 AS "end", target, round(tm, 6) AS tm FROM (
    SELECT doc_id, s.strand, CAST(CASE s.strand WHEN 1 THEN w.pos ELSE w.len - 40 - w.pos END AS BIGINT) AS start, w.target, tm,
      CAST(floor(w.len * 0.1::DOUBLE) AS BIGINT) AS edge, w.len FROM windows_turned w JOIN stranded s ON s.doc_id = w.id WHERE {_OLD})
  WHERE start >= edge AND start < len - edge - 40"""))
def _(spark, sf_dir):
    seqs = transcripts(spark, sf_dir).withColumn("strand", F.expr("CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END"))
    w = filters.passing_target_strand(windows_on_strand(seqs, ["doc_id"]))
    return w.select("doc_id", "strand", "start", "end", "target", r6("tm"))


def old_windows(spark, sf_dir):
    return windows_bruteforce(transcripts(spark, sf_dir), ["doc_id", "gene"], probe_strand=False)


cte("passed_old", f"SELECT id AS doc_id, * FROM windows_old WHERE {_OLD}", "windows_old", keep=True)


@query("thermal_filter_old", using("passed_old", """SELECT doc_id, pos, target, round(tm, 2) AS tm, round(tm_5, 2) AS tm_5, round(tm_3, 2) AS tm_3 FROM passed_old"""))
def _(spark, sf_dir):
    w = filters.passing_target_strand(old_windows(spark, sf_dir))
    return w.select("doc_id", "pos", "target", *[F.round(c, 2).alias(c) for c in ("tm", "tm_5", "tm_3")])


@query("thermal_report", using("windows_old", f"""SELECT failed, count(*) AS windows, sum(CASE WHEN {_OLD} THEN 1 ELSE 0 END)::BIGINT AS wanted FROM (SELECT *, concat_ws(',',
    CASE WHEN contains(target, 'GGGGG') THEN 'G_condition' END,
    CASE WHEN NOT (g_content BETWEEN 0.3 AND 0.7) THEN 'G_pct_condition' END,
    CASE WHEN NOT (tm_3 BETWEEN 50 AND 65 AND tm_5 BETWEEN 50 AND 65) THEN 'Tm_condition' END,
    CASE WHEN abs(tm_5 - tm_3) > 5 THEN 'Tm_thre_condition' END) AS failed FROM windows_old) GROUP BY 1"""))
def _(spark, sf_dir):
    w = filters.target_strand_report(old_windows(spark, sf_dir))
    return (w.groupBy(F.concat_ws(",", F.map_keys("evaluation")).alias("failed"))
            .agg(F.count("*").alias("windows"), F.sum(F.col("wanted").cast("bigint")).alias("wanted")))


add_spacing("passed_old", "doc_id", "pos", 3, min_gap=40, keep_all=True)


@query("spaced_selection_old", using("passed_old_picked", "SELECT k AS doc_id, pos FROM passed_old_picked"))
def _(spark, sf_dir):
    w = filters.passing_target_strand(old_windows(spark, sf_dir))
    return selected_positions(w, "doc_id", "pos", 3, min_gap=40, keep_all=True)


@query("record_filter", """SELECT doc_id, concat('G', doc_id) AS gene, lang AS mol_type FROM documents
  WHERE lang = 'en' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def _(spark, sf_dir):
    recs = table(spark, sf_dir, "documents").selectExpr("doc_id", "concat('G', doc_id) AS gene", "CASE lang WHEN 'en' THEN 'mRNA' ELSE lang END AS mol_type")
    listed_genes = table(spark, sf_dir, "labels").filter("quality = 1").selectExpr("concat('G', doc_id) AS gene_name")
    return (filters.listed_messenger(recs, listed_genes)
            .select("doc_id", "gene", F.lit("en").alias("mol_type")))


@query("g_filter_simple", using("tiles", """SELECT doc_id, tile_no, target FROM tiles WHERE NOT contains(target, 'GGGGG')
  AND (40 - length(replace(target, 'G', ''))) / 40.0::DOUBLE BETWEEN 0.3 AND 0.7"""))
def _(spark, sf_dir):
    return tiles(spark, sf_dir).filter(filters.simple_g_test("target")).select("doc_id", "tile_no", "target")


# stand-in folding energies: known only for tiles with more than eight A
_MFE = "CASE WHEN 40 - length(replace(target, 'A', '')) > 8 THEN -0.5 * (40 - length(replace(target, 'G', ''))) END"


@query("free_energy_filter", using("tiles", f"SELECT doc_id, tile_no, CAST(mfe AS DOUBLE) AS mfe FROM (SELECT *, {_MFE} AS mfe FROM tiles) WHERE coalesce(mfe >= -6, TRUE)"))
def _(spark, sf_dir):
    t = tiles(spark, sf_dir)
    energies = t.selectExpr("doc_id", "tile_no", f"CAST({_MFE} AS DOUBLE) AS mfe").filter("mfe IS NOT NULL")
    return filters.passing_free_energy(t.select("doc_id", "tile_no"), energies, ["doc_id", "tile_no"], -6.0)


@query("threshold_check", """SELECT p_partkey, concat_ws(';', CASE WHEN p_size - 5 <= 0 THEN 'binding_site_length must be > 0' END,
    CASE WHEN p_partkey % 40 <= 0 THEN 'max_binding_sites must be > 0' END,
    CASE WHEN NOT (p_retailprice / 1500 BETWEEN 0 AND 1) THEN 'min_g_content must be between 0 and 1' END,
    CASE WHEN NOT (p_size / 40.0::DOUBLE BETWEEN 0 AND 1) THEN 'max_g_content must be between 0 and 1' END,
    CASE WHEN p_retailprice / 1500 >= p_size / 40.0::DOUBLE THEN 'min_g_content must be < max_g_content' END,
    CASE WHEN p_size + 20 >= 60 THEN 'min_tm must be < max_tm' END) AS errors FROM part""")
def _(spark, sf_dir):
    params = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_size - 5 AS length", "p_partkey % 40 AS max_sites", "p_retailprice / 1500 AS min_g",
        "p_size / 40.0D AS max_g", "p_size + 20 AS min_tm", "60 AS max_tm")
    return filters.threshold_errors(params).select("p_partkey", F.concat_ws(";", "errors").alias("errors"))


@query("top_n_per_gene", using("passed", "SELECT doc_id, pos, probe FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM passed) WHERE n <= 3"))
def _(spark, sf_dir):
    return ranking.first_per(passed(spark, sf_dir), ["doc_id"], ["pos"], 3).select("doc_id", "pos", revcomp("target").alias("probe"))


@query("first_per_gene", using("passed", "SELECT doc_id, min(pos) AS pos, arg_min(probe, pos) AS probe FROM passed GROUP BY 1"))
def _(spark, sf_dir):
    return ranking.first_per(passed(spark, sf_dir), ["doc_id"], ["pos"]).select("doc_id", "pos", revcomp("target").alias("probe"))


@query("middle_per_gene", using("passed", """SELECT doc_id, pos, probe FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n,
  count(*) OVER (PARTITION BY doc_id) AS c FROM passed) WHERE n = c // 2"""))
def _(spark, sf_dir):
    w = passed(spark, sf_dir).select("doc_id", "pos", "target")
    return ranking.middle_per(w, ["doc_id"], F.floor(F.col("pos") / 65536), ["pos"]).select("doc_id", "pos", revcomp("target").alias("probe"))


@query("candidate_counts", using("passed", "SELECT doc_id, gene, count(*) AS candidates FROM passed GROUP BY 1, 2"))
def _(spark, sf_dir):
    return stats.candidate_counts(passed(spark, sf_dir), "doc_id", "gene")


@query("run_stats", using("sites transcripts", """SELECT (SELECT count(DISTINCT gene) FROM transcripts) AS total_genes, count(*) AS total_binding_sites,
    count(DISTINCT doc_id) AS genes_with_sites, round(count(*) / CAST((SELECT count(DISTINCT gene) FROM transcripts) AS DOUBLE), 6) AS avg_sites_per_gene,
    round(avg(g_content), 8) AS avg_g_content, round(avg(tm), 6) AS avg_tm, min(g_content) AS min_g_content, max(g_content) AS max_g_content,
    round(min(tm), 6) AS min_tm, round(max(tm), 6) AS max_tm FROM sites"""))
def _(spark, sf_dir):
    s = stats.run_stats(sites(spark, sf_dir), transcripts(spark, sf_dir).select("gene"))
    return (s.withColumn("avg_g_content", F.round("avg_g_content", 8))
            .withColumns({c: F.round(c, 6) for c in ("avg_sites_per_gene", "avg_tm", "min_tm", "max_tm")}))
