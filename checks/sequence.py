"""Scalar sequence functions over whole transcripts or their 40-base tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandforge.functions import genes, probes, sequence as sq, thermo

from .inputs import bases_of, listed, sql_revcomp, sql_tm_of, table, tiles, transcripts
from .registry import cte, query, using
from .windows import r6


def t40(spark, sf_dir):
    return tiles(spark, sf_dir).select("doc_id", "tile_no", "target")


def probe40(spark, sf_dir):
    return t40(spark, sf_dir).withColumn("probe", sq.revcomp("target"))


cte("probes40", f"SELECT doc_id, tile_no, target, {sql_revcomp('target')} AS probe FROM tiles", "tiles")


@query("revcomp", using("transcripts", f"SELECT doc_id, {sql_revcomp('seq')} AS minus, FALSE AS bad FROM transcripts"))
def _(spark, sf_dir):
    return transcripts(spark, sf_dir).select("doc_id", sq.revcomp("seq").alias("minus"), sq.has_bad_letters("seq").alias("bad"))


@query("g_content", using("tiles", """SELECT doc_id, tile_no, round(length(replace(target, 'C', 'CC')) / 40.0::DOUBLE - 1, 6) AS c,
  round((40 - length(replace(target, 'G', ''))) / 40.0::DOUBLE, 6) AS g FROM tiles"""))
def _(spark, sf_dir):
    return t40(spark, sf_dir).select("doc_id", "tile_no", F.round(sq.base_count("target", "C") / 40.0, 6).alias("c"),
                                     F.round(sq.g_content("target"), 6).alias("g"))


@query("homopolymer_g", using("probes40", """SELECT doc_id, tile_no, contains(substr(probe, 21) || substr(probe, 1, 20), 'GGGG') AS run4,
  contains(target, 'GGGGG') AS run5 FROM probes40"""))
def _(spark, sf_dir):
    full = sq.arms("probe", 40)[2]
    return probe40(spark, sf_dir).select("doc_id", "tile_no", sq.has_run(full, "G", 4).alias("run4"),
                                         sq.has_run("target", "G", 5).alias("run5"))


@query("arms", using("probes40", """SELECT doc_id, tile_no, left(probe, 20) AS arm_3prime, substr(probe, 21) AS arm_5prime,
  substr(probe, 21) || left(probe, 20) AS full_sequence FROM probes40"""))
def _(spark, sf_dir):
    a3, a5, full = sq.arms("probe", 40)
    return probe40(spark, sf_dir).select("doc_id", "tile_no", a3.alias("arm_3prime"), a5.alias("arm_5prime"), full.alias("full_sequence"))


@query("tm_nn", using("probes40", f"SELECT doc_id, tile_no, round({sql_tm_of('probe')}, 6) AS tm FROM probes40"))
def _(spark, sf_dir):
    return probe40(spark, sf_dir).select("doc_id", "tile_no", sq.rounded(thermo.tm_nn("probe"), 6).alias("tm"))


@query("tm_tables", using("probes40", "SELECT doc_id, tile_no, " + ", ".join(
    f"round({sql_tm_of('probe', t)}, 6) AS tm_{t.lower()}" for t in thermo.TABLES) + " FROM probes40"))
def _(spark, sf_dir):
    pairs = [("DNA", "RNA"), ("RNA", "RNA"), ("DNA", "DNA")]
    return probe40(spark, sf_dir).select("doc_id", "tile_no", *[
        sq.rounded(thermo.tm_nn("probe", thermo.table_for(a, b)), 6).alias(f"tm_{a}_{b}".lower()) for a, b in pairs])


@query("gene_case", """SELECT p_partkey, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS mouse, upper(p_name) AS human, p_name AS other FROM part""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", *[sq.format_gene("p_name", o).alias(o) for o in ("mouse", "human", "other")])


_NAMES = "SELECT o_orderkey, concat('g', o_custkey, CASE WHEN o_orderstatus = 'O' THEN '' ELSE concat('-', o_orderkey) END) AS gene_name FROM orders"
_WITH_FULL = "SELECT gene_name FROM listed UNION ALL SELECT concat('G', o_custkey, '-', o_orderkey) FROM orders WHERE o_orderpriority = '1-URGENT'"


@query("gene_base_name", using("listed", f"""SELECT o_orderkey, n.gene_name,
    CASE WHEN base <> '' AND upper(base) IN (SELECT upper(gene_name) FROM ({_WITH_FULL})) THEN base ELSE n.gene_name END AS new_rule,
    CASE WHEN base <> '' AND (upper(base) IN (SELECT upper(gene_name) FROM ({_WITH_FULL})) OR upper(n.gene_name) IN (SELECT upper(gene_name) FROM ({_WITH_FULL})))
      THEN base ELSE n.gene_name END AS old_rule
  FROM (SELECT *, regexp_extract(gene_name, '^(.+)-(\\d+)$', 1) AS base FROM ({_NAMES})) n"""))
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    names = orders.selectExpr("o_orderkey", "concat('g', o_custkey, CASE WHEN o_orderstatus = 'O' THEN '' ELSE concat('-', o_orderkey) END) AS gene_name")
    full = orders.filter("o_orderpriority = '1-URGENT'").selectExpr("concat('G', o_custkey, '-', o_orderkey) AS gene_name")
    known = listed(spark, sf_dir).select("gene_name").unionByName(full)
    rows = genes.with_base_name(names, known, out="new_rule")
    return genes.with_base_name(rows, known, out="old_rule", strip_when_full_listed=True)


def neighbours(spark, sf_dir):
    """Each tile next to the one that follows it in the same transcript; paired inside the row."""
    parts = F.regexp_extract_all("seq", F.lit("[ACGT]{40}"), F.lit(0))
    pairs = F.zip_with(F.col("p"), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return (transcripts(spark, sf_dir).withColumn("p", parts).select("doc_id", F.posexplode(pairs).alias("tile_no", "x"))
            .filter("x.b IS NOT NULL").select("doc_id", F.col("tile_no").cast("bigint").alias("tile_no"), "x.a", "x.b"))


cte("neighbours", "SELECT x.doc_id, x.tile_no, x.target AS a, y.target AS b FROM tiles x JOIN tiles y ON x.doc_id = y.doc_id AND y.tile_no = x.tile_no + 1", "tiles")


@query("hamming", using("neighbours", """SELECT doc_id, tile_no, CAST(hamming(a, b) AS BIGINT) AS same_case, CAST(hamming(a, b) AS BIGINT) AS any_case,
  CAST(-1 AS BIGINT) AS unequal, CAST(NULL AS BIGINT) AS unequal_old FROM neighbours"""))
def _(spark, sf_dir):
    n = neighbours(spark, sf_dir)
    return n.select("doc_id", "tile_no", sq.hamming("a", "b").cast("bigint").alias("same_case"),
                    sq.hamming(F.lower("a"), "b", ignore_case=True).cast("bigint").alias("any_case"),
                    sq.hamming("a", F.left("b", F.lit(39)), ignore_case=True, unequal=-1).cast("bigint").alias("unequal"),
                    sq.hamming("a", F.left("b", F.lit(39))).cast("bigint").alias("unequal_old"))


@query("suffix_prefix_overlap", using("neighbours", """SELECT doc_id, tile_no, CAST(coalesce(list_max(list_filter(range(1, 41),
  lambda i: right(a, CAST(i AS BIGINT)) = left(b, CAST(i AS BIGINT)))), 0) AS BIGINT) AS overlap FROM neighbours"""))
def _(spark, sf_dir):
    return neighbours(spark, sf_dir).select("doc_id", "tile_no", sq.suffix_prefix_overlap("a", "b").cast("bigint").alias("overlap"))


@query("blast_core", using("probes40", "SELECT doc_id, tile_no, substr(probe, 5, 32) AS core FROM probes40"))
def _(spark, sf_dir):
    return probe40(spark, sf_dir).select("doc_id", "tile_no", sq.middle("probe").alias("core"))


def quality_probes(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id").select("doc_id", F.regexp_replace("text", "[^A-Za-z]", "").alias("letters"))
    raw = raw.select("doc_id", F.posexplode(F.regexp_extract_all("letters", F.lit("[A-Za-z]{60}"), F.lit(0))).alias("no", "probe"))
    out = raw.select("doc_id", F.lit(60).cast("bigint").alias("width"), F.col("no").cast("bigint").alias("no"), "probe")
    for w in (40, 220):
        out = out.unionByName(tiles(spark, sf_dir, w).select("doc_id", F.lit(w).cast("bigint").alias("width"),
                                                             F.col("tile_no").alias("no"), F.col("target").alias("probe")))
    return out


def _cut(src: str, width: int) -> str:
    return f"""SELECT doc_id, CAST({width} AS BIGINT) AS width, CAST(t AS BIGINT) AS no, substr(seq, CAST(t * {width} + 1 AS BIGINT), {width}) AS probe
      FROM {src}, LATERAL (SELECT unnest(range(0, length(seq) // {width})) AS t)"""


_RAW = "(SELECT doc_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM documents)"
cte("quality_probes", f"{_cut(_RAW, 60)} UNION ALL {_cut('transcripts', 40)} UNION ALL {_cut('transcripts', 220)}", "transcripts")
_GC = "((length(probe) - length(regexp_replace(upper(probe), '[GC]', '', 'g'))) / CAST(length(probe) AS DOUBLE))"
_REPEAT = ("len(list_filter(range(1, length(probe) - 6), lambda i: instr(substr(probe, CAST(i + 8 AS BIGINT)), "
           "substr(probe, CAST(i AS BIGINT), 8)) > 0)) > 0")
cte("quality", f"""SELECT doc_id, width, no, concat_ws(';', CASE WHEN length(probe) < 50 THEN 'Probe sequence is short' END,
      CASE WHEN length(probe) > 200 THEN 'Probe sequence is long' END,
      CASE WHEN {_GC} < 0.3::DOUBLE OR {_GC} > 0.7::DOUBLE THEN 'Abnormal GC content: ' || printf('%.2f', {_GC}) END,
      CASE WHEN {_REPEAT} THEN 'Contains long repeats' END) AS warnings,
    CASE WHEN regexp_matches(upper(probe), '[^ATCGN]') THEN 'Invalid bases: ' || array_to_string(list_sort(list_distinct(
      string_split(regexp_replace(upper(probe), '[ATCGN]', '', 'g'), ''))), '') ELSE '' END AS errors
  FROM quality_probes""", "quality_probes")


@query("probe_quality", using("quality", "SELECT *, errors = '' AS is_valid FROM quality"))
def _(spark, sf_dir):
    return probes.with_quality(quality_probes(spark, sf_dir)).select(
        "doc_id", "width", "no", F.concat_ws(";", "warnings").alias("warnings"), F.concat_ws(";", "errors").alias("errors"), "is_valid")


@query("long_repeat", using("quality_probes", f"SELECT doc_id, width, no, {_REPEAT} AS repeats FROM quality_probes"))
def _(spark, sf_dir):
    return quality_probes(spark, sf_dir).select("doc_id", "width", "no", sq.has_long_repeat("probe").alias("repeats"))


@query("tandem_copy", using("tiles", f"SELECT doc_id, tile_no, repeat(upper({sql_revcomp('target')}), 3) AS product FROM tiles"))
def _(spark, sf_dir):
    return t40(spark, sf_dir).select("doc_id", "tile_no", sq.tandem_copies("target").alias("product"))


@query("strip_n", """SELECT doc_id, replace(text, 'N', '') AS kept FROM documents""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sq.strip_n("text").alias("kept"))


_STEM = f"""coalesce(list_max(list_filter(range(3, 19), lambda k: len(list_filter(range(1, 40 - 2 * k - 1), lambda i:
    instr(substr(target, CAST(i + k + 3 AS BIGINT)), {sql_revcomp('substr(target, CAST(i AS BIGINT), CAST(k AS BIGINT))')}) > 0)) > 0)), 0)"""


@query("hairpin_scan", using("tiles", f"SELECT doc_id, tile_no, CAST({_STEM} AS BIGINT) AS stem FROM tiles"))
def _(spark, sf_dir):
    return t40(spark, sf_dir).select("doc_id", "tile_no", sq.longest_stem("target").cast("bigint").alias("stem"))
