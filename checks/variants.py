"""Variants and allele-specific arms."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from strandforge.functions.sequence import flip_position, mutate
from strandforge.operators import variants as vr

from .inputs import sql_revcomp, sql_tm_of, tiles, transcripts, variants, variants_along, variants_apart
from .registry import cte, query, sql_of, using


def r2(x: str) -> str:
    return f"round({x}, 2)"


cte("v", """SELECT *, CASE WHEN alt = '-' THEN 'DEL' WHEN ref = '-' THEN 'INS' WHEN v_start = v_end THEN 'SNP' ELSE 'MNP' END AS kind,
    v_start - 50 AS g_start, substr(seq, v_start - 50, v_end - v_start + 101) AS local, 50 AS ls, v_end - v_start + 50 AS le FROM variants""", "variants", keep=True)


@query("variant_type", using("v", "SELECT doc_id, ref, alt, kind FROM v"))
def _(spark, sf_dir):
    return vr.with_type(variants(spark, sf_dir)).select("doc_id", "ref", "alt", "kind")


@query("mutate", using("variants", """SELECT doc_id, CASE WHEN ref = '-' THEN substr(seq, 1, v_end) || alt || substr(seq, v_end + 1)
    ELSE substr(seq, 1, v_start - 1) || CASE alt WHEN '-' THEN '' ELSE alt END || substr(seq, v_end + 1) END AS mutated FROM variants"""))
def _(spark, sf_dir):
    return variants(spark, sf_dir).select("doc_id", mutate("seq", F.col("v_start") - 1, "v_end", "ref", "alt").alias("mutated"))


@query("strand_flip_pos", using("variants", """SELECT doc_id, CASE strand WHEN 1 THEN v_start ELSE length(seq) - v_end - 1 END AS pos5, CASE strand WHEN 1 THEN v_end ELSE length(seq) - v_start - 1 END AS pos3 FROM variants"""))
def _(spark, sf_dir):
    n = F.length("seq").cast("bigint")
    return variants(spark, sf_dir).select("doc_id", flip_position("v_start", "v_end", n, "strand").alias("pos5"),
                                          flip_position("v_end", "v_start", n, "strand").alias("pos3"))


cte("junction_points", f"""SELECT doc_id, kind, strand, allele, CASE strand WHEN -1 THEN {sql_revcomp('text')} ELSE text END AS target,
    CAST(CASE strand WHEN 1 THEN p ELSE length(text) - p - 2 END AS BIGINT) AS pos5, CAST(CASE strand WHEN 1 THEN p + 1 ELSE length(text) - p - 1 END AS BIGINT) AS pos3,
    CAST(g_start + CASE strand WHEN 1 THEN b5 ELSE n - b3 - 1 END AS BIGINT) AS g_pos5, CAST(g_start + CASE strand WHEN 1 THEN b3 ELSE n - b5 - 1 END AS BIGINT) AS g_pos3,
    edit_kind, CAST(edit_offset AS BIGINT) AS edit_offset FROM (SELECT *, CASE kind WHEN 'DEL' THEN n_local ELSE length(text) END AS n FROM points_v)""", "points_v", keep=True)
cte("points_v", """SELECT doc_id, kind, strand, 'ref' AS allele, g_start, length(local) AS n_local, local AS text, p, p AS b5, p + 1 AS b3, CAST(NULL AS VARCHAR) AS edit_kind, 0 AS edit_offset
    FROM (SELECT *, unnest(CASE kind WHEN 'INS' THEN [ls] ELSE range(ls - 1, le + 1) END) AS p FROM v)
  UNION ALL SELECT doc_id, kind, strand, 'mut', g_start, length(local), substr(local, 1, ls) || substr(local, le + 2), ls - 1, ls - 1, le + 1, NULL, 0 FROM v WHERE kind = 'DEL'
  UNION ALL SELECT doc_id, kind, strand, 'mut', g_start, length(local), CASE kind WHEN 'INS' THEN substr(local, 1, ls) || alt || substr(local, ls + 1)
      ELSE substr(local, 1, ls) || alt || substr(local, le + 2) END, ls + i, ls, ls + 1, CASE kind WHEN 'INS' THEN 'INS' ELSE 'RPS' END, i
    FROM (SELECT *, unnest(range(0, length(alt) + 1)) AS i FROM v WHERE kind <> 'DEL')""", "v")


@query("variant_junctions", using("junction_points", "SELECT * FROM junction_points"))
def _(spark, sf_dir):
    j = vr.junctions(variants(spark, sf_dir))
    return j.select("doc_id", "kind", "strand", "allele", "target", "pos5", "pos3", "g_pos5", "g_pos3", "edit_kind", "edit_offset")


cte("arms5", f"SELECT *, {r2(sql_tm_of('s'))} AS tm FROM (SELECT *, substr(target, pos5 + 2 - k, k) AS s FROM (SELECT *, unnest(range(15, 26)) AS k FROM junction_points) WHERE k <= pos5 + 1)", "junction_points", keep=True)
cte("arms3", f"SELECT *, {r2(sql_tm_of('s'))} AS tm FROM (SELECT *, substr(target, pos3 + 1, k) AS s FROM (SELECT *, unnest(range(15, 26)) AS k FROM junction_points) WHERE pos3 + k <= length(target))", "junction_points", keep=True)
cte("grid", f"""SELECT a.doc_id, a.allele, a.pos5, CAST(a.k AS INTEGER) AS arm5_len, CAST(b.k AS INTEGER) AS arm3_len, a.tm AS tm5, b.tm AS tm3, {sql_revcomp('a.s')} AS bds5, {sql_revcomp('b.s')} AS bds3,
    {r2('abs(a.tm - b.tm) + abs(a.k - 20) + abs(b.k - 20)')} AS score FROM arms5 a JOIN arms3 b ON a.doc_id = b.doc_id AND a.allele = b.allele AND a.pos5 = b.pos5""", "arms5", "arms3", keep=True)


def grid(spark, sf_dir):
    return vr.arm_grid(vr.junctions(variants(spark, sf_dir)))


@query("arm_grid", using("grid", "SELECT * FROM grid"))
def _(spark, sf_dir):
    return grid(spark, sf_dir).select("doc_id", "allele", "pos5", "arm5_len", "arm3_len", "tm5", "tm3", "bds5", "bds3", "score")


@query("rank_arm_designs", using("grid", """SELECT doc_id, allele, pos5, arm5_len, arm3_len, score, CAST(row_number() OVER (PARTITION BY doc_id, allele, pos5 ORDER BY score, arm5_len, arm3_len) AS INTEGER) AS rank FROM grid"""))
def _(spark, sf_dir):
    point = ["doc_id", "allele", "pos5"]
    r = vr.rank_designs(vr.arm_grid(vr.junctions(variants(spark, sf_dir)), by=point), point)
    return r.select("doc_id", "allele", "pos5", "arm5_len", "arm3_len", "score", "rank")


cte("allele_heads", """SELECT doc_id, strand, allele, head, substr(seq, v_end + 1, 50) AS tail FROM (
    SELECT *, 'ref' AS allele, substr(seq, v_start - 50, v_end - v_start + 51) AS head FROM variants
    UNION ALL SELECT *, 'mut', CASE WHEN ref = '-' THEN substr(seq, v_start - 50, v_end - v_start + 51) ELSE substr(seq, v_start - 50, 50) END || CASE alt WHEN '-' THEN '' ELSE alt END FROM variants)""", "variants", keep=True)
cte("allele_arms", f"""SELECT doc_id, allele, strand, CASE strand WHEN -1 THEN l ELSE {sql_revcomp('r')} END AS plp_left, CASE strand WHEN -1 THEN r ELSE {sql_revcomp('l')} END AS plp_right,
    CASE strand WHEN -1 THEN {sql_revcomp('l')} ELSE r END AS read_l, CASE strand WHEN -1 THEN {sql_revcomp('r')} ELSE l END AS read_r,
    CASE strand WHEN -1 THEN {sql_revcomp('head || tail')} ELSE head || tail END AS coding_seq
  FROM (SELECT *, right(head, 20) AS l, left(tail, 20) AS r FROM allele_heads)""", "allele_heads", keep=True)


@query("allele_sites", using("allele_arms", f"""SELECT doc_id, allele, strand, plp_left, plp_right, plp_left || plp_right AS plp_bds, coding_seq, round({sql_tm_of('read_l')}, 6) AS plp_tm_left,
  round({sql_tm_of('read_r')}, 6) AS plp_tm_right, round({sql_tm_of('(plp_left || plp_right)')}, 6) AS plp_tm FROM allele_arms"""))
def _(spark, sf_dir):
    a = vr.allele_sites(variants(spark, sf_dir))
    return a.select("doc_id", "allele", "strand", "plp_left", "plp_right", "plp_bds", "coding_seq",
                    *[F.round(c, 6).alias(c) for c in ("plp_tm_left", "plp_tm_right", "plp_tm")])


cte("balance", f"""SELECT a.doc_id, a.k AS left_len, b.k AS right_len, a.tm AS tm_left, b.tm AS tm_right, row_number() OVER (PARTITION BY a.doc_id
    ORDER BY abs(a.tm - b.tm), abs(a.k - 20) + abs(b.k - 20), a.k, b.k) AS n FROM
  (SELECT *, {sql_tm_of('s')} AS tm FROM (SELECT doc_id, k, CASE strand WHEN -1 THEN {sql_revcomp('right(head, k)')} ELSE right(head, k) END AS s FROM (SELECT *, unnest(range(10, 31)) AS k FROM allele_heads WHERE allele = 'mut'))) a
  JOIN (SELECT *, {sql_tm_of('s')} AS tm FROM (SELECT doc_id, k, CASE strand WHEN -1 THEN {sql_revcomp('left(tail, k)')} ELSE left(tail, k) END AS s FROM (SELECT *, unnest(range(10, 31)) AS k FROM allele_heads WHERE allele = 'mut'))) b
  ON a.doc_id = b.doc_id WHERE a.tm BETWEEN 45 AND 65 AND b.tm BETWEEN 45 AND 65 AND abs(a.tm - b.tm) < 10""", "allele_heads")


@query("arm_balance", using("balance variants", """SELECT v.doc_id, CAST(left_len AS INTEGER) AS left_len, CAST(right_len AS INTEGER) AS right_len, round(tm_left, 6) AS tm_left, round(tm_right, 6) AS tm_right
  FROM variants v LEFT JOIN (SELECT * FROM balance WHERE n = 1) b USING (doc_id)"""))
def _(spark, sf_dir):
    b = vr.arm_balance(variants(spark, sf_dir))
    return b.select("doc_id", "left_len", "right_len", F.round("tm_left", 6).alias("tm_left"), F.round("tm_right", 6).alias("tm_right"))


# ---- the same operators on variants all along every text, edges and short texts included -----------

cte("v_along", """SELECT *, CASE WHEN alt = '-' THEN 'DEL' WHEN ref = '-' THEN 'INS' WHEN v_start = v_end THEN 'SNP' ELSE 'MNP' END AS kind,
    substr(seq, g_start, v_end + 50 - g_start + 1) AS local, v_start - g_start AS ls, v_end - g_start AS le
  FROM (SELECT *, greatest(v_start - 50, 1) AS g_start FROM variants_along)""", "variants_along", keep=True)
cte("allele_heads_along", """SELECT doc_id, strand, allele, head, substr(seq, v_end + 1, 50) AS tail FROM (
    SELECT *, 'ref' AS allele, substr(seq, f, v_end - f + 1) AS head FROM (SELECT *, greatest(v_start - 50, 1) AS f FROM variants_along)
    UNION ALL SELECT *, 'mut', CASE WHEN ref = '-' THEN substr(seq, f, v_end - f + 1) ELSE substr(seq, f, v_start - f) END || CASE alt WHEN '-' THEN '' ELSE alt END
      FROM (SELECT *, greatest(v_start - 50, 1) AS f FROM variants_along))""", "variants_along", keep=True)

_OWN = ("variants", "v", "points_v", "junction_points", "arms5", "arms3", "grid", "allele_heads", "allele_arms", "balance")


def along(sql: str) -> str:
    """``sql`` on the subqueries of the variants along whole texts; an arm is no longer than what is left of the text."""
    for side in ("head", "tail"):
        sql = sql.replace(f"{'right' if side == 'head' else 'left'}({side}, k) END AS s FROM (SELECT *, unnest(range(10, 31)) AS k FROM allele_heads WHERE allele = 'mut')",
                          f"{'right' if side == 'head' else 'left'}({side}, k) END AS s FROM (SELECT *, unnest(range(10, 31)) AS k FROM allele_heads WHERE allele = 'mut') WHERE k <= length({side})")
    return re.sub(rf"(?<!')\b({'|'.join(_OWN)})\b(?!')", r"\1_along", sql)


for _name in ("points_v", "junction_points", "arms5", "arms3", "grid", "allele_arms", "balance"):
    _body, _needs, _keep = sql_of(_name)
    cte(f"{_name}_along", along(_body), *map(along, _needs), keep=_keep)


def numbered(df):
    return df.withColumnRenamed("doc_id", "variant_no")


@query("variant_type_along", using("v_along", "SELECT doc_id AS variant_no, ref, alt, kind FROM v_along"))
def _(spark, sf_dir):
    return numbered(vr.with_type(variants_along(spark, sf_dir)).select("doc_id", "ref", "alt", "kind"))


@query("mutate_along", using("variants_along", """SELECT doc_id AS variant_no, CASE WHEN ref = '-' THEN substr(seq, 1, v_end) || alt || substr(seq, v_end + 1)
    ELSE substr(seq, 1, v_start - 1) || CASE alt WHEN '-' THEN '' ELSE alt END || substr(seq, v_end + 1) END AS mutated FROM variants_along"""))
def _(spark, sf_dir):
    # an insertion goes behind its base, as everywhere in this module
    first = F.when(F.col("ref") == "-", F.col("v_end")).otherwise(F.col("v_start") - 1)
    return numbered(variants_along(spark, sf_dir).select("doc_id", mutate("seq", first, "v_end", "ref", "alt").alias("mutated")))


@query("strand_flip_pos_along", using("variants_along", """SELECT doc_id AS variant_no, CASE strand WHEN 1 THEN v_start ELSE length(seq) - v_end - 1 END AS pos5,
    CASE strand WHEN 1 THEN v_end ELSE length(seq) - v_start - 1 END AS pos3 FROM variants_along"""))
def _(spark, sf_dir):
    n = F.length("seq").cast("bigint")
    return numbered(variants_along(spark, sf_dir).select("doc_id", flip_position("v_start", "v_end", n, "strand").alias("pos5"),
                                                         flip_position("v_end", "v_start", n, "strand").alias("pos3")))


@query("variant_junctions_along", using("junction_points_along", "SELECT doc_id AS variant_no, * EXCLUDE (doc_id) FROM junction_points_along"))
def _(spark, sf_dir):
    j = vr.junctions(variants_apart(spark, sf_dir), regions=transcripts(spark, sf_dir))
    return numbered(j.select("doc_id", "kind", "strand", "allele", "target", "pos5", "pos3", "g_pos5", "g_pos3", "edit_kind", "edit_offset"))


def points_along(spark, sf_dir):
    return vr.junctions(variants_apart(spark, sf_dir), regions=transcripts(spark, sf_dir)).select("doc_id", "allele", "target", "pos5", "pos3")


# all pairs are made and weighed; they come out as figures per point, a hundred times fewer rows
@query("arm_grid_along", using("grid_along", """SELECT doc_id AS variant_no, allele, pos5, count(*) AS n, sum(arm5_len) AS n5, sum(arm3_len) AS n3, max(bds5) AS bds5, max(bds3) AS bds3,
    max(tm5) AS tm5, max(tm3) AS tm3, CAST(sum(CAST(round(score * 100) AS BIGINT)) AS BIGINT) AS score FROM grid_along GROUP BY ALL"""))
def _(spark, sf_dir):
    f = vr.arm_figures(points_along(spark, sf_dir))
    return numbered(f.groupBy("doc_id", "allele", "pos5").agg(
        *[F.sum(c).alias(c) for c in ("n", "n5", "n3")], *[F.max(c).alias(c) for c in ("bds5", "bds3", "tm5", "tm3")], F.sum("score").alias("score")))


@query("rank_arm_designs_along", using("grid_along", """SELECT doc_id AS variant_no, allele, pos5, arm5_len, arm3_len, score,
    CAST(row_number() OVER (PARTITION BY doc_id, allele, pos5 ORDER BY score, arm5_len, arm3_len) AS INTEGER) AS rank FROM grid_along QUALIFY rank <= 3"""))
def _(spark, sf_dir):
    r = vr.rank_designs(vr.arm_grid(points_along(spark, sf_dir), best=3), ["doc_id", "allele", "pos5"]).filter("rank <= 3")
    return numbered(r.select("doc_id", "allele", "pos5", "arm5_len", "arm3_len", "score", "rank"))


@query("allele_sites_along", using("allele_arms_along", f"""SELECT doc_id AS variant_no, allele, strand, plp_left, plp_right, plp_left || plp_right AS plp_bds, coding_seq,
    round({sql_tm_of('read_l')}, 6) AS plp_tm_left, round({sql_tm_of('read_r')}, 6) AS plp_tm_right, round({sql_tm_of('(plp_left || plp_right)')}, 6) AS plp_tm FROM allele_arms_along"""))
def _(spark, sf_dir):
    a = vr.allele_sites(variants_apart(spark, sf_dir), regions=transcripts(spark, sf_dir))
    return numbered(a.select("doc_id", "allele", "strand", "plp_left", "plp_right", "plp_bds", "coding_seq",
                             *[F.round(c, 6).alias(c) for c in ("plp_tm_left", "plp_tm_right", "plp_tm")]))


@query("arm_balance_along", using("balance_along variants_along", """SELECT v.doc_id AS variant_no, CAST(left_len AS INTEGER) AS left_len, CAST(right_len AS INTEGER) AS right_len,
    round(tm_left, 6) AS tm_left, round(tm_right, 6) AS tm_right FROM variants_along v LEFT JOIN (SELECT * FROM balance_along WHERE n = 1) b USING (doc_id)"""))
def _(spark, sf_dir):
    b = vr.arm_balance(variants_apart(spark, sf_dir), regions=transcripts(spark, sf_dir))
    return numbered(b.select("doc_id", "left_len", "right_len", F.round("tm_left", 6).alias("tm_left"), F.round("tm_right", 6).alias("tm_right")))


@query("ilock_arms", using("tiles", f"""SELECT doc_id, tile_no, {r2(sql_tm_of('target'))} AS ilock_tm, {r2(sql_tm_of('substr(target, 2, 20)'))} AS ilock_tm5, {r2(sql_tm_of('substr(target, 21, 20)'))} AS ilock_tm3,
  {sql_revcomp('target')} AS ilock_bds, {sql_revcomp('substr(target, 2, 20)')} AS ilock_bds5, {sql_revcomp('substr(target, 21, 20)')} AS ilock_bds3 FROM tiles"""))
def _(spark, sf_dir):
    t = tiles(spark, sf_dir).select("doc_id", "tile_no", "target")
    return vr.ilock_arms(t, "target", F.lit(20)).drop("target")
