"""Inputs derived from the given tables, once for Spark and once as SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strandforge.functions import thermo
from strandforge.operators.filters import DEMO
from strandforge.session import cut_lineage

from .registry import cte

# Letter map from prose to bases.
FROM52 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
TO52 = "GCGTGCAGCTCGGCATCGGTACGCTA" * 2
L = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bases_of(c: str):
    return F.translate(F.regexp_replace(c, "[^A-Za-z]", ""), FROM52, TO52)


_STAGED: dict[tuple, tuple] = {}


def staged(name: str):
    """Write a derived input to the shared folder on its first use in a session; later uses read that table."""
    def wrap(build):
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _STAGED:
                rows = cut_lineage(build(spark, sf_dir), name)
                _STAGED[key] = (rows.scratch, rows.schema)
            path, schema = _STAGED[key]
            return spark.read.schema(schema).parquet(path)
        return get
    return wrap


@staged("transcripts")
def transcripts(spark, sf_dir) -> DataFrame:
    # one shuffle by document whatever the size: the given table may be a single file that cannot be split
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text").repartition("doc_id")
    return docs.select("doc_id", F.concat(F.lit("G"), F.col("doc_id").cast("string")).alias("gene"),
                       "source", bases_of("text").alias("seq"))


cte("transcripts", f"""SELECT doc_id, concat('G', doc_id) AS gene, source,
  translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), '{FROM52}', '{TO52}') AS seq FROM documents""", keep=True)


def tiles(spark, sf_dir, width: int = L) -> DataFrame:
    """Whole transcripts cut into consecutive windows of ``width`` bases; the rest at the end is shorter and unused."""
    return (transcripts(spark, sf_dir)
            .select("doc_id", "gene", F.posexplode(F.regexp_extract_all("seq", F.lit("[ACGT]{%d}" % width), F.lit(0)))
                    .alias("tile_no", "target"))
            .withColumn("tile_no", F.col("tile_no").cast("bigint")))


cte("tiles", """SELECT doc_id, gene, CAST(t AS BIGINT) AS tile_no, substr(seq, CAST(t * 40 + 1 AS BIGINT), 40) AS target
  FROM transcripts, LATERAL (SELECT unnest(range(0, length(seq) // 40)) AS t)""", "transcripts", keep=True)


@staged("exons")
def exons(spark, sf_dir) -> DataFrame:
    """Three isoforms per gene; exon slots every 200 bases of the locus."""
    loci = transcripts(spark, sf_dir).select("doc_id", "gene", F.floor(F.length("seq") / 200).cast("int").alias("slots"))
    return (loci.filter("slots > 0").select("doc_id", "gene", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("t"), "slots")
            .select("doc_id", "gene", "t", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("e"))
            .filter("(t + e + doc_id) % 4 <> 3")
            .selectExpr("doc_id", "gene", "concat(gene, '_', t) AS tx_id", "t AS tx_no",
                        "CAST(e*200 + 17*((t*e)%3) + 1 AS BIGINT) AS exon_start",
                        "CAST(e*200 + 17*((t*e)%3) + 1 + 90 + 10*((t+e)%4) AS BIGINT) AS exon_end",
                        "CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END AS strand"))


cte("exons", """SELECT doc_id, gene, concat(gene, '_', t) AS tx_id, t AS tx_no,
    CAST(e*200 + 17*((t*e)%3) + 1 AS BIGINT) AS exon_start,
    CAST(e*200 + 17*((t*e)%3) + 1 + 90 + 10*((t+e)%4) AS BIGINT) AS exon_end,
    CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END AS strand
  FROM (SELECT doc_id, gene, t, unnest(range(0, length(seq) // 200)) AS e
        FROM transcripts, (SELECT unnest(range(0, 3)) AS t))
  WHERE (t + e + doc_id) % 4 <> 3""", "transcripts", keep=True)


def hits(spark, sf_dir) -> DataFrame:
    li, su = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    na, pa = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part")
    return (li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(pa, F.col("l_partkey") == F.col("p_partkey"))
            .selectExpr("l_orderkey AS site_no", "CAST(l_linenumber AS BIGINT) AS hit_no",
                        "concat(n_name, ' ', p_brand, ' transcript ', CAST(l_partkey AS STRING)) AS hit_def",
                        "concat('gi|', l_partkey, '|ref|XM_', l_partkey, '|') AS hit_id",
                        "n_name AS organism", "p_brand AS hit_gene", "l_quantity AS score",
                        "round(1 - l_discount, 2) AS identity", "l_tax AS evalue",
                        "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS frame"))


cte("hits", """SELECT l_orderkey AS site_no, CAST(l_linenumber AS BIGINT) AS hit_no,
    concat(n_name, ' ', p_brand, ' transcript ', CAST(l_partkey AS VARCHAR)) AS hit_def,
    concat('gi|', l_partkey, '|ref|XM_', l_partkey, '|') AS hit_id,
    n_name AS organism, p_brand AS hit_gene, l_quantity AS score, round(1 - l_discount, 2) AS identity, l_tax AS evalue,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN -1 ELSE 0 END AS frame
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey""")


def sites_for_hits(spark, sf_dir) -> DataFrame:
    """One site per order; its gene is the brand of the smallest part on the order."""
    li, pa = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    first = li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("site_no"))
    return (orders.join(first, F.col("site_no") == F.col("l_orderkey")).join(pa.select("p_partkey", "p_brand"), "p_partkey")
            .select("site_no", F.col("p_brand").alias("gene")))


cte("sites_for_hits", """SELECT o_orderkey AS site_no, p_brand AS gene FROM orders
    JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = pk""")


def variants(spark, sf_dir) -> DataFrame:
    """One variant per gene of at least 400 bases: SNP, MNP of 3, insertion of 2, deletion of 2."""
    return (transcripts(spark, sf_dir).filter(F.length("seq") >= 400)
            .selectExpr("doc_id", "gene", "seq", "doc_id % 4 AS kind", "100 + doc_id % 200 AS st")
            .selectExpr("doc_id", "gene", "seq", "kind", "st AS v_start",
                        "CASE kind WHEN 1 THEN st + 2 WHEN 3 THEN st + 1 ELSE st END AS v_end",
                        "CASE WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END AS strand")
            .selectExpr("*", "CASE WHEN kind = 2 THEN '-' ELSE substring(seq, CAST(v_start AS INT), CAST(v_end - v_start + 1 AS INT)) END AS ref")
            .selectExpr("*", "CASE kind WHEN 3 THEN '-' WHEN 2 THEN substring(seq, CAST(v_start - 2 AS INT), 2) "
                             "ELSE translate(ref, 'ACGT', 'TGCA') END AS alt")
            .drop("kind"))


cte("variants", """SELECT doc_id, gene, seq, v_start, v_end, strand, ref,
    CASE kind WHEN 3 THEN '-' WHEN 2 THEN substr(seq, v_start - 2, 2) ELSE translate(ref, 'ACGT', 'TGCA') END AS alt
  FROM (SELECT *, CASE WHEN kind = 2 THEN '-' ELSE substr(seq, v_start, v_end - v_start + 1) END AS ref
  FROM (SELECT doc_id, gene, seq, kind, st AS v_start,
      CASE kind WHEN 1 THEN st + 2 WHEN 3 THEN st + 1 ELSE st END AS v_end,
      CASE WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END AS strand
    FROM (SELECT doc_id, gene, seq, doc_id % 4 AS kind, 100 + doc_id % 200 AS st FROM transcripts WHERE length(seq) >= 400)))""",
    "transcripts")


ALONG = 101


def variants_along(spark, sf_dir) -> DataFrame:
    """Variants all along every text: at its first base, every 101 bases from there and at its last base, kinds in turn; no text is too short.

    ``doc_id`` numbers the variant (text * 1000000 + number), so that plans keyed by it keep the variants of a text apart.
    """
    return (transcripts(spark, sf_dir).withColumn("n", F.length("seq").cast("bigint")).filter("n > 0")
            .select("doc_id", "gene", "seq", "n", F.explode(F.expr(f"sequence(0L, CAST(ceil((n - 1) / {ALONG}) AS BIGINT))")).alias("i"))
            .selectExpr("doc_id * 1000000 + i AS doc_id", "gene", "seq", "n", "(doc_id + i) % 4 AS kind", f"least(1 + i * {ALONG}, n) AS v_start",
                        "CASE WHEN (doc_id + i) % 3 = 0 THEN -1 ELSE 1 END AS strand")
            .selectExpr("*", "least(n, v_start + CASE kind WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END) AS v_end")
            .selectExpr("doc_id", "gene", "seq", "kind", "v_start", "v_end", "strand",
                        "CASE WHEN kind = 2 THEN '-' ELSE substring(seq, CAST(v_start AS INT), CAST(v_end - v_start + 1 AS INT)) END AS ref")
            .selectExpr("*", "CASE kind WHEN 3 THEN '-' WHEN 2 THEN substring(seq, CAST(greatest(v_start - 1, 1) AS INT), 2) "
                             "ELSE translate(ref, 'ACGT', 'TGCA') END AS alt")
            .drop("kind"))


def variants_apart(spark, sf_dir) -> DataFrame:
    """The same variants without the text, which is not copied to any of them: letters are cut while the places are listed."""
    rows = transcripts(spark, sf_dir).select("doc_id", "gene", "seq")
    schema = T.StructType([rows.schema["doc_id"], rows.schema["gene"], *T.StructType.fromDDL("v_start bigint, v_end bigint, strand int, ref string, alt string").fields])
    return rows.mapInArrow(_places(ALONG), schema)


def _places(step: int):
    """Kernel: the variants of each text, every ``step`` bases from its first base and at its last."""
    turned = str.maketrans("ACGT", "TGCA")

    def rest(x: int | None, n: int) -> int | None:
        return x if x is None else x % n if x >= 0 else -(-x % n)

    def run(batches):
        for rb in batches:
            owner, out = [], []
            for r, (doc, seq) in enumerate(zip(rb.column("doc_id").to_pylist(), rb.column("seq").to_pylist())):
                n = len(seq or "")
                for i in range(-(-(n - 1) // step) + 1 if n else 0):
                    no, s = None if doc is None else doc + i, min(1 + i * step, n)
                    kind = rest(no, 4)
                    e = min(n, s + {1: 2, 3: 1}.get(kind, 0))
                    ref = "-" if kind == 2 else seq[s - 1:e]
                    first = max(s - 1, 1)
                    alt = "-" if kind == 3 else seq[first - 1:first + 1] if kind == 2 else ref.translate(turned)
                    owner.append(r)
                    out.append((None if doc is None else doc * 1000000 + i, s, e, -1 if rest(no, 3) == 0 else 1, ref, alt))
            columns = zip(*out) if out else [()] * 6
            number, *others = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([number, rb.column("gene").take(pa.array(owner, pa.int64())), *others],
                                             names=["doc_id", "gene", "v_start", "v_end", "strand", "ref", "alt"])

    return run


cte("variants_along", f"""SELECT doc_id, gene, seq, v_start, v_end, strand, ref,
    CASE kind WHEN 3 THEN '-' WHEN 2 THEN substr(seq, greatest(v_start - 1, 1), 2) ELSE translate(ref, 'ACGT', 'TGCA') END AS alt
  FROM (SELECT *, CASE WHEN kind = 2 THEN '-' ELSE substr(seq, v_start, v_end - v_start + 1) END AS ref
  FROM (SELECT *, least(length(seq), v_start + CASE kind WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END) AS v_end
  FROM (SELECT doc_id * 1000000 + i AS doc_id, gene, seq, (doc_id + i) % 4 AS kind, least(1 + i * {ALONG}, length(seq)) AS v_start,
      CASE WHEN (doc_id + i) % 3 = 0 THEN -1 ELSE 1 END AS strand
    FROM (SELECT *, unnest(range(0, (length(seq) + {ALONG - 2}) // {ALONG} + 1)) AS i FROM transcripts WHERE length(seq) > 0))))""",
    "transcripts")


def codes(spark, sf_dir) -> DataFrame:
    """20-base codes: all consecutive 20-mers of the benchmark texts, in order."""
    return (table(spark, sf_dir, "benchmark")
            .select("item_id", F.posexplode(F.regexp_extract_all(bases_of("text"), F.lit("[ACGT]{20}"), F.lit(0)))
                    .alias("part_no", "code"))
            .select((F.col("item_id") * 100000 + F.col("part_no")).alias("code_no"), "code"))


cte("codes", f"""SELECT CAST(item_id * 100000 + t AS BIGINT) AS code_no, substr(seq, CAST(t * 20 + 1 AS BIGINT), 20) AS code
  FROM (SELECT item_id, translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), '{FROM52}', '{TO52}') AS seq FROM benchmark),
    LATERAL (SELECT unnest(range(0, length(seq) // 20)) AS t)""", keep=True)


def listed(spark, sf_dir) -> DataFrame:
    """The gene list: every gene and 20 that no table holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    top = docs.agg((F.max("doc_id") + 1).alias("n"))
    extra = top.select(F.explode(F.sequence(F.col("n"), F.col("n") + 19)).alias("doc_id"))
    return docs.unionByName(extra).select(F.col("doc_id").alias("row_no"),
                                          F.concat(F.lit("G"), F.col("doc_id").cast("string")).alias("gene_name"))


cte("listed", """SELECT doc_id AS row_no, concat('G', doc_id) AS gene_name FROM (SELECT doc_id FROM documents UNION ALL
  SELECT unnest(range(n, n + 20)) FROM (SELECT max(doc_id) + 1 AS n FROM documents))""")

# ---- SQL fragments for temperatures -------------------------------------------------------------

_STEPS = [a + b for a in "ACGT" for b in "ACGT"]


def sql_tm(h: str, s: str, n: str | int, table="DNA_RNA", at_ends: str | None = None) -> str:
    t = thermo.TABLES[table]
    plus_h = f" + {at_ends} * {t.end_at_h}" if at_ends and t.end_at_h else ""
    plus_s = f" + {at_ends} * {t.end_at_s}" if at_ends and t.end_at_s else ""
    return (f"((1000.0::DOUBLE * (CAST({t.init_h} - {h}{plus_h} AS DOUBLE) / 10.0::DOUBLE)) / "
            f"((CAST({t.init_s} - {s}{plus_s} AS DOUBLE) / 10.0::DOUBLE + CAST(({n}) - 1 AS DOUBLE) * ({thermo.salt_per_step()!r})::DOUBLE)"
            f" + ({thermo.strand_entropy()!r})::DOUBLE) - {thermo.KELVIN!r}::DOUBLE)")


def sql_steps(x: str, which: int, table="DNA_RNA") -> str:
    """Sum over the dinucleotides of the string expression ``x``; which = 0 for h, 1 for s."""
    keys = ", ".join(f"'{k}'" for k in _STEPS)
    vals = ", ".join(str(thermo.TABLES[table].steps[k][which]) for k in _STEPS)
    return (f"list_sum(list_transform(range(1, length({x})), lambda i: ([{vals}])[list_position([{keys}], "
            f"substr({x}, CAST(i AS BIGINT), 2))]))")


def sql_tm_of(x: str, table="DNA_RNA") -> str:
    ends = f"(CAST(left({x}, 1) IN ('A', 'T') AS INT) + CAST(right({x}, 1) IN ('A', 'T') AS INT))"
    return sql_tm(sql_steps(x, 0, table), sql_steps(x, 1, table), f"length({x})", table, ends)


def sql_revcomp(x: str) -> str:
    return f"reverse(translate({x}, 'ACGT', 'TGCA'))"


_COMP = {"A": "T", "C": "G", "G": "C", "T": "A"}


def _step_rows(probe_strand: bool) -> str:
    st = thermo.DNA_RNA
    return ", ".join(f"('{k}', {(st[_COMP[k[1]] + _COMP[k[0]]] if probe_strand else st[k])[0]}, "
                     f"{(st[_COMP[k[1]] + _COMP[k[0]]] if probe_strand else st[k])[1]})" for k in _STEPS)


def sql_windows(source: str, lo: str, hi: str, probe_strand: bool = True) -> str:
    """Window rows over ``source(id, len, seq)`` with pos in [lo, hi): id, pos, len, g, tm, tm_5, tm_3, target."""
    base = "C" if probe_strand else "G"
    seam = "lead(b, 39) OVER w || b" if probe_strand else "lead(b, 19) OVER w || lead(b, 20) OVER w"
    return f"""SELECT id, pos, z.len, CAST(g AS BIGINT) AS g, g / 40.0::DOUBLE AS g_content,
      {sql_tm('(ha + hb + hj)', '(sa + sb + sj)', 40)} AS tm, {sql_tm('ha', 'sa', 20)} AS tm_5, {sql_tm('hb', 'sb', 20)} AS tm_3,
      substr(z.seq, pos + 1, 40) AS target FROM (
      SELECT x.*, j.h AS hj, j.s AS sj FROM (
        SELECT id, len, pos, lo, hi, sum(CASE WHEN b = '{base}' THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN CURRENT ROW AND 39 FOLLOWING) AS g,
          sum(h) OVER (w ROWS BETWEEN CURRENT ROW AND 18 FOLLOWING) AS ha, sum(s) OVER (w ROWS BETWEEN CURRENT ROW AND 18 FOLLOWING) AS sa,
          sum(h) OVER (w ROWS BETWEEN 20 FOLLOWING AND 38 FOLLOWING) AS hb, sum(s) OVER (w ROWS BETWEEN 20 FOLLOWING AND 38 FOLLOWING) AS sb,
          {seam} AS seam
        FROM (SELECT q.*, n.h, n.s FROM (SELECT *, b || lead(b) OVER w AS d FROM (
              SELECT id, len, {lo} AS lo, {hi} AS hi, unnest(string_split(seq, '')) AS b,
                     generate_subscripts(string_split(seq, ''), 1) - 1 AS pos
              FROM ({source}) WHERE len >= 40) WINDOW w AS (PARTITION BY id ORDER BY pos)) q
          LEFT JOIN (VALUES {_step_rows(probe_strand)}) n(d, h, s) ON n.d = q.d)
        WINDOW w AS (PARTITION BY id ORDER BY pos)) x
      JOIN (VALUES {_step_rows(probe_strand)}) j(d, h, s) ON j.d = x.seam
      WHERE pos >= lo AND pos < hi) JOIN ({source}) z USING (id)"""


_EDGE = "CAST(floor(len * 0.1::DOUBLE) AS BIGINT)"
cte("windows", sql_windows("SELECT doc_id AS id, length(seq) AS len, seq FROM transcripts", _EDGE, f"len - {_EDGE} - 40"),
    "transcripts", keep=True)
cte("windows_old", sql_windows("SELECT doc_id AS id, length(seq) AS len, seq FROM transcripts", _EDGE, f"len - {_EDGE} - 40", False),
    "transcripts", keep=True)


def sql_pass(t=DEMO) -> str:
    return (f"g_content BETWEEN {t.min_g}::DOUBLE AND {t.max_g}::DOUBLE AND tm BETWEEN {t.min_tm} AND {t.max_tm} "
            f"AND tm_5 BETWEEN {t.min_tm} AND {t.max_tm} AND tm_3 BETWEEN {t.min_tm} AND {t.max_tm} "
            f"AND abs(tm_5 - tm_3) <= {t.max_tm_diff} "
            f"AND NOT contains(substr(target, 21, 20) || substr(target, 1, 20), '{'C' * (t.max_run + 1)}')")


cte("passed", f"SELECT id AS doc_id, concat('G', id) AS gene, *, {sql_revcomp('target')} AS probe FROM windows WHERE {sql_pass()}",
    "windows", keep=True)


def sql_spacing(src: str, key: str, pos: str, n: int, min_gap: int = 1, keep_all: bool = False) -> dict[str, str]:
    """Subqueries of the spacing search over ``src``; the last one, ``<src>_picked``, holds (key, pos)."""
    greedy = ("list_reduce(p, lambda a, x: CASE WHEN x - a.last >= {gap} THEN {{'n': a.n + 1, 'last': x}} ELSE a END, "
              "{{'n': CAST(0 AS BIGINT), 'last': CAST(-1000000000000 AS BIGINT)}}).n")
    few = "FALSE" if keep_all else f"len(p) <= {n}"
    limit = "TRUE" if keep_all else f"len(a) < {n}"
    return {
        f"{src}_arr": f"SELECT {key} AS k, list_sort(list_distinct(list(CAST({pos} AS BIGINT)))) AS p FROM {src} GROUP BY 1",
        f"{src}_gap": f"""SELECT k, p, CAST(0 AS BIGINT) AS lo, p[-1] - p[1] AS hi, CAST(-1 AS BIGINT) AS best FROM {src}_arr WHERE NOT ({few})
          UNION ALL SELECT k, p, CASE WHEN ok THEN mid + 1 ELSE lo END, CASE WHEN ok THEN hi ELSE mid - 1 END,
            CASE WHEN ok THEN mid ELSE best END FROM (
            SELECT *, (c >= {n} AND mid > {min_gap}) AS ok FROM (SELECT *, {greedy.format(gap='mid')} AS c
              FROM (SELECT *, (lo + hi) // 2 AS mid FROM {src}_gap WHERE lo <= hi)))""",
        f"{src}_picked": f"""SELECT k, unnest(p) AS pos FROM {src}_arr WHERE {few} UNION ALL
          SELECT k, unnest(CASE WHEN best < 0 THEN {'p' if keep_all else f'p[1:{n}]'} ELSE list_reduce(p, lambda a, x:
            CASE WHEN {limit} AND (len(a) = 0 OR x - a[-1] >= best) THEN list_append(a, x) ELSE a END, CAST([] AS BIGINT[])) END)
          FROM {src}_gap WHERE lo > hi""",
    }


def add_spacing(src: str, key: str, pos: str, n: int, **kw) -> None:
    last = src
    for name, body in sql_spacing(src, key, pos, n, **kw).items():
        cte(name, body, last, src, keep=not name.endswith("_gap"))
        last = name


add_spacing("passed", "doc_id", "pos", DEMO.max_sites)
cte("sites", "SELECT passed.* FROM passed JOIN passed_picked ON doc_id = k AND passed.pos = passed_picked.pos",
    "passed", "passed_picked", keep=True)
