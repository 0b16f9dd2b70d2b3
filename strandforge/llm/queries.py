"""The dealt operators as queries over the whole given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import align, ann, decontaminate, jaccard, langid, line_dedup, packing, pii, sharding, suffix_dedup, toxicity, turn_trie, warc

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


def ranks_path() -> str:
    """Ranks of the vocabulary that byte_bpe_50k.json holds; its added tokens are read from that file beside them."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP4 = f"""WITH b AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
g AS (SELECT item_id, array_to_string(w[i:i + 12], ' ') AS gram, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
gi AS (SELECT DISTINCT item_id, gram, n FROM g), gd AS (SELECT DISTINCT gram, n FROM gi), sizes AS (SELECT DISTINCT n FROM gd),
d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT doc_id, i, dw.n, dw.gram FROM dw JOIN gd ON dw.gram = gd.gram AND dw.n = gd.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit JOIN gi USING (gram, n)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id"""


@query(_OP4)
def op4_decontamination(spark, sf_dir):
    told = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return told.select(
        "doc_id", c["n_words"].cast("bigint").alias("n_words"), F.size(c["hit_words"]).cast("bigint").alias("n_hit"),
        F.size(c["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(c["items"].cast("array<string>")), ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OP2 = f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
k AS MATERIALIZED (SELECT doc_id, i, line, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) <> max(doc_id)),
m AS (SELECT k.*, r.first IS NOT NULL AND r.first <> doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""


@query(_OP2)
def op2_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op5_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), ranks_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((('0x' || substr(sha1(h), i, 5))::BIGINT >> s) & 31 AS INTEGER) + 1, 1), ''
    ORDER BY i, s DESC) FROM range(1, 41, 5) a(i), range(0, 20, 5) b(s)) AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM p JOIN m USING (h)""")
def op9_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("payload")


@query()
def op8_jaccard(spark, sf_dir):
    told = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return told.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query()
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    told = toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return told.select("doc_id", toxicity.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                       (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query()
def op6_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = toxicity.held_out(F.col("doc_id"), 4, 2)
    told = langid.predict_language(docs, langid.train(docs.filter(~out)))
    return told.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query()
def op1_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query()
def op3_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find_spans(docs, pii.train(docs)).select("doc_id", *[f.name for f in pii.ADDED])


@query()
def op7_suffix_dedup(spark, sf_dir):
    told = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return told.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# CRC-32 of a text: a table of 256 remainders by rule, then one step per byte; ``crc_table`` is in scope as t
_CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS crc)"""
_CRC = """xor(list_reduce(list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda h: ('0x' || h)::BIGINT),
  lambda a, b: xor(a >> 8, t.crc[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"""
_OP13 = f"""WITH RECURSIVE {_CRC_TABLE},
d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
  CAST({_CRC.format("coalesce(text, '')")} AS BIGINT) AS text_crc32,
  CASE WHEN doc_id < 0 THEN 18446744073709551616::HUGEINT + doc_id ELSE coalesce(doc_id, 0)::HUGEINT END AS key FROM documents, crc_table t),
drawn AS (SELECT row, (key * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS key, 0::BIGINT AS b, 0::BIGINT AS grown FROM d),
walk AS (SELECT row, key, b, grown, CAST(floor((grown + 1)::DOUBLE * (2147483648::DOUBLE / ((key // 8589934592) + 1)::DOUBLE)) AS BIGINT) AS j FROM drawn
  UNION ALL SELECT row, key, b, grown, CAST(floor((grown + 1)::DOUBLE * (2147483648::DOUBLE / ((key // 8589934592) + 1)::DOUBLE)) AS BIGINT) AS j
  FROM (SELECT row, (key * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS key, CASE WHEN j < 8 THEN j ELSE b END AS b, j AS grown
    FROM walk WHERE j < 9)),
s AS (SELECT row, max(b) AS shard, max(grown) AS grown_shard FROM walk GROUP BY row)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard
  ORDER BY (text_crc32 + coalesce((doc_id % 4096 + 4096) % 4096, 0)) % 4096, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard FROM d JOIN s USING (row)"""


@query(_OP13)
def op13_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query()
def op12_align(spark, sf_dir):
    return align.scored(table(spark, sf_dir, "documents"), ranks_path(), pieces_path())


_OP11 = f"""WITH {_CRC_TABLE},
t0 AS MATERIALIZED (SELECT conv_id AS c, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL),
k0 AS (SELECT c, count(*) AS n, {_CRC.format("any_value(c::VARCHAR)").replace("t.crc", "any_value(t.crc)")} % 4 AS h FROM t0, crc_table t GROUP BY c),
k AS MATERIALIZED (SELECT k0.c, k0.h, k0.c - k0.c % 20 AS first, least(k0.h, coalesce(b.n, 0)) AS g FROM k0 LEFT JOIN k0 b ON b.c = k0.c - k0.c % 20),
r AS (SELECT k.c, t0.p AS d, x, words FROM k JOIN t0 ON t0.c = k.first AND t0.p <= k.h
  UNION ALL SELECT k.c, p - h + g, x, words FROM k JOIN t0 ON t0.c = k.c AND t0.p > k.h),
m AS MATERIALIZED (SELECT c, d, md5(string_agg(x, ',') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS key, words FROM r
  UNION ALL SELECT c, 0, '', 0 FROM k),
n AS MATERIALIZED (SELECT d, key, min(c) AS c, count(*) AS n, max(words) AS words FROM m GROUP BY d, key),
up AS MATERIALIZED (SELECT n.d, n.key, a.d AS pd, a.key AS pkey FROM n JOIN m a ON a.c = n.c AND a.d = n.d - 1),
kids AS MATERIALIZED (SELECT pd AS d, pkey AS key, count(*) AS kids FROM up GROUP BY pd, pkey),
sub AS (SELECT a.d, a.key, sum((n.n - 1) * n.words) AS saved, count(*) FILTER (kids IS NULL) AS leaves
  FROM n JOIN m a ON a.c = n.c AND a.d <= n.d LEFT JOIN kids ON kids.d = n.d AND kids.key = n.key GROUP BY a.d, a.key),
e AS (SELECT m.d, m.key, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids FROM m JOIN (SELECT c, max(d) AS d FROM m GROUP BY c) z
  ON m.c = z.c AND m.d = z.d GROUP BY m.d, m.key)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, pn.c AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256 FROM n JOIN sub ON sub.d = n.d AND sub.key = n.key
  LEFT JOIN kids ON kids.d = n.d AND kids.key = n.key LEFT JOIN up ON up.d = n.d AND up.key = n.key
  LEFT JOIN n pn ON pn.d = up.pd AND pn.key = up.pkey LEFT JOIN e ON e.d = n.d AND e.key = n.key"""


@query(_OP11)
def op11_turn_trie(spark, sf_dir):
    return turn_trie.conversation_trie(table(spark, sf_dir, "conversations"))
