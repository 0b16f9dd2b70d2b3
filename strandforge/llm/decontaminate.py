"""Benchmark decontamination: windows of normalised benchmark words, looked up while scanning all documents.

DataFrame functions only. The benchmark's distinct windows are a hash table that is broadcast while their counted number stays
under a parameter and joined by a shuffle beyond it. The scan emits one row per document window with nothing but a 64-bit hash;
rows that meet a benchmark hash go back to their document, where the words themselves are compared.

Defined cases: a null or empty text has no words and is never hit; a null benchmark text or one without words gives no window;
rows that repeat a doc_id, and rows whose doc_id is null, are each judged by their own text; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

WINDOW = 13
# What a word is, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = r"(?s)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows that may be broadcast: about 250 bytes each.
BROADCAST_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """Normalised words; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: h, size, gram, items. An item of fewer words than ``window`` is one window."""
    words = benchmark.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words")).filter("size(words) > 0")
    cut = words.select("item", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(words) - {window}, 0)), i -> slice(words, i + 1, {window}))")).alias("gram"))
    return (cut.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
            .select(F.xxhash64("gram").alias("h"), F.size("gram").alias("size"), F.array_join("gram", " ").alias("gram"), "items"))


def window_hits(docs: DataFrame, grams: DataFrame, sizes: list[int], doc_id: str = "doc_id", text: str = "text",
                small: bool = True) -> DataFrame:
    """Per document the places whose window hash is a benchmark's: doc, hits(at, size, gram, items). Not yet compared."""
    words = docs.select(F.col(doc_id).alias("doc"), words_of(F.col(text)).alias("words"))
    each = [f"IF(size(words) >= {n}, transform(sequence(1, size(words) - {n - 1}), "
            f"i -> xxhash64(slice(words, i, {n}))), CAST(array() AS array<bigint>))" for n in sizes]
    table = F.broadcast(grams) if small else grams.hint("merge")
    found = None
    for n, windows in zip(sizes, each):
        part = (words.select("doc", F.posexplode(F.expr(windows)).alias("at", "h"))
                .join(table.filter(F.col("size") == n), "h").select("doc", F.struct("at", "size", "gram", "items").alias("hit")))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc").agg(F.collect_list("hit").alias("hits"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs`` and ``contamination``: struct(n_words, hit_words, items); an older column of that name goes.

    ``hit_words`` are the distinct places (from 0) of words inside any occurrence of a benchmark window, ``items`` the
    benchmark items with an occurrence.
    """
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != "contamination"]
    return _told(docs, benchmark, **options).select(*kept, "contamination")


def _told(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    grams = cut_lineage(benchmark_windows(benchmark, window, item_id, item_text), "grams")
    counts = {r["size"]: r["count"] for r in grams.groupBy("size").count().collect()}  # at most ``window`` rows
    none = F.array().cast("array<int>"), F.array().cast(f"array<{dict(benchmark.dtypes)[item_id]}>")
    if not counts:
        return docs.select(F.struct("*").alias("row"), F.struct(F.size(words_of(F.col(text))).alias("n_words"),
                                                                none[0].alias("hit_words"), none[1].alias("items")).alias("contamination"))
    hits = window_hits(docs, grams, sorted(counts), doc_id, text, sum(counts.values()) <= broadcast_windows)
    own = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("own"), words_of(F.col(text)).alias("words"))
    both = own.join(hits, own["own"].eqNullSafe(hits["doc"]), "left").select("row", "words", F.expr(
        "filter(hits, x -> array_join(slice(words, x.at + 1, x.size), ' ') = x.gram)").alias("hits"))
    return both.select("row", F.struct(
        F.size("words").alias("n_words"),
        F.coalesce(F.array_distinct(F.flatten(F.expr("transform(hits, x -> sequence(x.at, x.at + x.size - 1))"))), none[0]).alias("hit_words"),
        F.coalesce(F.array_distinct(F.flatten(F.col("hits.items"))), none[1]).alias("items")).alias("contamination"))


def is_contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` is hit."""
    hit = F.size("contamination.hit_words")
    return (hit > 0) & (share * hit >= F.col("contamination.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, **names) -> DataFrame:
    """``docs`` without the documents of which at least one word in ``share`` lies in a benchmark window."""
    return _told(docs, benchmark, **names).filter(~is_contaminated(share)).select("row.*")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """``docs`` with every word inside a benchmark window removed, together with the separators before it."""
    own = F.col("row")[text]
    pieces = F.regexp_extract_all(own, F.lit(PIECE), F.lit(0))
    kept = F.array_join(F.filter(pieces, lambda _, i: ~F.array_contains(F.col("contamination.hit_words"), i)), "")
    cut = F.when(F.size("contamination.hit_words") > 0, F.concat(kept, F.regexp_replace(own, PIECE, ""))).otherwise(own)
    return _told(docs, benchmark, text=text, **names).select(*[(cut if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
