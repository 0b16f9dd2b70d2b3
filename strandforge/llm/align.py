"""Alignment of two tokenisations of the same bytes by lockstep merging.

Token ends of both sides are byte offsets. One NumPy state vector holds, for every document of a batch, a pointer into its A tokens and one into its B
tokens. Each step emits the link of the two tokens under the pointers, emits a cut where both end, and moves the pointer whose token ends
first (both at a cut); finished documents are compacted away. Documents of more than ``LANE`` tokens are entered at several places where both
sides end, so the number of steps of a batch stays small; lanes only share out the steps and change no link.

How many documents hold a pair of ids linked is counted over the whole corpus. The counts go back to the documents in two ways: pairs with at
least as many documents as a threshold, chosen so that at most ``HOT_PAIRS`` reach it, are broadcast; all others, none of which is frequent, are joined
through a shuffle.

Defined cases: null and empty texts, and texts whose tokens do not give back a blank and the text on both sides, have no tokens: zeros and an
empty digest. Rows that repeat a doc_id, or have none, are documents of their own. An empty table has no rows. Further columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

#: Tokens that one lane merges, at least; bytes of text merged at once.
LANE, GROUP_BYTES = 1024, 2 << 20
#: Rows of the table of frequent pairs, whatever the corpus.
HOT_PAIRS = 1 << 19

_NONE = np.zeros(0, np.int32)
_SIDES: dict[tuple[str, str], tuple[_Side, _Side]] = {}


class _Side:
    """One tokeniser: ids of texts, each behind a blank, and the bytes of every id."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode, self.tokens = encode, tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where their bytes are not those of the blank and the text."""
        name = self.tokens.__getitem__
        return [np.array(ids, np.int32) if b"".join(map(name, ids)) == b" " + text.encode() else None
                for text, ids in zip(texts, self.encode(texts))]


def sides(ranks_path: str, pieces_path: str) -> tuple[_Side, _Side]:
    """A: byte-level ranks; B: a sentencepiece model, which adds the blank itself. Loaded once in a process."""
    if (ranks_path, pieces_path) not in _SIDES:
        import public_tokenizers
        import sentencepiece
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        by_rank = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            a[i] = token
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        _SIDES[ranks_path, pieces_path] = (_Side(lambda texts: (by_rank(" " + t) for t in texts), a),
                                           _Side(lambda texts: model.encode(texts, num_threads=1), b))
    return _SIDES[ranks_path, pieces_path]


def _lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, a_stop: np.ndarray):
    """(first A, stop A, first B) of lanes: documents, cut at the first common end after every ``LANE`` A tokens."""
    marks = [np.arange(f + LANE, s - LANE, LANE) for f, s in zip(a_first.tolist(), a_stop.tolist()) if s - f > 2 * LANE]
    cuts = np.concatenate(marks) if marks else np.zeros(0, np.int64)
    while True:
        # a document's last token ends on both sides, so every mark comes to a stop
        apart = b_ends[np.searchsorted(b_ends, a_ends[cuts])] != a_ends[cuts]
        if not apart.any():
            break
        cuts = cuts + apart
    starts = np.unique(np.concatenate([a_first, cuts + 1]))
    starts = starts[starts < a_stop[-1]]
    ends_before = np.where(starts > 0, a_ends[starts - 1], 0)
    return starts, np.append(starts[1:], a_stop[-1]), np.searchsorted(b_ends, ends_before, side="right")


def merge(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, a_stop: np.ndarray):
    """Links (A token, B token) and flags of the tokens at cuts.

    Ends are byte offsets over the documents one behind the other; document n has the A tokens from ``a_first[n]`` up to ``a_stop[n]``, at least one, and
    as many bytes on both sides.
    """
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    at_a, at_b = [], []
    if len(a_first):
        a, stop, b = _lanes(a_ends, b_ends, a_first, a_stop)
        while len(a):
            at_a.append(a)
            at_b.append(b)
            a_end, b_end = a_ends[a], b_ends[b]
            both = a_end == b_end
            a_cut[a[both]] = True
            b_cut[b[both]] = True
            a, b = a + (a_end <= b_end), b + (b_end <= a_end)
            live = a < stop
            if not live.all():
                a, b, stop = a[live], b[live], stop[live]
    empty = np.zeros(0, np.int64)
    return np.concatenate(at_a or [empty]), np.concatenate(at_b or [empty]), a_cut, b_cut


@cache
def _names(n_a: int, n_b: int) -> list[bytes]:
    """Every id as it is written inside and at the end of its half of a group; A's first."""
    return [s for n, end in ((n_a, b"|"), (n_b, b";")) for i in range(n) for s in (b"%d," % i, b"%d%b" % (i, end))]


def _groups(a_ids, b_ids, a_cut, b_cut, n_a: int):
    """Codes into ``_names`` of all tokens in the order of the written groups."""
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    a_upto, b_upto = np.flatnonzero(a_cut) + 1, np.append(0, np.flatnonzero(b_cut) + 1)
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    codes[np.arange(len(a_ids)) + b_upto[a_group]] = a_ids.astype(np.int64) * 2 + a_cut
    codes[np.arange(len(b_ids)) + a_upto[b_group]] = (b_ids.astype(np.int64) + n_a) * 2 + b_cut
    return codes


_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int32())])
_FIELDS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
           "groups": pa.string(), "pairs": pa.list_(_PAIR)}
_TYPES = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string", "groups": "string",
          "pairs": "array<struct<a: int, b: int, links: int>>"}


def align_texts(texts: list[str | None], a_side: _Side, b_side: _Side, written: bool = False) -> dict[str, pa.Array]:
    """Columns of ``_FIELDS`` for some texts; the groups themselves are written out only if asked for."""
    full = [n for n, text in enumerate(texts) if text]
    told = [(_NONE, _NONE)] * len(texts)
    for n, a, b in zip(full, *(side.ids([texts[n] for n in full]) for side in (a_side, b_side))):
        if a is not None and b is not None:
            told[n] = a, b
    a_ids, b_ids = (np.concatenate(side) for side in zip(*told))
    a_count, b_count = (np.array([len(s) for s in side], np.int64) for side in zip(*told))
    a_stop, b_stop = np.cumsum(a_count), np.cumsum(b_count)
    some = a_count > 0
    a_at, b_at, a_cut, b_cut = merge(np.cumsum(a_side.sizes[a_ids]), np.cumsum(b_side.sizes[b_ids]), (a_stop - a_count)[some], a_stop[some])

    owner = np.repeat(np.arange(len(texts)), a_count)
    n_links = np.bincount(owner[a_at], minlength=len(texts))
    n_groups = np.bincount(owner[a_cut], minlength=len(texts))
    b_bits, a_bits = len(b_side.tokens).bit_length(), len(a_side.tokens).bit_length()
    keys = np.sort(owner[a_at] << (a_bits + b_bits) | a_ids[a_at].astype(np.int64) << b_bits | b_ids[b_at].astype(np.int64))
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    pairs = keys[first]
    held = np.bincount(pairs >> (a_bits + b_bits), minlength=len(texts))
    listed = pa.StructArray.from_arrays(
        [pa.array((pairs >> b_bits & (1 << a_bits) - 1).astype(np.int32)), pa.array((pairs & (1 << b_bits) - 1).astype(np.int32)),
         pa.array(np.diff(np.append(first, len(keys))).astype(np.int32))], fields=list(_PAIR))

    codes = _groups(a_ids, b_ids, a_cut, b_cut, len(a_side.tokens))
    digests, groups, name = [], [], _names(len(a_side.tokens), len(b_side.tokens)).__getitem__
    stops = (a_stop + b_stop).tolist()
    for start, stop in zip([0, *stops], stops):
        text = b"".join(map(name, codes[start:stop].tolist()))[:-1]
        digests.append(hashlib.sha256(text).hexdigest() if text else "")
        groups.append(text.decode() if written else None)
    return {"n_a": pa.array(a_count), "n_b": pa.array(b_count), "n_groups": pa.array(n_groups.astype(np.int64)),
            "n_links": pa.array(n_links.astype(np.int64)), "groups_sha256": pa.array(digests, pa.string()), "groups": pa.array(groups, pa.string()),
            "pairs": pa.ListArray.from_arrays(np.append(0, np.cumsum(held)).astype(np.int32), listed)}


def _kernel(ranks_path: str, pieces_path: str, fields: list[str]):
    def run(batches):
        a_side, b_side = sides(ranks_path, pieces_path)
        for rb in batches:
            texts = rb.column("text").to_pylist()
            start, held = 0, 0
            for n, text in enumerate(texts):
                held += len(text or "")
                if held >= GROUP_BYTES or n + 1 == len(texts):
                    told = align_texts(texts[start:n + 1], a_side, b_side, "groups" in fields)
                    yield pa.record_batch([rb.column("doc").slice(start, n + 1 - start), *[told[f] for f in fields]], names=["doc", *fields])
                    start, held = n + 1, 0
    return run


def align_tokens(docs: DataFrame, ranks_path: str, pieces_path: str, fields: tuple = ("n_a", "n_b", "n_groups", "n_links", "groups"),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, *fields) of every row: counts, ``groups`` of token ids as a1,a2|b1;a3|b2 (or their digest, ``groups_sha256``), ``pairs`` of linked
    ids with the number of their links. One narrow stage."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    schema = "doc bigint, " + ", ".join(f"{f} {_TYPES[f]}" for f in fields)
    return rows.mapInArrow(_kernel(ranks_path, pieces_path, list(fields)), schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents two ids are linked, and whether no partner of the A id has more; ``pair`` is a * 2 ** 32 + b.

    The counts, at most one row per pair of ids, are combined on the map side.
    """
    pair = (F.shiftleft(F.col("p.a").cast("bigint"), 32) + F.col("p.b")).alias("pair")
    counts = cut_lineage(aligned.select(F.explode("pairs").alias("p")).select(pair).groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.join(most, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def hot_threshold(counts: DataFrame, rows: int) -> int:
    """The smallest power of two that at most ``rows`` pairs reach with their documents."""
    sizes = {r.bits: r.n for r in counts.groupBy(F.length(F.bin("docs")).alias("bits")).agg(F.count("*").alias("n")).collect()}
    bits, held = 64, 0
    while bits > 1 and held + sizes.get(bits - 1, 0) <= rows:
        bits -= 1
        held += sizes.get(bits, 0)
    return 1 << (bits - 1)


def link_scores(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of the rows with links: ``aligned`` holds a unique ``row`` and ``pairs``; it is read three times, so write it first."""
    counts = cut_lineage(pair_counts(aligned), "counts")
    reached = F.col("docs") >= hot_threshold(counts, hot_pairs)
    pair = (F.shiftleft(F.col("p.a").cast("bigint"), 32) + F.col("p.b")).alias("pair")
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", pair, "p.links")
    told = [F.sum(F.when(F.col("best"), F.col("links").cast("bigint")).otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("docs")).alias("count_sum")]
    hot = F.broadcast(counts.filter(reached))
    often = links.join(hot, "pair").groupBy("row").agg(*told)
    seldom = links.join(hot.select("pair"), "pair", "left_anti").join(counts.filter(~reached), "pair").groupBy("row").agg(*told)
    return often.unionByName(seldom).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def scored(docs: DataFrame, ranks_path: str, pieces_path: str) -> DataFrame:
    """Counts, digest and corpus-wide scores of the alignment of every document."""
    fields = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    aligned = align_tokens(docs, ranks_path, pieces_path, (*fields, "pairs"))
    aligned = cut_lineage(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    scores = link_scores(aligned)
    return (aligned.select("row", "doc", *fields).join(scores, "row", "left")
            .select(F.col("doc").alias("doc_id"), *fields, F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum")))
