"""Removal of repeated byte strings by a run-length Burrows-Wheeler index.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a smaller doc_id, or before it in the same document.

1. Equal texts are one text, owned by its smallest doc_id; the other copies are repeated as a whole.
2. Anchors: of every window of ``LENGTH`` bytes the gram of ``GRAM`` bytes with the smallest hash. Equal windows have equal anchors, so a window can
   repeat only if its anchor does. Only around repeated anchors a context is cut that holds all windows over that anchor.
3. Contexts go to shards by their anchor; equal contexts are one. A shard indexes a few anchors at a time: their Burrows-Wheeler transform is kept as
   runs with the text places sampled at run ends. From these samples alone, every place streams its statistics: the lexicographic
   neighbour it matches longest (phi) and the length of that match, which is compared once per run and falls by one per byte within it.
   Places that match for at least ``LENGTH`` bytes are chained into classes; all but the first of a class are marked.
4. Marked ranges go back to their documents.

Anchors with more distinct contexts than ``HOT`` (a passage that very many documents hold, at its edges) are settled by the same rule on digests of
whole windows, which are combined on the map side, so that no shard grows with them.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing; a null doc_id counts as the largest; rows that repeat a doc_id are
documents of their own, ordered by the digest of their text, and are one document if their texts are equal, too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage, drop_cuts
from .common import struct_field
from .jaccard import _powers, mix

LENGTH, GRAM = 100, 32
#: Bytes that are hashed at once; contexts per shard and per index in it; distinct contexts of an anchor that a shard takes.
CHUNK, SHARD, PART, HOT = 1 << 19, 8192, 2048, 8192
#: Rows of a batch that a kernel hands on.
ROWS = 1 << 13


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes."""
    powers, inverse = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], dtype=np.uint64)])
    n = len(data) - gram + 1
    return mix((total[gram:] - total[:n]) * inverse[:n])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the anchors of all windows."""
    whole = np.frombuffer(data, np.uint8)
    mask, hashes, places = np.uint64((1 << 20) - 1), [], []
    for at in range(0, len(whole) - length + 1, CHUNK):
        part = whole[at:at + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        least = _sliding_min((h & ~mask) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        own = (least & mask).astype(np.int64)  # never falls from window to window
        own = own[np.diff(own, prepend=-1) != 0]
        hashes.append(h[own])
        places.append(own + at)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first].view(np.int64), places


def _gathered(parts, schema: pa.Schema):
    """Columns of many small parts as batches of some ten thousand rows."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= ROWS:
            yield _joined(held, schema)
            held, rows = [], 0
    if rows:
        yield _joined(held, schema)


def _joined(held: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = ([x for part in c for x in part] if isinstance(c[0], list) else np.concatenate(c) for c in zip(*held))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _anchor_rows(batches):
    schema = pa.schema([(name, pa.int64()) for name in ("anchor", "doc", "tie", "place")])

    def parts():
        for b in batches:
            for doc, tie, data in zip(b.column("doc").to_pylist(), b.column("tie").to_pylist(), b.column("data").to_pylist()):
                hashes, places = anchors(data)
                yield hashes, np.full(len(hashes), doc), np.full(len(hashes), tie), places
    return _gathered(parts(), schema)


def _contexts(batches):
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("digest", pa.binary()), ("context", pa.binary())])

    def parts():
        for b in batches:
            hits = b.column("hits")
            edges, every = hits.offsets.to_numpy(), hits.values
            anchor, place = every.field("anchor").to_numpy(), every.field("place").to_numpy()
            for i, (doc, tie, data) in enumerate(zip(b.column("doc").to_pylist(), b.column("tie").to_pylist(), b.column("data").to_pylist())):
                for at in range(edges[i], edges[i + 1], ROWS):
                    own = slice(at, min(at + ROWS, edges[i + 1]))
                    starts = np.maximum(place[own] - (LENGTH - GRAM), 0)
                    cut = [data[a:z] for a, z in zip(starts.tolist(), (place[own] + LENGTH).tolist())]
                    yield anchor[own], np.full(len(cut), doc), np.full(len(cut), tie), starts, [xxhash.xxh3_128_digest(c) for c in cut], cut
    return _gathered(parts(), schema)


class RunIndex:
    """Runs of the Burrows-Wheeler transform of some texts, each ended by its own separator, with the places sampled at run ends."""

    def __init__(self, texts: list[bytes]):
        self.sizes = sizes = np.array([len(t) for t in texts], np.int64)
        self.text = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        self.ends = np.cumsum(sizes + 1) - 1
        n = len(self.text)
        self.owner = np.repeat(np.arange(len(texts)), sizes + 1)
        self.rest = self.ends[self.owner] - np.arange(n)  # bytes up to the separator
        symbols = self.text.astype(np.int64) + 1
        symbols[self.ends] = 0
        order = self._sorted(symbols, int(sizes.max(initial=0)) + 1)
        before = symbols[order - 1]  # the place before place 0 is the last separator
        # separators differ from each other, so each of them is a run of its own
        head = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        self.runs = int(head.sum())
        starts = np.nonzero(head)[0]
        places, above = order[starts], np.where(starts > 0, order[starts - 1], -1)
        turn = np.argsort(places)
        self.heads, self.above = places[turn], above[turn]
        self.match = self._common(self.heads, self.above)

    @staticmethod
    def _sorted(symbols: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in order, by doubling; equal up to the separator, they are ordered by place, as separators are."""
        n, width, rank = len(symbols), 1, symbols
        bits, place = max(9, (n + 2).bit_length()), np.arange(n)
        closed = symbols == 0  # the ranked prefix holds a separator, so nothing beyond it counts
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[:n - width] = rank[width:] + 1
            ahead[closed] = 0
            if 3 * bits < 64:  # rank, the rank ahead and the place are one number, which sorts faster than an order of numbers
                key = np.sort(rank << 2 * bits | ahead << bits | place)
                order, key = key & ((1 << bits) - 1), key >> bits
            else:
                key = rank * (n + 3) + ahead
                order = np.argsort(key, kind="stable")
                key = key[order]
            width *= 2
            if width >= longest:
                return order
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key) != 0)])
            half = closed.copy()
            half[:n - width // 2] |= closed[width // 2:]
            closed = half

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common bytes of pairs of places (0 where ``b`` is -1)."""
        out = np.zeros(len(a), np.int64)
        most = np.where(b >= 0, np.minimum(self.rest[a], self.rest[b]), 0)
        live = np.nonzero(most > 0)[0]
        while len(live):
            live = live[self.text[a[live] + out[live]] == self.text[b[live] + out[live]]]
            out[live] += 1
            live = live[out[live] < most[live]]
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every place its neighbour above (-1: none) and the length of their match, streamed from the run samples."""
        place = np.arange(len(self.text))
        run = np.searchsorted(self.heads, place, side="right") - 1
        gone = place - self.heads[run]
        above = np.where(self.above[run] >= 0, self.above[run] + gone, -1)
        length = np.minimum(self.match[run] - gone, self.rest)
        return np.where(length > 0, above, -1), np.maximum(length, 0)


def marked(texts: list[bytes], order: list[np.ndarray], length: int = LENGTH) -> tuple[np.ndarray, RunIndex]:
    """Places whose ``length`` bytes also start earlier; ``order`` holds (major, ..., start) of each text, and a place adds to the last."""
    index = RunIndex(texts)
    above, match = index.statistics()
    linked = match >= length
    root = np.where(linked, above, np.arange(len(above)))
    while not np.array_equal(nxt := root[root], root):
        root = nxt
    member = linked.copy()
    member[root[linked]] = True
    held = np.nonzero(member)[0]
    own = index.owner[held]
    first = index.ends[own] - index.sizes[own]
    keys = [k[own] for k in order]
    keys[-1] = keys[-1] + held - first
    turn = np.lexsort([*keys[::-1], root[held]])
    same = np.concatenate([[False], root[held][turn][1:] == root[held][turn][:-1]])
    # one place of a document may lie in several contexts: it is not earlier than itself
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(turn))))
    later = np.zeros(len(turn), bool)
    for k in keys:
        later |= k[turn] != k[turn][lead]
    out = np.zeros(len(above), bool)
    out[held[turn[later]]] = True
    return out, index


def _parts(anchor: np.ndarray):
    """Sorted anchors in slices of about ``PART`` rows; an anchor is never cut."""
    edges = np.append(np.flatnonzero(np.diff(anchor, prepend=anchor[:1] - 1)), len(anchor))
    at = 0
    while at < len(anchor):
        end = edges[np.searchsorted(edges, at + PART, side="right") - 1]
        end = end if end > at else edges[np.searchsorted(edges, at, side="right")]
        yield slice(at, end)
        at = end


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Marked ranges of the contexts of a shard; a context that is alone with its anchor matches only itself."""
    rows = rows[rows.duplicated("anchor", keep=False)].sort_values("anchor", kind="stable")
    out = []
    for part in _parts(rows["anchor"].to_numpy()):
        order = [rows[c].to_numpy()[part] for c in ("doc", "tie", "start")]
        gone, index = marked(rows["context"].iloc[part].tolist(), order)
        places = np.nonzero(gone)[0]
        if not len(places):
            continue
        own = index.owner[places]
        begin = order[2][own] + places - (index.ends - index.sizes)[own]
        head = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (np.diff(begin) > LENGTH)]))
        last = np.append(head[1:], len(places)) - 1
        out.append(pd.DataFrame({"doc": order[0][own[head]], "tie": order[1][own[head]], "a": begin[head], "z": begin[last] + LENGTH}))
    return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("doc", "tie", "a", "z")})


def _windows(batches):
    """Digests of all windows of contexts."""
    for b in batches:
        for r in b.to_pylist():
            n = len(r["context"]) - LENGTH + 1
            if n > 0:
                digests = [xxhash.xxh3_128_digest(r["context"][i:i + LENGTH]) for i in range(n)]
                yield pa.record_batch([pa.array(digests, pa.binary()), pa.array([r["doc"]] * n, pa.int64()), pa.array([r["tie"]] * n, pa.int64()),
                                       pa.array(np.arange(n) + r["start"])], names=["window", "doc", "tie", "a"])


def repeated_ranges(owners: DataFrame) -> DataFrame:
    """doc, tie, a, z: ranges of bytes that are covered by earlier strings, from texts (doc, tie, data) that all differ.

    ``owners`` is a written table; it is deleted as soon as the contexts are cut, and so is every table here once the next ones are written.
    """
    every = owners.mapInArrow(_anchor_rows, "anchor bigint, doc bigint, tie bigint, place bigint")
    often = cut_lineage(every.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    hits = (every.join(often, "anchor").groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "place")).alias("hits")))
    contexts = owners.join(hits, ["doc", "tie"]).mapInArrow(
        _contexts, "anchor bigint, doc bigint, tie bigint, start bigint, digest binary, context binary")
    contexts = cut_lineage(contexts, "contexts")
    drop_cuts(owners, often)
    one = cut_lineage(contexts.groupBy("anchor", "digest", "context").agg(F.min(F.struct("doc", "tie", "start")).alias("first"))
                      .select("anchor", "digest", "context", "first.*"), "distinct")
    whole = (contexts.select("digest", "doc", "tie", "start", F.length("context").alias("n")).filter(F.col("n") >= LENGTH)
             .join(one.select("digest", *[F.col(c).alias(f"first_{c}") for c in ("doc", "tie", "start")]), "digest")
             .filter("doc <> first_doc OR tie <> first_tie OR start <> first_start").select("doc", "tie", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("z")))
    whole = cut_lineage(whole, "whole")
    drop_cuts(contexts)
    # further copies of a context are in ``whole``; anchors with too many contexts for a shard are at most one in ``HOT`` contexts
    hot = cut_lineage(one.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor"), "hot")
    shards = max(1, -(-one.count() // SHARD))
    settled = (one.join(hot, "anchor", "left_anti").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "doc", "tie", "start", "context")
               .groupBy("shard").applyInPandas(_shard, "doc bigint, tie bigint, a bigint, z bigint"))
    windows = one.join(hot, "anchor").select("doc", "tie", "start", "context").mapInArrow(_windows, "window binary, doc bigint, tie bigint, a bigint")
    lead = windows.groupBy("window").agg(F.min(F.struct("doc", "tie", "a")).alias("lead"))
    crowded = (windows.join(lead, "window").filter("doc <> lead.doc OR tie <> lead.tie OR a <> lead.a")
           .select("doc", "tie", "a", (F.col("a") + LENGTH).alias("z")))
    ranges = cut_lineage(settled.unionByName(crowded).unionByName(whole), "ranges")
    drop_cuts(one, hot, whole)
    return ranges


def _cut(text_name: str):
    def kernel(batches):
        for b in batches:
            rows, texts, counts = b.column("row"), [], []
            told = zip(struct_field(rows, text_name).cast(pa.binary()).to_pylist(), b.column("owner").to_pylist(), b.column("cuts").to_pylist())
            for data, owner, cuts in told:
                data = data or b""
                spans = [(0, len(data))] if owner is False and len(data) >= LENGTH else []
                if owner is not False:
                    for a, z in sorted((c["a"], c["z"]) for c in cuts or ()):
                        if spans and a <= spans[-1][1]:
                            spans[-1] = spans[-1][0], max(z, spans[-1][1])
                        else:
                            spans.append((a, z))
                edges = [0, *[e for s in spans for e in s], len(data)]
                texts.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])))
                counts.append((len(data), sum(z - a for a, z in spans), len(spans)))
            yield pa.record_batch([rows, pa.array(texts, pa.binary()), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]],
                                  names=["row", "kept", "n_bytes", "n_removed", "n_spans"])
    return kernel


def dedup_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with kept (the remaining bytes; a cut may split a character), n_bytes, n_removed and n_spans (maximal removed runs)."""
    doc = F.coalesce(F.col(doc_id).cast("bigint"), F.lit((1 << 63) - 1)).alias("doc")
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    digest = F.unhex(F.md5(data)).alias("digest")
    plain = docs.select(doc, digest, F.xxhash64(data).alias("tie"), data.alias("data"))
    named = plain.groupBy("digest", "doc").agg(F.count("*").alias("rows")).groupBy("digest").agg(F.min(F.struct("doc", "rows")).alias("low"))
    first = cut_lineage(named.select("digest", F.col("low.doc").alias("first"), (F.col("low.rows") > 1).alias("again")), "digests")
    long = plain.filter(F.length("data") >= LENGTH).join(first, "digest").filter("doc = first")
    # only rows that repeat a doc_id and its text, too, have to meet
    owners = cut_lineage(long.filter("NOT again").unionByName(long.filter("again").dropDuplicates(["doc", "digest"])).select("doc", "tie", "data"), "owners")
    ranges = repeated_ranges(owners)
    cuts = ranges.groupBy("doc", "tie").agg(F.collect_set(F.struct("a", "z")).alias("cuts")).withColumn("owner", F.lit(True))
    copies = (plain.select("doc", "digest", "tie").join(first.drop("again"), "digest").filter("doc <> first").select("doc", "tie").distinct()
              .select("doc", "tie", F.lit(None).cast("array<struct<a:bigint,z:bigint>>").alias("cuts"), F.lit(False).alias("owner")))
    told = cut_lineage(cuts.unionByName(copies), "cuts")
    drop_cuts(ranges, first)
    told = told.withColumnsRenamed({"doc": "told_doc", "tie": "told_tie"})
    inner = docs.select(F.struct("*").alias("row"), doc, F.xxhash64(data).alias("tie"))
    both = inner.join(told, (inner["doc"] == told["told_doc"]) & (inner["tie"] == told["told_tie"]), "left").select("row", "owner", "cuts")
    added = [T.StructField("kept", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    out = both.mapInArrow(_cut(text), T.StructType([both.schema["row"], *added]))
    names = {f.name for f in added}
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in names], *names)
