"""Cost-balanced packing of tokenised documents into sequences of one length.

A document's ids, with an end id behind them, are cut into whole sequences from its start; its rest, shorter than a sequence, is
packed. Documents are dealt into groups of bounded size by a hash; inside a group the rests are taken by descending length and each goes
to the sequence of lowest estimated cost (linear * length + quadratic * length ** 2 of every piece, as attention costs) that has room for it.
A rest that fits nowhere any more is cut: its first ids fill the cheapest sequence with any room, and the remainder goes on. A group's
sequences have exactly the room its rests need: as many full ones as fill, and the remainder as powers of two, which are not padded.

Tokens: the ids of the named byte-level BPE vocabulary. Its added tokens, from the JSON file beside the ranks, are cut out of a text first
and give their own ids, as ``tokenizers`` does; the parts between them are encoded apart from each other, each as a whole. A process keeps
no words and holds the texts of few rows at a time.

Defined cases: a null or empty text is the end id alone; rows that repeat a doc_id, or have none, are documents of their own;
an empty table gives no piece; further columns are not carried (pieces are a table of their own).
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch, utf8

LENGTH, END = 1024, 0
#: Documents of one group; a task holds at most LENGTH - 1 ids of each.
GROUP_DOCS = 16_384
#: Cost of one piece of n ids: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Rows whose texts and ids a kernel holds at once.
ROWS = 256

_ENCODERS: dict[str, _Encoder] = {}


def added_tokens(vocabulary_path: str) -> tuple[dict[str, bytes], re.Pattern | None]:
    """Ids (little-endian 16-bit) of the added tokens of a vocabulary's JSON file, and the pattern that finds them, longest first."""
    with open(vocabulary_path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens are found as they are written, without conditions on what is around them")
    added = {t["content"]: np.array([t["id"]], "<u2").tobytes() for t in tokens}
    longest = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
    return added, re.compile(f"({longest})") if added else None


class _Encoder:
    """Ids (little-endian 16-bit) of texts."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added, self.cut = added_tokens(os.path.splitext(ranks_path)[0] + ".json")

    def text(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self.plain(text)
        # the pattern is one group, so every second part is an added token
        parts = self.cut.split(text)
        return b"".join(self.added[p] if i % 2 else self.plain(p) for i, p in enumerate(parts))

    def plain(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u2").tobytes()


def encoder(ranks_path: str) -> _Encoder:
    """The encoder of this process for a vocabulary file of at most 65,536 ids."""
    if ranks_path not in _ENCODERS:
        _ENCODERS[ranks_path] = _Encoder(ranks_path)
    return _ENCODERS[ranks_path]


def _tokenise(ranks_path: str, end: int):
    def kernel(batches):
        told, tail = encoder(ranks_path), np.array([end], "<u2").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                rows = b.slice(at, ROWS)
                ids = [told.text(t or "") + tail for t in rows.column("text").to_pylist()]
                yield pa.record_batch([rows.column("doc"), pa.array(ids, pa.binary())], names=["doc", "ids"])
    return kernel


_PIECES = {"doc": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
           "sequence_id": pa.int64(), "offset": pa.int64()}


def pack(lengths: np.ndarray, size: int, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces (document, start, length, sequence, offset) of documents given by descending length, each shorter than ``size``."""
    total = int(lengths.sum())
    rest = [1 << k for k in reversed(range(size.bit_length())) if total % size >> k & 1]
    room = np.array([size] * (total // size) + rest, np.int64)
    fill, cost, pieces = np.zeros(len(room), np.int64), np.zeros(len(room)), []

    def put(doc: int, start: int, n: int, at: int) -> None:
        pieces.append((doc, start, n, at, int(fill[at])))
        fill[at] += n
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n

    for doc, n in enumerate(lengths.tolist()):
        start = 0
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                put(doc, start, n, int(fits[cost[fits].argmin()]))
                break
            some = np.flatnonzero(room)
            at = int(some[cost[some].argmin()])
            part = int(room[at])
            put(doc, start, part, at)
            start, n = start + part, n - part
    return pieces


class _Group:
    """Pieces of one group, as its documents arrive."""

    def __init__(self, number: int, groups: int, size: int, linear: float, quadratic: float):
        self.number, self.groups, self.size, self.costs = number, groups, size, (linear, quadratic)
        self.made, self.rests = 0, []

    def _piece(self, doc, start, ids, tokens, sequence, offset):
        return doc, start, len(ids), ids.astype("<u4").tobytes(), tokens, self.number + self.groups * sequence, offset

    def document(self, doc, ids: np.ndarray):
        whole = len(ids) - len(ids) % self.size
        for at in range(0, whole, self.size):
            yield self._piece(doc, at, ids[at:at + self.size], len(ids), self.made, 0)
            self.made += 1
        if whole < len(ids):
            self.rests.append((doc, whole, ids[whole:].copy()))

    def end(self):
        rests = sorted(self.rests, key=lambda r: (-len(r[2]), r[0] is None, r[0] or 0, r[1], zlib.crc32(r[2].tobytes())))
        for d, start, n, at, offset in pack(np.array([len(r[2]) for r in rests], np.int64), self.size, *self.costs):
            doc, before, ids = rests[d]
            yield self._piece(doc, before + start, ids[start:start + n], before + len(ids), self.made + at, offset)


def _pack_groups(groups: int, size: int, linear: float, quadratic: float, at_once: int = 1024):
    def rows(batches):
        group = None
        for b in batches:
            for number, doc, ids in zip(b.column("pack_group").to_pylist(), b.column("doc").to_pylist(), b.column("ids")):
                if group is None or group.number != number:
                    if group is not None:
                        yield from group.end()
                    group = _Group(number, groups, size, linear, quadratic)
                yield from group.document(doc, np.frombuffer(ids.as_buffer(), "<u2"))
        if group is not None:
            yield from group.end()

    def kernel(batches):
        ready = []
        for piece in rows(batches):
            ready.append(piece)
            if len(ready) >= at_once:
                yield batch(_PIECES, dict(zip(_PIECES, zip(*ready))))
                ready = []
        if ready:
            yield batch(_PIECES, dict(zip(_PIECES, zip(*ready))))
    return kernel


def tokenise(docs: DataFrame, ranks_path: str, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, ids: a document's ids and the end id, as little-endian 16-bit numbers."""
    return (docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
            .mapInArrow(_tokenise(ranks_path, end), "doc bigint, ids binary"))


def pack_documents(docs: DataFrame, ranks_path: str, size: int = LENGTH, end: int = END, group_docs: int = GROUP_DOCS,
                   linear: float = LINEAR, quadratic: float = QUADRATIC, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``size`` is a power of two. Sequences shorter than ``size`` have a power of two as their length, so nothing is padded.
    """
    if size & (size - 1):
        raise ValueError("the length of a sequence is a power of two")
    groups = max(1, -(-docs.count() // group_docs))
    dealt = (tokenise(docs, ranks_path, end, doc_id, text)
             .withColumn("pack_group", F.pmod(F.xxhash64("doc", "ids"), F.lit(groups)).cast("bigint"))
             .repartition("pack_group").sortWithinPartitions("pack_group"))
    pieces = dealt.mapInArrow(_pack_groups(groups, size, linear, quadratic),
                              "doc bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return pieces.withColumnRenamed("doc", doc_id)
