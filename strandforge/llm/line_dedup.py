"""Line dedup that can be taken back: sharded cuckoo filters in front of exact reference tables.

A line's key is the 128-bit hash of the line, stripped and lower-cased. ``LineIndex`` holds three written tables:

* ``refs``    one row per key and document that holds it, with the number of its lines there
* ``counts``  one row per key: in how many documents it is, and the smallest of them
* ``filters`` one row per shard: a cuckoo filter with one 16-bit fingerprint for each key of the shard

An insertion probes the filters: keys that no filter knows are new and go straight to ``counts``; only the others are joined
with ``counts``. A deletion takes references away, recounts the keys it touched and takes the fingerprints of keys that
nobody holds any more out of the filters, so insertions and deletions in any order end in the state of the documents left.
Every step writes new tables in the shared folder; a lost executor costs a re-read.

Lines that few documents hold dominate, but one key may be in a third of all documents: keys are counted with map-side
partial sums, and keys held by at least one reference in a thousand (so at most a thousand keys) are joined by broadcast.

Defined cases: a null or empty text is one empty line and holds no key; a null text stays null; rows with a null doc_id take no
part and stay as they are; rows that repeat a doc_id are one document; ties of any kind end at the smallest doc_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import cut_lineage
from .common import batch, struct_field, text_array, utf8, with_field

# What is stripped at both ends of a line, and the length from which a line counts.
BLANK = b" \t\n\x0b\x0c\r"
LEAST = 10
#: Keys of one shard; a shard's filter and incoming keys are held by one task.
SHARD_KEYS = 250_000
SLOTS, LOAD, KICKS = 4, 0.8, 500


def line_key(line: bytes, least: int = LEAST) -> bytes | None:
    """Normalised line, or None if it is shorter than ``least`` code points."""
    key = line.strip(BLANK).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


# ---------------------------------------------------------------- cuckoo filter


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Cuckoo:
    """Buckets of four 16-bit fingerprints; whole arrays of keys are looked up, added and removed at once."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _places(self, k1: np.ndarray, k2: np.ndarray):
        prints = (k2 & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (_mix(k1) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(prints, first)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (_mix(prints.astype(np.uint64) + np.uint64(0x9E3779B9)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def maybe(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(k1, k2)
        return ((self.table[a] == prints[:, None]) | (self.table[b] == prints[:, None])).any(axis=1)

    def add(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """One fingerprint per key; False if the table is too full, which leaves it unusable."""
        prints, at, other = self._places(k1, k2)
        draw = np.random.default_rng(len(self.table))
        for kick in range(KICKS):
            for _ in range(2):
                left = ~self._place(prints, at)
                prints, at, other = prints[left], other[left], at[left]
                if not len(prints):
                    return True
            _, one = np.unique(at, return_index=True)
            slot = draw.integers(0, SLOTS, len(one))
            out = self.table[at[one], slot]
            self.table[at[one], slot] = prints[one]
            prints[one] = out
            other[one] = at[one]
            at[one] = self._other(out, at[one])
        return False

    def _place(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put what fits into its bucket; which of them did."""
        done = np.zeros(len(prints), bool)
        for _ in range(SLOTS):
            todo = np.flatnonzero(~done)
            free = self.table[at[todo]] == 0
            has = todo[free.any(axis=1)]
            if not len(has):
                break
            _, one = np.unique(at[has], return_index=True)
            pick = has[one]
            self.table[at[pick], (self.table[at[pick]] == 0).argmax(axis=1)] = prints[pick]
            done[pick] = True
        return done

    def remove(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Take one copy of each key's fingerprint out; only for keys that are held."""
        prints, at, other = self._places(k1, k2)
        for _ in range(2):
            left = np.ones(len(prints), bool)
            for _ in range(2 * SLOTS):
                todo = np.flatnonzero(left & (self.table[at] == prints[:, None]).any(axis=1))
                if not len(todo):
                    break
                _, one = np.unique(at[todo], return_index=True)
                pick = todo[one]
                self.table[at[pick], (self.table[at[pick]] == prints[pick][:, None]).argmax(axis=1)] = 0
                left[pick] = False
            # what was not in its first bucket is in the other
            prints, at, other = prints[left], other[left], at[left]


# ---------------------------------------------------------------- keys of lines

_REFS = {"doc": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "n": pa.int64()}


def _line_keys(batches):
    for b in batches:
        docs, digests, counts, owners = b.column("doc").to_pylist(), [], [], []
        for doc, text in zip(docs, utf8(b.column("text"))):
            held: dict[bytes, int] = {}
            for line in (text or b"").split(b"\n"):
                key = line_key(line)
                if key is not None:
                    held[key] = held.get(key, 0) + 1
            digests += [xxhash.xxh3_128_digest(k) for k in held]
            counts += held.values()
            owners += [doc] * len(held)
        both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        yield batch(_REFS, {"doc": owners, "k1": both[:, 0], "k2": both[:, 1], "n": counts})


def line_refs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and key: doc, k1, k2, n (its lines there)."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL")
    return (rows.mapInArrow(_line_keys, "doc bigint, k1 bigint, k2 bigint, n bigint")
            .groupBy("k1", "k2", "doc").agg(F.sum("n").alias("n")))


# ---------------------------------------------------------------- the index

_PROBED = "shard int, k1 bigint, k2 bigint, refs bigint, first bigint, maybe boolean"


def _filter_of(rows: pd.DataFrame) -> Cuckoo | None:
    return Cuckoo(np.frombuffer(rows["buckets"].iloc[0], np.uint16).reshape(-1, SLOTS).copy()) if len(rows) else None


def _unsigned(keys: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return keys["k1"].to_numpy().view(np.uint64), keys["k2"].to_numpy().view(np.uint64)


def _probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    held = _filter_of(filters)
    return keys.assign(maybe=held.maybe(*_unsigned(keys)) if held is not None and len(keys) else False)


def _refill(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after its keys' changes: +1 new, -1 gone, 0 held before (needed only to build a larger table)."""
    held, way = _filter_of(filters), keys["way"].to_numpy()
    shard = int(keys["shard"].iloc[0] if len(keys) else filters["shard"].iloc[0])
    if held is not None:
        held.remove(*_unsigned(keys[way < 0]))
        if int((way >= 0).sum()) <= LOAD * held.table.size and held.add(*_unsigned(keys[way > 0])):
            return pd.DataFrame({"shard": [shard], "buckets": [held.table.tobytes()]})
    alive, room = keys[way >= 0], int((way >= 0).sum())
    while not (held := Cuckoo.sized(room)).add(*_unsigned(alive)):
        room *= 2
    return pd.DataFrame({"shard": [shard], "buckets": [held.table.tobytes()]})


class LineIndex:
    """Reference tables and filters of the lines of a changing set of documents."""

    def __init__(self, spark: SparkSession, shards: int):
        self.spark, self.shards = spark, max(1, shards)
        self.refs = spark.createDataFrame([], "k1 bigint, k2 bigint, doc bigint, n bigint, shard int")
        self.counts = spark.createDataFrame([], "shard int, k1 bigint, k2 bigint, refs bigint, first bigint")
        self.filters = spark.createDataFrame([], "shard int, buckets binary")
        self.size = 0

    def _shard(self):
        return F.pmod(F.shiftrightunsigned("k1", 7), F.lit(self.shards)).cast("int").alias("shard")

    def insert(self, refs: DataFrame) -> None:
        """Add documents given as ``line_refs``; documents held already must be deleted first."""
        new_refs = cut_lineage(refs.select("k1", "k2", "doc", "n", self._shard()), "refs")
        new = new_refs.groupBy("shard", "k1", "k2").agg(F.count("*").alias("refs"), F.min("doc").alias("first"))
        if not self.size:
            self.counts = cut_lineage(new, "counts")
            self._refill(self.counts.select("shard", "k1", "k2", F.lit(1).alias("way")))
        else:
            probed = cut_lineage(new.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(_probe, _PROBED), "probed")
            maybe = probed.filter("maybe").drop("maybe")
            old = self.counts.select("k1", "k2", F.col("refs").alias("old_refs"), F.col("first").alias("old_first"))
            known = cut_lineage(maybe.join(old, ["k1", "k2"], "left").select(
                "shard", "k1", "k2", (F.col("refs") + F.coalesce("old_refs", F.lit(0))).alias("refs"),
                F.least("first", "old_first").alias("first"), F.col("old_refs").isNotNull().alias("held")), "known")
            fresh = probed.filter("NOT maybe").drop("maybe")
            before = self.counts
            touched = known.filter("held").select("k1", "k2")
            self.counts = cut_lineage(before.join(touched, ["k1", "k2"], "left_anti").select("shard", "k1", "k2", "refs", "first")
                                      .unionByName(known.drop("held")).unionByName(fresh), "counts")
            self._refill(before.select("shard", "k1", "k2", F.lit(0).alias("way"))
                         .unionByName(known.filter("NOT held").unionByName(fresh, allowMissingColumns=True).select("shard", "k1", "k2", F.lit(1).alias("way"))))
        self.refs = self.refs.unionByName(new_refs)
        self.size = self.refs.count()

    def delete(self, doc_ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents out: afterwards all tables are as if these had never come."""
        gone_ids = doc_ids.select(F.col(doc_id).cast("bigint").alias("doc")).distinct()
        touched = cut_lineage(self.refs.join(gone_ids, "doc", "left_semi").select("shard", "k1", "k2").distinct(), "touched")
        left = cut_lineage(self.refs.join(gone_ids, "doc", "left_anti").select(*self.refs.columns), "refs")
        again = cut_lineage(left.join(touched, ["shard", "k1", "k2"], "left_semi").groupBy("shard", "k1", "k2")
                            .agg(F.count("*").alias("refs"), F.min("doc").alias("first")), "recount")
        dead = touched.join(again, ["shard", "k1", "k2"], "left_anti").select("shard", "k1", "k2", F.lit(-1).alias("way"))
        self.refs = left
        self.counts = cut_lineage(self.counts.join(touched, ["shard", "k1", "k2"], "left_anti").unionByName(again), "counts")
        self._refill(self.counts.select("shard", "k1", "k2", F.lit(0).alias("way")).unionByName(dead))
        self.size = self.refs.count()

    def _refill(self, changes: DataFrame) -> None:
        self.filters = cut_lineage(changes.groupBy("shard").cogroup(self.filters.groupBy("shard"))
                                   .applyInPandas(_refill, "shard int, buckets binary"), "filters")

    def drops(self) -> DataFrame:
        """doc, keys: the keys whose lines a document loses, because a smaller doc_id holds them."""
        repeated = self.counts.filter("refs > 1").select("k1", "k2", "refs", "first")
        hot = max(1000, self.size // 1000)  # at most a thousand keys are held by more references
        refs = self.refs.select("k1", "k2", "doc")
        common = repeated.filter(F.col("refs") > hot).drop("refs")
        rest = repeated.filter(F.col("refs") <= hot).drop("refs")
        few = refs.join(F.broadcast(common.select("k1", "k2")), ["k1", "k2"], "left_anti").join(rest, ["k1", "k2"])
        met = refs.join(F.broadcast(common), ["k1", "k2"]).unionByName(few)
        return met.filter("doc <> first").groupBy("doc").agg(F.collect_list(F.struct("k1", "k2")).alias("keys"))


def _drop_lines(text_name: str):
    def kernel(batches):
        for b in batches:
            row = b.column("row")
            keys = b.column("keys")
            offsets, flat = keys.offsets.to_numpy(), keys.values.flatten() if len(keys.values) else (pa.array([], pa.int64()),) * 2
            both = np.stack([flat[0].to_numpy(), flat[1].to_numpy()], axis=1).astype("<i8")
            out, lines, dropped = [], [], []
            for i, text in enumerate(utf8(struct_field(row, text_name))):
                parts = (text or b"").split(b"\n")
                lines.append(len(parts))
                if offsets[i] < offsets[i + 1] and keys[i].is_valid:
                    gone = {k.tobytes() for k in both[offsets[i]:offsets[i + 1]]}
                    kept = [p for p in parts if (k := line_key(p)) is None or xxhash.xxh3_128_digest(k) not in gone]
                    dropped.append(len(parts) - len(kept))
                    out.append(b"\n".join(kept))
                else:
                    dropped.append(0)
                    out.append(text)
            yield pa.record_batch([with_field(row, text_name, text_array(out)), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                  names=["row", "n_lines", "n_dropped"])
    return kernel


def apply_drops(docs: DataFrame, drops: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines of ``drops``, and n_lines (before), n_dropped."""
    own = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("bigint").alias("own"))
    both = own.join(drops, own["own"] == drops["doc"], "left").select("row", "keys")
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    out = both.mapInArrow(_drop_lines(text), T.StructType([both.schema["row"], *added]))
    names = {"n_lines", "n_dropped"}
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in names], "n_lines", "n_dropped")


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 2, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """An index of all of ``docs``, inserted in ``parts`` batches dealt by the hash of the doc_id."""
    refs = cut_lineage(line_refs(docs, doc_id, text), "lines")
    index = LineIndex(docs.sparkSession, -(-refs.count() // shard_keys))
    for k in range(parts):
        index.insert(refs.filter(F.pmod(F.xxhash64("doc"), F.lit(parts)) == k))
    return index


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` in which a line of at least ten code points stays only in the smallest doc_id that holds it; n_lines, n_dropped."""
    return apply_drops(docs, build_index(docs, doc_id, text, **options).drops(), doc_id, text)
