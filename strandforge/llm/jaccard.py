"""Similarity join on five-word shingles by grouped prefixes.

Every document is the set of its shingles as 64-bit hashes. All shingles are ordered by how frequent they are (levels of a count sketch of
fixed size that covers all documents), rarest first; two sets that reach the threshold share a shingle in their first quarter.

1. Documents with equal sets are one class, known by a 128-bit digest; classes with equal prefix and equal size are one group. Only groups go
   into the buckets of their prefix shingles, so copies cost one row per task and bucket.
2. In every bucket two hubs (two pseudo-random orders) are paired with all other groups: as many pairs as rows. Size, place and prefix filters
   apply, then groups expand to their classes. Outlines (bitmaps of the hashes, two to four bits a shingle) bound from above what two sets can share;
   of the pairs that reach the threshold by that bound the sets themselves are compared, as integers.
3. Classes that links connect, along whole chains, bear one label. Pairs of a bucket with the same label need no comparison. While many others are
   open, the rows of open buckets meet two further hubs, so a large group of near copies closes round by round and never turns into all of its
   pairs. When hubs close no more, the pairs with different labels that are left are all compared, so no link between components is lost; in
   crowded buckets short outlines are compared inside the join, so that its pairs that cannot link are never rows.
4. The labels are the components of all links found.

Defined cases: a document of fewer than five words is one shingle; one without words is linked with nothing; rows with a null doc_id are linked with
nothing and get no component; rows that repeat a doc_id each have their own set and belong
together, but those without words keep that doc_id; the component is the smallest doc_id, so ties cannot occur.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import cut_lineage, drop_cuts
from .common import batch, utf8
from .components import components

WORDS = 5
#: Similarity at least NUM / DEN.
NUM, DEN = 75, 100
#: Cells of each of the two rows of the count sketch; the table of levels that tasks receive is 4 MB at most.
SKETCH_BITS = 19
#: Bits that mark documents whose sets are wanted; 2 MB. More marked documents only mean more sets computed.
MARK_BITS = 24
#: Bits of the short outlines in crowded buckets, those with more pairs than this many a row.
SHORT_BITS, CROWD = 1024, 4
#: Crowded buckets that a row lists, so that two rows meet in the first one they share.
FIRSTS = 16
#: Rows whose sets a kernel holds at once; groups that a task remembers, so as to send their copies once.
ROWS, SEEN = 512, 1 << 16
BLOCK = 1 << 18
CHUNK = 1 << 14

_WS = re.compile(rb"[ \t-\r]")
_rng = np.random.default_rng(20_011)
_VALUE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_VALUE[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_VALUE[_BLANK] = 0
_BASE, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * BLOCK)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[k:k + 1] = [np.multiply.accumulate(row)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and where it starts; ``data`` ends with a blank."""
    raw = np.frombuffer(data, np.uint8)
    powers, inverse = _powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * powers[:len(raw)], out=total[1:])
    blank = _BLANK[raw]
    change = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = change[::2], change[1::2]
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(text: bytes):
    """``text`` cut at blanks into parts of about a block."""
    at = 0
    while at < len(text):
        cut = _WS.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    held, size = [], 0

    def flush() -> None:
        if not held:
            return
        hashes, starts = _word_hashes(b"\n".join(texts[i] for i in held) + b"\n")
        ends = np.cumsum([len(texts[i]) + 1 for i in held])
        cuts = np.append(0, np.searchsorted(starts, ends))
        rolled = _roll(hashes, words)
        for k, i in enumerate(held):
            out[i] = _set_of(hashes, rolled, cuts[k], cuts[k + 1], words)
        held.clear()

    for i, text in enumerate(texts):
        if not text:
            continue
        if len(text) > BLOCK:
            hashes = np.concatenate([_word_hashes(p + b"\n")[0] for p in _pieces(text)])
            out[i] = _set_of(hashes, _roll(hashes, words), 0, len(hashes), words)
            continue
        if size + len(text) > BLOCK:
            flush()
            size = 0
        held.append(i)
        size += len(text) + 1
    flush()
    return out


def _roll(hashes: np.ndarray, words: int) -> np.ndarray:
    n = max(0, len(hashes) - words + 1)
    acc = hashes[:n].copy()
    for k in range(1, words):
        acc = acc * _STEP + hashes[k:k + n]
    return mix(acc)


def _set_of(hashes, rolled, a, b, words) -> np.ndarray:
    if b - a >= words:
        return np.unique(rolled[a:b - words + 1])
    if b == a:
        return np.zeros(0, np.uint64)
    return mix(_roll(hashes[a:b], b - a) + np.uint64(b - a))


# ---------------------------------------------------------------- order of the shingles


def _slices(b: pa.RecordBatch):
    """A batch in parts of few rows, so that a kernel never holds the sets of a whole batch."""
    return (b.slice(at, ROWS) for at in range(0, b.num_rows, ROWS))


def _count_cells(bits: int):
    def kernel(batches):
        cells, mask = np.zeros((2, 1 << bits), np.int64), np.uint64((1 << bits) - 1)
        for b in batches:
            for part in _slices(b):
                every = np.concatenate(shingle_sets(utf8(part.column("text"))))
                cells[0] += np.bincount((every & mask).astype(np.int64), minlength=1 << bits)
                cells[1] += np.bincount((every >> np.uint64(32) & mask).astype(np.int64), minlength=1 << bits)
        flat = cells.reshape(-1)
        for at in range(0, len(flat), CHUNK):
            yield batch({"chunk": pa.int32(), "cells": pa.binary()}, {"chunk": [at // CHUNK], "cells": [flat[at:at + CHUNK].astype("<u4" if flat.max() < 1 << 32 else "<u8").tobytes()]})
    return kernel


def _sum_cells(batches):
    """Sums consecutive rows of a chunk; one accumulator is held."""
    chunk, total = None, None
    for b in batches:
        for number, cells in zip(b.column("chunk").to_pylist(), b.column("cells").to_pylist()):
            values = np.frombuffer(cells, "<u4" if len(cells) == 4 * CHUNK else "<u8").astype(np.int64)
            if number != chunk:
                if chunk is not None:
                    yield batch({"chunk": pa.int32(), "cells": pa.binary()}, {"chunk": [chunk], "cells": [total.astype("<u8").tobytes()]})
                chunk, total = number, np.zeros(CHUNK, np.int64)
            total += values
    if chunk is not None:
        yield batch({"chunk": pa.int32(), "cells": pa.binary()}, {"chunk": [chunk], "cells": [total.astype("<u8").tobytes()]})


def frequency_levels(rows: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """Logarithmic levels of the cells' counts over all documents: 2 rows of 2 ** bits, of fixed size whatever the input."""
    partial = rows.select("text").mapInArrow(_count_cells(bits), "chunk int, cells binary")
    spread = partial.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("chunk", "part").sortWithinPartitions("chunk")
    once = spread.select("chunk", "cells").mapInArrow(_sum_cells, "chunk int, cells binary")
    # written first, so that the shuffle files of the sketch are gone before larger ones are made
    sums = cut_lineage(once.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_sum_cells, "chunk int, cells binary"), "cells")
    cells = np.zeros((2 << bits) // CHUNK * CHUNK, np.float64)
    for r in sums.collect():  # as many rows as the sketch has chunks
        cells[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["cells"], "<u8")
    drop_cuts(sums)
    return np.round(8 * np.log2(np.maximum(cells, 1))).astype(np.uint16).reshape(2, -1)


def ordered(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A set from its rarest shingle to its most frequent."""
    mask = np.uint64(levels.shape[1] - 1)
    level = np.minimum(levels[0][(hashes & mask).astype(np.int64)], levels[1][(hashes >> np.uint64(32) & mask).astype(np.int64)])
    return hashes[np.argsort(level.astype(np.uint64) << np.uint64(54) | hashes >> np.uint64(10), kind="stable")]


def prefix_lengths(n, num: int = NUM, den: int = DEN):
    """Of a set of n: shingles that meet a smaller or equal set's, and those that meet a larger or equal set's."""
    return n - -(-num * n // den) + 1, n - -(-2 * num * n // (num + den)) + 1


_SIGNED = {"doc": pa.int64(), "n": pa.int64(), "gid": pa.int64(), "d1": pa.int64(), "d2": pa.int64()}
_TOKENS = {"token": pa.int64(), "gid": pa.int64(), "n": pa.int32(), "pos": pa.int32()}


def _group_id(size: int, prefix: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(prefix.tobytes(), size & 0xFFFFFFFF) - (1 << 63)


def _sign(levels):
    def kernel(batches):
        for b in batches:
            rows = []
            for part in _slices(b):
                for doc, every in zip(part.column("doc").to_pylist(), shingle_sets(utf8(part.column("text")))):
                    n = len(every)
                    gid = _group_id(n, ordered(every, levels.value)[:prefix_lengths(n)[0]]) if n else 0
                    rows.append((doc, n, gid, *np.frombuffer(xxhash.xxh3_128_digest(every.tobytes()), "<i8").tolist()))
            if rows:
                yield batch(_SIGNED, dict(zip(_SIGNED, zip(*rows))))
    return kernel


def _prefixes(levels):
    def kernel(batches):
        seen = set()
        for b in batches:
            if len(seen) > SEEN:  # only copies that are sent twice
                seen.clear()
            for part in _slices(b):
                tokens, gids, sizes, places = [], [], [], []
                for every in shingle_sets(utf8(part.column("text"))):
                    n = len(every)
                    if not n:
                        continue
                    prefix = ordered(every, levels.value)[:prefix_lengths(n)[0]]
                    gid = _group_id(n, prefix)
                    if gid not in seen:
                        seen.add(gid)
                        tokens.append(prefix)
                        gids.append(gid)
                        sizes.append(n)
                        places.append(len(prefix))
                if tokens:
                    many = np.array(places)
                    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    yield batch(_TOKENS, {"token": np.concatenate(tokens).view(np.int64), "gid": np.repeat(np.array(gids, np.int64), many),
                                          "n": np.repeat(np.array(sizes, np.int32), many), "pos": at.astype(np.int32)})
    return kernel


def outline(every: np.ndarray) -> bytes:
    """Bitmap of a set's hashes modulo a power of two, at least two bits a shingle."""
    width = max(64, 1 << (2 * len(every) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(every & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(x, y, n: int, m: int) -> int:
    """Shingles that sets of n and m can share at most, by their outlines: a bit that only one of them has is a shingle of its own."""
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    width = min(len(u), len(v))
    u, v = (np.bitwise_or.reduce(w.reshape(-1, width), axis=0) for w in (u, v))
    return min(n - int(np.bitwise_count(u & ~v).sum()), m - int(np.bitwise_count(v & ~u).sum()))


def short_outline(every: np.ndarray) -> np.ndarray:
    """Bitmap of a set's hashes modulo ``SHORT_BITS``, as longs."""
    bits = np.zeros(SHORT_BITS, bool)
    bits[(every & np.uint64(SHORT_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def _wanted(marks, told, kind=pa.binary()):
    """node, n and ``told(set)`` of the marked documents."""
    def kernel(batches):
        for b in batches:
            at = b.column("mark").to_numpy()
            held = marks.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            for rows in _slices(b.filter(pa.array(held.astype(bool)))):
                sets = shingle_sets(utf8(rows.column("text")))
                yield batch({"node": pa.int64(), "n": pa.int64(), "told": kind},
                            {"node": rows.column("doc"), "n": [len(s) for s in sets], "told": [told(s) for s in sets]})
    return kernel


def _may_link(num: int, den: int):
    def kernel(batches):
        for b in batches:
            rows = zip(b.column("x"), b.column("y"), b.column("n").to_pylist(), b.column("m").to_pylist())
            bounds = [(most_common(x.as_buffer(), y.as_buffer(), n, m), n + m) for x, y, n, m in rows]
            yield b.select(["a", "b"]).filter(pa.array([den * k >= num * (both - k) for k, both in bounds], pa.bool_()))
    return kernel


def _compare(num: int, den: int):
    def kernel(batches):
        for b in batches:
            kept = []
            for x, y in zip(b.column("x"), b.column("y")):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = np.concatenate([u, v])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                kept.append(den * common >= num * (len(u) + len(v) - common))
            yield b.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
    return kernel


# ---------------------------------------------------------------- the join


def _can_link(num: int, den: int):
    """Size, prefix and place filters on a pair of bucket rows (n, pos) and (m, place); exact for their first common shingle."""
    n, pos, m, place = (F.col(c).cast("bigint") for c in ("n", "pos", "m", "place"))
    small, large = F.least(n, m), F.greatest(n, m)
    inner = lambda k, at: at < k - F.ceil(2 * num * k / (num + den)) + 1
    least = F.ceil(num * (n + m) / (num + den))
    return ((den * small >= num * large) & (1 + F.least(n - pos - 1, m - place - 1) >= least)
            & F.when(n < m, inner(n, pos)).when(n > m, inner(m, place)).otherwise(inner(n, pos) & inner(m, place)))


def mark_words(nodes: DataFrame, bits: int = MARK_BITS) -> np.ndarray:
    """A fixed number of bits, of which those of ``nodes`` are set, in words of 64."""
    place = F.pmod(F.xxhash64("node"), F.lit(1 << bits))
    rows = (nodes.select(place.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("held")).collect())  # at most 2 ** (bits - 6) rows
    words = np.zeros(1 << (bits - 6), np.uint64)
    for r in rows:
        words[r["word"]] = r["held"] & 0xFFFFFFFFFFFFFFFF
    return words


def _verified(pairs: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold. Only documents of pairs that reach it by their outlines have their sets moved."""
    for told, judge, label in ((outline, _may_link, "near"), (np.ndarray.tobytes, _compare, "links")):
        words = mark_words(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        if not words.any():
            return pairs
        made = cut_lineage(marked.mapInArrow(_wanted(pairs.sparkSession.sparkContext.broadcast(words), told), "node bigint, n bigint, told binary"), "sets")
        one = made.select(F.col("node").alias("a"), "n", F.col("told").alias("x"))
        two = made.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("told").alias("y"))
        pairs = cut_lineage(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y", "n", "m")
                            .mapInArrow(judge(num, den), "a bigint, b bigint"), label)
    return pairs


def _merged(labelled: DataFrame, links: DataFrame) -> DataFrame:
    """(gid, node, label) after ``links``: labels that a link joins become the smallest of them, along whole chains."""
    label = labelled.select("node", "label")
    ends = (links.join(label.withColumnsRenamed({"node": "a", "label": "la"}), "a")
            .join(label.withColumnsRenamed({"node": "b", "label": "lb"}), "b")
            .filter("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
    joined = components(ends).withColumnRenamed("node", "label")
    return cut_lineage(labelled.join(joined, "label", "left").select("gid", "node", F.coalesce("component", "label").alias("label")), "labelled")


def _open_pairs(open_: DataFrame) -> tuple[int, int]:
    """Rows of the open buckets, and pairs of rows in a bucket that bear different labels."""
    each = open_.groupBy("token", "label").agg(F.count("*").alias("k"))
    per = each.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
    got = per.agg(F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum(F.col("k") * F.col("k") - F.col("same")), F.lit(0))).first()
    return got[0], got[1] // 2


def _hub_pairs(open_: DataFrame, seeds: tuple[int, int], num: int, den: int) -> DataFrame:
    """(a, b): every row of an open bucket with two hubs of that bucket, where the labels differ."""
    per = Window.partitionBy("token")
    hubs = F.array(*[F.min(F.struct(F.xxhash64("node", F.lit(s)).alias("turn"), "gid", "n", "pos", "node", "label")).over(per) for s in seeds])
    met = open_.withColumn("hubs", hubs).withColumn("hub", F.explode("hubs")).filter("label <> hub.label").select(
        "gid", "n", "pos", "node", F.col("hub.gid").alias("other"), F.col("hub.n").alias("m"), F.col("hub.pos").alias("place"), F.col("hub.node").alias("head"))
    return (met.filter((F.col("gid") == F.col("other")) | _can_link(num, den))
            .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())


def _other_pairs(left: DataFrame, right: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of all rows of a bucket with different labels that can link; where rows have short outlines, by these, too.

    Rows with ``firsts``, the first buckets of their group in the order of places, meet in the first bucket that both lists hold and in no
    later one: the filters on places let a pair pass there if they do anywhere. Where the lists share none, all buckets count.
    """
    short = [c for c in left.columns if c.startswith("short")]
    names = {"gid": "other", "n": "m", "pos": "place", "node": "b", "label": "lb", "firsts": "other_firsts", **{c: f"other_{c}" for c in short}}
    met = left.withColumnsRenamed({"node": "a", "label": "la"}).join(right.withColumnsRenamed(names), "token")
    can = (F.col("gid") == F.col("other")) | _can_link(num, den)
    if short:
        # a bit that only one of two sets has is a shingle of its own
        only = lambda u, v: sum(F.bit_count(F.col(u.format(c)).bitwiseAND(F.bitwise_not(F.col(v.format(c))))) for c in short)
        least = num * (F.col("n").cast("bigint") + F.col("m"))
        can = can & ((num + den) * (F.col("n") - only("{}", "other_{}")) >= least) & ((num + den) * (F.col("m") - only("other_{}", "{}")) >= least)
        # the last condition, so it is evaluated for few pairs
        can = can & (F.coalesce(F.get(F.array_intersect("firsts", "other_firsts"), F.lit(0)), F.col("token")) == F.col("token"))
    met = met.filter("a < b AND la <> lb").filter(can)
    return met.select("a", "b").distinct()


def _rest_pairs(open_: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): all pairs of a bucket with different labels that can link.

    In crowded buckets every row bears a short outline of its set, so that of the pairs of a large group only those leave the join that
    may reach the threshold, and most of them once; outlines of 1,024 bits tell less of sets of over a thousand shingles, and lose no pair of any.
    """
    spark = open_.sparkSession
    each = open_.groupBy("token", "label").agg(F.count("*").alias("k")).groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
    crowded = cut_lineage(each.filter(f"k * k - same > {2 * CROWD} * k").select("token"), "crowded")
    calm = open_.join(crowded, "token", "left_anti").select("token", "gid", "n", "pos", "node", "label")
    full = open_.join(crowded, "token").select("token", "gid", "n", "pos", "node", "label")
    words = mark_words(full.select("node"))
    if not words.any():
        return _other_pairs(calm, calm, num, den)
    short = marked.mapInArrow(_wanted(spark.sparkContext.broadcast(words), short_outline, pa.list_(pa.int64())), "node bigint, n bigint, told array<bigint>")
    short = short.select("node", F.col("n").cast("int").alias("n"),
                         *[F.coalesce(F.col("told")[i], F.lit(0).cast("bigint")).alias(f"short{i}") for i in range(SHORT_BITS // 64)])
    # every row of a bucket is of a text of its node, and n is the size of that text's set
    firsts = (full.select("gid", "pos", "token").distinct().groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("every"))
              .select("gid", F.slice("every", 1, FIRSTS)["token"].alias("firsts")))
    full = cut_lineage(full.join(short.distinct(), ["node", "n"]).join(firsts, "gid"), "full")
    return _other_pairs(calm, calm, num, den).unionByName(_other_pairs(full, full, num, den)).distinct()


def _same_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the texts of one doc_id; none where no doc_id has two texts."""
    own, text = signed.filter("n > 0 AND doc IS NOT NULL"), F.struct("d1", "d2", "n")
    several = own.groupBy("doc").agg(F.min(text).alias("low"), F.max(text).alias("high")).filter("low <> high").select("doc")
    met = own.join(several, "doc").join(classes.select("d1", "d2", "n", "node"), ["d1", "d2", "n"])
    first = met.groupBy("doc").agg(F.min("node").alias("a"))
    return met.join(first, "doc").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", num: int = NUM, den: int = DEN,
                      sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row per row of ``docs``: doc, n (size of its set), component (smallest doc_id reachable by links, itself included)."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    levels = spark.sparkContext.broadcast(frequency_levels(rows, sketch_bits))
    signed = cut_lineage(rows.mapInArrow(_sign(levels), "doc bigint, n bigint, gid bigint, d1 bigint, d2 bigint"), "signed")
    classes = cut_lineage(signed.filter("n > 0 AND doc IS NOT NULL").groupBy("gid", "n", "d1", "d2").agg(F.min("doc").alias("node")), "classes")

    # buckets of prefix shingles; groups with several classes are a bucket of their own as well
    tokens = rows.filter("doc IS NOT NULL").select("text").mapInArrow(_prefixes(levels), "token bigint, gid bigint, n int, pos int")
    own = (classes.groupBy("gid").agg(F.count("*").alias("k"), F.min("n").alias("n")).filter("k > 1")
           .select(F.xxhash64("gid").alias("token"), "gid", F.col("n").cast("int").alias("n"), F.lit(0).alias("pos")))
    per = Window.partitionBy("token")
    hub = lambda seed: F.min(F.struct(F.xxhash64("gid", F.lit(seed)).alias("turn"), "gid", "n", "pos")).over(per)
    met = tokens.repartition("token").groupBy("token", "gid").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    met = met.withColumns({"k": F.count("*").over(per), "hub1": hub(1), "hub2": hub(2)}).filter("k > 1")
    # a hub is written where it is another group's and not the first one again, without its turn: half of a bucket's bytes
    told = lambda i: F.struct(*[F.col(f"hub{i}.{c}").alias(c) for c in ("gid", "n", "pos")])
    met = met.select("token", "gid", "n", "pos", F.when(F.col("hub1.gid") != F.col("gid"), told(1)).alias("hub1"),
                     F.when((F.col("hub2.gid") != F.col("gid")) & (F.col("hub2.gid") != F.col("hub1.gid")), told(2)).alias("hub2"))
    alone = own.withColumns({"hub1": F.struct("gid", "n", "pos"), "hub2": F.lit(None).cast("struct<gid: bigint, n: int, pos: int>")})
    buckets = cut_lineage(met.unionByName(alone), "buckets")

    # every group against two hubs of each of its buckets
    hubs = buckets.select("gid", "n", "pos", F.explode(F.array("hub1", "hub2")).alias("hub")).select(
        "gid", "n", "pos", F.col("hub.gid").alias("other"), F.col("hub.n").alias("m"), F.col("hub.pos").alias("place")).filter("other IS NOT NULL")
    hubs = hubs.filter((F.col("gid") == F.col("other")) | _can_link(num, den)).select("gid", "other").distinct()
    node = classes.select("gid", "node").distinct()
    head = classes.groupBy("gid").agg(F.min("node").alias("head")).withColumnRenamed("gid", "other")
    stars = (hubs.join(node, "gid").join(head, "other").filter("node <> head")
             .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")))
    stars = cut_lineage(stars.distinct(), "stars")
    marked = rows.filter("doc IS NOT NULL").withColumn("mark", F.pmod(F.xxhash64("doc"), F.lit(1 << MARK_BITS)))
    links = _verified(stars, marked, num, den)

    # a class's label is the smallest class known to be connected with it; what stays open are pairs of a bucket with different labels
    labelled = _merged(node.withColumn("label", F.col("node")), links.unionByName(_same_ids(signed, classes)))
    tried, before, turn = stars, None, 2
    rest = buckets.select("token", "gid", "n", "pos").join(labelled, "gid")
    while True:
        open_ = rest.withColumns({"low": F.min("label").over(per), "high": F.max("label").over(per)}).filter("low <> high").drop("low", "high")
        open_ = cut_lineage(open_, "open")
        rows_open, pairs_open = _open_pairs(open_)
        # another pair of hubs costs two pairs a row; it is worth it while all pairs are more and the last hubs closed a tenth of them
        if pairs_open <= 2 * rows_open or (before is not None and pairs_open > 0.9 * before):
            break
        before, turn = pairs_open, turn + 2
        pairs = cut_lineage(_hub_pairs(open_, (turn, turn + 1), num, den).join(tried, ["a", "b"], "left_anti"), "pairs")
        labelled = _merged(labelled, _verified(pairs, marked, num, den))
        tried = tried.unionByName(pairs)
        rest = open_.drop("label").join(labelled, ["gid", "node"])  # labels only merge, so a closed bucket stays closed

    pairs = _rest_pairs(open_, marked, num, den).join(tried, ["a", "b"], "left_anti")
    pairs = cut_lineage(pairs, "pairs")
    labelled = _merged(labelled, _verified(pairs, marked, num, den))

    # classes of different texts may share a doc_id, and with it a node
    found = labelled.groupBy("node").agg(F.min("label").alias("component"))
    named = classes.select("d1", "d2", "n", "node").join(found, "node").select("d1", "d2", "n", "component")
    return signed.join(named, ["d1", "d2", "n"], "left").select(
        "doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component"))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` of which one document of each component stays, its smallest doc_id; rows without a doc_id all stay."""
    told = similar_documents(docs, doc_id, text, **options).filter("doc <> component").select("doc").distinct()
    own = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("bigint").alias("own"))
    return own.join(told, own["own"] == told["doc"], "left_anti").select("row.*")
