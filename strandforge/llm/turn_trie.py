"""The prefix trie of conversations, and totals over all its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. Its key is a sum modulo 2 ** 32, in four lanes, of digests of (place, turn): such sums are running sums, so
they are worked out block by block of a conversation, and the key of the parent is the key less the last turn's digest.

Subtree totals: rounds of joins alternately rake and compress. Rake takes all leaves away and adds their totals to their parents. Compress takes away
nodes with a single child, no two of them neighbours, and hands what they hold to the edge above that child. A chain at
least halves in a round, so rounds grow with the logarithm of the longest chain. Going back through the rounds, every compressed node gets the total of its
child plus what was put aside. All joins are on unique keys; the many children of one node meet only in sums that are combined on the map side.

Conversations are numbered in ranges of (conversation, turn), never as a whole; a node with very many children is found by its children over
a broadcast table of at most ``HEAVY`` rows, all others through a shuffle.

Defined cases: rows without conv_id take no part; a null role or text is empty; turns that are null come first, ties in the order of a digest of role and text,
repeated rows are turns of their own; a conversation without rebuilt turns is a member of the root; an empty table has no nodes. Further
columns are not carried.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

#: Turns of a conversation in one block of running sums; consecutive conversation numbers in one piece of a list of members.
BLOCK, CHUNK_BITS = 4096, 12
#: Rows of the broadcast table of nodes with very many children; nodes with fewer children than ``FEW`` are never in it.
HEAVY, FEW = 10_000, 1024
#: Turns that a conversation may borrow from the first of its twenty.
SHARED = 3

_LANES = 4
_LOW = (1 << 32) - 1


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, part, at, digest, words), at from 1, and (conv, part, before, n): parts of conversations, with all ``n`` turns of each."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = cut_lineage(rows.repartitionByRange(F.col("conv"), *order).withColumn("part", F.spark_partition_id()), "turns")
    run = Window.partitionBy("conv")
    parts = cut_lineage(rows.groupBy("conv", "part").agg(F.count("*").alias("size")).select(
        "conv", "part", F.sum("size").over(run).alias("n"),
        F.coalesce(F.sum("size").over(run.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "parts")
    at = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    return rows.select("conv", "part", "digest", "words", at.alias("own")), parts


def rebuilt_paths(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, words) and (conv, total): every conversation c with its first h turns taken from c - c % 20, h = crc32(c) % 4."""
    rows, parts = numbered_turns(conversations)
    convs = parts.groupBy("conv").agg(F.max("n").alias("n")).select(
        "conv", "n", (F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1)).alias("h"), (F.col("conv") - F.col("conv") % 20).alias("first"))
    lent = convs.select(F.col("conv").alias("first"), F.col("n").alias("n_first"))
    convs = convs.join(lent, "first", "left").withColumn("g", F.least("h", F.coalesce("n_first", F.lit(0))))
    convs = cut_lineage(convs.withColumn("total", F.col("g") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("n_first", "n"), "convs")
    placed = cut_lineage(rows.join(parts.join(convs, "conv"), ["conv", "part"]).select(
        "conv", (F.col("own") + F.col("before")).alias("at"), "h", "g", "digest", "words"), "placed")
    own = placed.filter("at > h").select("conv", (F.col("at") - F.col("h") + F.col("g")).alias("depth"), "digest", "words")
    heads = placed.filter(F.col("at") <= SHARED).select(F.col("conv").alias("first"), F.col("at").alias("depth"), "digest", "words")
    borrowed = convs.join(heads, "first").filter("depth <= h").select("conv", "depth", "digest", "words")
    return own.unionByName(borrowed), convs.select("conv", "total")


def _packed(lanes: list[Column]) -> list[Column]:
    low = [lane.bitwiseAND(_LOW) for lane in lanes]
    return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]


def keyed_paths(paths: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, words): the key of every prefix and of the prefix one turn shorter."""
    hashed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    rows = paths.withColumn("x", hashed).select(
        "conv", "depth", "words", F.expr(f"(depth - 1) div {BLOCK}").alias("block"),
        *[F.conv(F.substring("x", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"x{i}") for i in range(_LANES)])
    run = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(f"x{i}").alias(f"s{i}") for i in range(_LANES)]).select(
        "conv", "block", *[F.coalesce(F.sum(f"s{i}").over(run), F.lit(0)).alias(f"s{i}") for i in range(_LANES)])
    upto = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(f"x{i}").over(upto).alias(f"u{i}") for i in range(_LANES)]).join(blocks, ["conv", "block"])
    whole = [F.col(f"u{i}") + F.col(f"s{i}") for i in range(_LANES)]
    k1, k2 = _packed(whole)
    p1, p2 = _packed([w - F.col(f"x{i}") for i, w in enumerate(whole)])
    return summed.select("conv", "depth", k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), "words")


def trie(members: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes (id, parent, k1, k2, conv_id, depth, parent_conv_id, n_convs, n_children, words), the root with null parents; written once."""
    zero = F.lit(0).cast("bigint")
    found = members.groupBy("depth", "k1", "k2", "p1", "p2").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
        "conv_id", "n_convs", zero.alias("words"))
    nodes = cut_lineage(found.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    families = nodes.filter("p1 IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(families, ["depth", "k1", "k2"], "left").fillna(0, ["n_children"]), "counted")
    # at most HEAVY nodes have so many of all the children
    many = max(FEW, -(-nodes.count() // HEAVY))
    above = nodes.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("depth").alias("up"),
                                                  F.col("k1").alias("p1"), F.col("k2").alias("p2"), "n_children")
    on = ["up", "p1", "p2"]
    heavy = F.broadcast(above.filter(F.col("n_children") >= many).drop("n_children"))
    below = nodes.withColumn("up", F.col("depth") - 1).filter("p1 IS NOT NULL")
    light = below.join(heavy.select(*on), on, "left_anti").join(above.filter(F.col("n_children") < many).drop("n_children"), on)
    columns = ["id", "parent", "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "words"]
    top = nodes.filter("p1 IS NULL").withColumns({c: F.lit(None).cast("bigint") for c in ("parent", "parent_conv_id")})
    return cut_lineage(below.join(heavy, on).select(columns).unionByName(light.select(columns)).unionByName(top.select(columns)), "trie")


def _coin(turn: int) -> Column:
    """Whether a node may be compressed in a round. Bits of the depth, from the lowest, take every second node of an untouched chain."""
    if turn < 16:
        return F.shiftright("depth", turn).bitwiseAND(1) == 1
    return F.xxhash64("id", F.lit(turn)).bitwiseAND(1) == 1


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(id, *values): every value summed over the subtree of each node.

    ``nodes`` has id, parent (null at roots), n_children, depth and the values; it is read once per round, so write it first.
    """
    def each(make) -> list[Column]:
        return [make(v).alias(v) for v in values]

    def carried(v: str) -> str:
        return f"carry_{v}"

    live = nodes.select("id", "parent", "depth", F.col("n_children").alias("kids"), *values, *[F.lit(0).cast("bigint").alias(carried(v)) for v in values])
    raked, compressed = [], []
    while True:
        # rake: leaves go, their totals and what their edges carry go to the parents
        leaf = F.col("kids") == 0
        up = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            *[F.sum(F.when(leaf, F.col(v) + F.col(carried(v))).otherwise(0)).alias(f"gain_{v}") for v in values],
            F.count(F.when(~leaf, 1)).alias("rest"), F.min(F.when(~leaf, F.col("id"))).alias("child"))
        told = cut_lineage(live.join(up, "id", "left").select(
            "id", "parent", "depth", leaf.alias("leaf"), F.coalesce("rest", F.lit(0).cast("bigint")).alias("kids"), "child",
            *each(lambda v: F.col(v) + F.coalesce(f"gain_{v}", F.lit(0))), *[carried(v) for v in values]), "raked")
        raked.append(told.filter("leaf").select("id", *values))
        left = told.filter("NOT leaf")
        if not left.limit(1).count():
            break
        # compress: chosen nodes with one child, unless that child is chosen too, are cut out
        chosen = F.col("parent").isNotNull() & (F.col("kids") == 1) & _coin(len(compressed))
        below = left.filter(~chosen).select(F.col("id").alias("child"), *[F.col(carried(v)).alias(f"low_{v}") for v in values])
        cut = cut_lineage(left.filter(chosen).join(below, "child").select(
            "id", "child", "parent", *each(lambda v: F.col(v) + F.col(f"low_{v}")),
            *[(F.col(v) + F.col(f"low_{v}") + F.col(carried(v))).alias(carried(v)) for v in values]), "compressed")
        compressed.append(cut.select("id", "child", *values))
        moved = cut.select(F.col("child").alias("id"), F.lit(False).alias("gone"), F.col("parent").alias("new_parent"),
                           *[F.col(carried(v)).alias(f"new_{v}") for v in values])
        gone = cut.select("id", F.lit(True).alias("gone"), F.lit(None).cast("bigint").alias("new_parent"),
                          *[F.lit(None).cast("bigint").alias(f"new_{v}") for v in values])
        live = left.join(moved.unionByName(gone), "id", "left").filter("gone IS NULL OR NOT gone").select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "depth", "kids", *values,
            *[F.coalesce(f"new_{v}", carried(v)).alias(carried(v)) for v in values])
    # expand: going back, the child of a compressed node always has its total already
    known = raked.pop()
    while compressed:
        known = known.unionByName(raked.pop())
        cut = compressed.pop()
        totals = known.select(F.col("id").alias("child"), *[F.col(v).alias(f"low_{v}") for v in values])
        known = known.unionByName(cut_lineage(cut.join(totals, "child").select("id", *each(lambda v: F.col(v) + F.col(f"low_{v}"))), "expanded"))
    return known


def _digests(batches):
    """SHA-256 of the comma-joined pieces of each node; rows of a node follow each other in order."""
    at, told, out = None, None, []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["depth", "k1", "k2", "ends_sha256"])

    for rb in batches:
        for *key, piece in zip(*(rb.column(c).to_pylist() for c in ("depth", "k1", "k2", "piece"))):
            if key != at:
                if at is not None:
                    out.append((*at, told.hexdigest()))
                at, told = key, hashlib.sha256()
            else:
                told.update(b",")
            told.update(piece.encode())
        if out:
            yield batch(out)
            out = []
    if at is not None:
        yield batch([(*at, told.hexdigest())])


def end_digests(members: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes at which conversations end.

    A digest runs through its members in order, so one task reads all pieces of a node, one after the other; the pieces, of bounded size,
    are made in parallel.
    """
    zero = F.lit(0).cast("bigint")
    last = members.join(convs.select("conv", F.col("total").alias("depth")), ["conv", "depth"]).select("depth", "k1", "k2", "conv")
    bare = convs.filter("total = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv")
    listed = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = (last.unionByName(bare).groupBy("depth", "k1", "k2", F.shiftright("conv", CHUNK_BITS).alias("chunk"))
              .agg(F.array_join(listed, ",").alias("piece")))
    return (pieces.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "chunk")
            .mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, with the totals of their subtrees."""
    paths, convs = rebuilt_paths(conversations)
    members = cut_lineage(keyed_paths(paths), "members")
    nodes = trie(members, convs)
    own = nodes.select("id", "parent", "depth", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    return (nodes.join(totals, "id").join(end_digests(members, convs), ["depth", "k1", "k2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
