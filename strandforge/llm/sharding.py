"""Stable shards by jump consistent hashing: no ring, no table; the key and the number of shards decide.

A key walks upwards through shard numbers, from 0, by jumps that a published 64-bit generator draws from the key alone; its shard among n is the
last number below n that it reaches. One more shard therefore takes rows only into itself, the fraction 1 / (n + 1) that must move. The walk is a
fold of column expressions (64-bit products are put together from 32-bit halves), so placing rows is a map without shuffle, and one
walk answers for several numbers of shards.

Slots number the rows of a shard from 0 without a gap. Rows of a shard are dealt into blocks by id and content, numbered inside their block,
and offset by the sizes of the blocks before: no task sees a whole shard. Rows equal in id, size and checksum are counted before they are
shuffled, so a group of copies of any size travels as a few rows.

Defined cases: a null key walks as 0 and a null text has no bytes (size 1, checksum 0); rows that repeat a key share its shard and have slots of their
own; an empty table has no rows; columns of the input that bear the name of an added one give way to it.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage

# Fixed value: multiplier of the published generator (key = key * MULTIPLIER + 1 modulo 2 ** 64).
MULTIPLIER = 2862933555777941757
#: Rows of the table of block sizes, whatever the number of rows placed; it is what the slots broadcast.
BLOCK_ROWS = 32_768
#: Copies that one array numbers.
COPIES = 65_536
LAW = "key"

_LOW = (1 << 32) - 1


def _draw(high: Column, low: Column) -> tuple[Column, Column]:
    """The halves of key * MULTIPLIER + 1 modulo 2 ** 64; no product reaches 2 ** 63, so none overflows."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW
    m1, m0 = m_low >> 16, m_low & 0xFFFF
    upper = low * m1
    lower = low * m0 + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + 1
    cross = (low * m_high).bitwiseAND(_LOW) + high * m0 + F.shiftleft((high * m1).bitwiseAND(0xFFFF), 16)
    return (cross + F.shiftright(upper, 16) + F.shiftright(lower, 32)).bitwiseAND(_LOW), lower.bitwiseAND(_LOW)


def stable_key(*columns: Column | str) -> Column:
    """A 64-bit key of the columns; one integral column is its own key (see ``jump_shards``), others are hashed."""
    return F.xxhash64(*columns)


def jump_shards(key: Column, counts: list[int]) -> Column:
    """array<int>: the shard of a 64-bit ``key`` among each of ``counts`` shards.

    Every jump goes up by one at least, so as many rounds as shards end any walk; about their logarithm is walked. Beyond 64 shards the
    rounds are two folds of their root, the inner one left out once the walk has ended.
    """
    if not counts or min(counts) < 1:
        raise ValueError("a walk needs one shard or more")
    most = max(counts)
    start = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))

    def state(high: Column, low: Column, at: Column, reached: Column) -> Column:
        return F.struct(high.alias("high"), low.alias("low"), at.alias("at"), reached.alias("reached"))

    def step(s: Column, _: Column) -> Column:
        high, low = _draw(s["high"], s["low"])
        # the halves are named by a fold of their own, so that they are drawn once
        return F.when(s["at"] >= most, s).otherwise(F.aggregate(
            F.array(F.struct(high.alias("high"), low.alias("low"))), s, lambda _s, k: state(
                k["high"], k["low"],
                ((s["at"] + 1) * (F.lit(2147483648.0) / (F.shiftright(k["high"], 1) + 1))).cast("bigint"),
                F.array(*[F.when(s["at"] < n, s["at"]).otherwise(s["reached"][i]) for i, n in enumerate(counts)]))))

    zero = F.lit(0).cast("bigint")
    first = state(F.shiftrightunsigned(start, 32), start.bitwiseAND(_LOW), zero, F.array(*[zero] * len(counts)))
    if most <= 64:
        return F.aggregate(F.sequence(F.lit(1), F.lit(most)), first, step, lambda s: s["reached"].cast("array<int>"))
    part = isqrt(most - 1) + 1
    rounds = F.sequence(F.lit(1), F.lit(part))
    return F.aggregate(rounds, first, lambda s, _: F.when(s["at"] >= most, s).otherwise(F.aggregate(rounds, s, step)),
                       lambda s: s["reached"].cast("array<int>"))


def place(docs: DataFrame, shards: int, key: Column | str = "doc_id", text: str = "text", grown: int | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard and grown_shard (the shard among ``grown`` shards, one more unless given). No shuffle."""
    k = F.col(key) if isinstance(key, str) else key
    body = F.coalesce(F.col(text), F.lit(""))
    walk = jump_shards(k, [shards, grown or shards + 1])
    added = {"size": (F.octet_length(body) + 1).cast("bigint"), "text_crc32": F.crc32(body.cast("binary")), "law": F.lit(LAW)}
    kept = [F.col(c) for c in docs.columns if c.lower() not in (*added, "shard", "grown_shard")]
    rows = docs.select(*kept, *[v.alias(n) for n, v in added.items()], walk.alias("_walk"))
    return rows.select(*[c for c in rows.columns if c != "_walk"], F.col("_walk")[0].alias("shard"), F.col("_walk")[1].alias("grown_shard"))


def moved(placed: DataFrame) -> DataFrame:
    """The rows that change their shard when the set grows; every one goes into a new shard."""
    return placed.filter("shard <> grown_shard")


def _block(shards: int, key: str) -> Column:
    blocks = max(1, BLOCK_ROWS // shards)
    own = F.coalesce(F.pmod(F.col(key).cast("bigint"), F.lit(blocks)), F.lit(0))
    return F.pmod(F.col("text_crc32") + own, F.lit(blocks)).cast("int")


def numbered(placed: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, law, shard, grown_shard, slot) of placed rows; an integral ``key`` orders the rows of a block.

    Equal rows are combined on the map side. The table of blocks has at most ``BLOCK_ROWS`` rows (as many as shards, if those are more).
    """
    same = [key, "size", "text_crc32", "law", "shard", "grown_shard"]
    rows = cut_lineage(placed.select(*same, _block(shards, key).alias("block")).groupBy(*same, "block").agg(F.count("*").alias("copies")), "placed")
    order = Window.partitionBy("shard", "block").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    before = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy("shard", "block").agg(F.sum("copies").alias("n"))
    run = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "block", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("offset"))
    first = rows.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(offsets), ["shard", "block"])
    # copies are numbered in arrays of bounded size
    runs = first.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES}"))))
    last = F.least(F.col("copies"), (F.col("run") + 1) * COPIES) - 1
    return (runs.withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES, last)))
            .select(*same, (F.col("offset") + F.col("before") + F.col("copy")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text", files: int = 8) -> None:
    """Write ``docs`` as one folder ``shard=<n>`` per shard, of ``files`` files at most; rows go to files by id and content."""
    placed = place(docs, shards, key, text)
    parts = F.pmod(_block(shards, key), F.lit(files))
    out = placed.withColumn("_file", parts).repartition(shards * files, "shard", "_file")
    out.drop("_file", "size", "text_crc32", "law", "grown_shard").write.partitionBy("shard").parquet(path)


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType()),
                       T.StructField("law", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()),
                       T.StructField("grown_shard", T.IntegerType())])


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Placement and slot of every row of ``docs`` (doc_id, text, ...)."""
    return numbered(place(docs.select("doc_id", "text"), shards), shards).select(*RESULT.names)
