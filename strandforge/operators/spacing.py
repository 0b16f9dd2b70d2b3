"""Evenly spaced selection of positions per gene."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Places of one bitmap, as Spark's bitmap functions make them; bitmaps that are spelled out at a time.
BUCKET, SPELLED = 32_768, 64


def _greedy_count(p: Column, gap: Column) -> Column:
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("bigint").alias("last"))
    return F.aggregate(p, start, lambda a, x: F.when(
        a["last"].isNull() | (x - a["last"] >= gap),
        F.struct((a["n"] + 1).alias("n"), x.alias("last"))).otherwise(a), lambda a: a["n"])


def _greedy_picks(p: Column, gap: Column, most: int | None) -> Column:
    def room(a: Column) -> Column:
        return F.lit(True) if most is None else F.size(a) < most

    return F.aggregate(p, F.array().cast("array<bigint>"), lambda a, x: F.when(
        room(a) & ((F.size(a) == 0) | (x - F.element_at(a, -1) >= gap)), F.array_append(a, x)).otherwise(a))


def _best_gap(p: Column, n: int, min_gap: int) -> Column:
    """Binary search on the gap, with its exact trace: a gap not above ``min_gap`` fails and moves down."""
    span = F.element_at(p, -1) - F.element_at(p, 1)
    start = F.struct(F.lit(0).cast("bigint").alias("lo"), span.alias("hi"), F.lit(-1).cast("bigint").alias("best"))
    # the range halves every round: bits(span) + 1 rounds end it, further rounds leave the state alone
    rounds = F.sequence(F.lit(1), F.length(F.bin(span)) + 1)

    def step(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("bigint")
        # more picks than n fit only if n - 1 gaps fit, and ceil(size / gap) picks always fit
        fits = F.when(mid * (n - 1) > span, False).when(mid * n <= F.size(p), True).otherwise(
            _greedy_count(p, mid) >= n)
        ok = (mid > min_gap) & fits
        return F.when(a["lo"] > a["hi"], a).when(ok, F.struct(
            (mid + 1).alias("lo"), a["hi"].alias("hi"), mid.alias("best"))).otherwise(F.struct(
                a["lo"].alias("lo"), (mid - 1).alias("hi"), a["best"].alias("best")))

    return F.aggregate(rounds, start, step, lambda a: a["best"])


def spaced_array(p: Column, n: int, min_gap: int = 1, keep_all: bool = False) -> Column:
    """Positions of the sorted array ``p`` that are chosen; ``keep_all`` is the earlier variant.

    The earlier variant searches even when there are few positions, keeps every greedy pick of the best gap
    instead of the first ``n``, and falls back to all positions.
    """
    def choose(best: Column) -> Column:
        picks = _greedy_picks(p, best, None if keep_all else n)
        return F.when(best < 0, p if keep_all else F.slice(p, 1, n)).otherwise(picks)

    found = F.element_at(F.transform(F.array(_best_gap(p, n, min_gap)), choose), 1)
    if keep_all:
        return F.when(F.size(p) == 0, p).otherwise(found)
    return F.when(F.size(p) <= n, p).otherwise(found)


class _Bits:
    """Sorted positions held as bitmaps of ``BUCKET`` places; a few of them are spelled out at a time."""

    def __init__(self, numbers: list[int], bitmaps: list[bytes]):
        order = sorted(range(len(numbers)), key=numbers.__getitem__)
        self.numbers, self.bitmaps = [numbers[i] for i in order], [bitmaps[i] for i in order]
        self.lows = [(b - 1) * BUCKET + 1 for b in self.numbers]
        self.size = sum(int.from_bytes(m, "little").bit_count() for m in self.bitmaps)
        self.spelled: dict[int, list[int]] = {}
        self.first, self.last = self.values(0)[0], self.values(len(order) - 1)[-1]

    def values(self, i: int) -> list[int]:
        if i not in self.spelled:
            if len(self.spelled) >= SPELLED:
                self.spelled.clear()
            at = np.flatnonzero(np.unpackbits(np.frombuffer(self.bitmaps[i], np.uint8), bitorder="little"))
            b = self.numbers[i]
            # places count up from the bucket's start, or down from it where positions are not above zero
            self.spelled[i] = ((b - 1) * BUCKET + 1 + at if b > 0 else (b * BUCKET - at)[::-1]).tolist()
        return self.spelled[i]

    def after(self, x: int) -> int | None:
        """The smallest position that is not below ``x``."""
        i = max(bisect_right(self.lows, x) - 1, 0)
        held = self.values(i)
        j = bisect_left(held, x)
        if j < len(held):
            return held[j]
        return self.values(i + 1)[0] if i + 1 < len(self.numbers) else None

    def picks(self, gap: int, most: int | None) -> Iterator[int]:
        """The first position, and on from each pick the next at least ``gap`` away."""
        at, taken = self.first, 0
        while at is not None and (most is None or taken < most):
            yield at
            at, taken = self.after(at + max(gap, 1)), taken + 1

    def spaced(self, n: int, min_gap: int, keep_all: bool) -> list[int]:
        """What ``spaced_array`` chooses, by the same search."""
        if not keep_all and self.size <= n:
            return list(self.picks(1, None))
        span, best = self.last - self.first, -1
        lo, hi = 0, span
        while lo <= hi:
            mid = (lo + hi) // 2
            # more picks than n fit only if n - 1 gaps fit, and ceil(size / gap) picks always fit
            fits = mid > min_gap and mid * (n - 1) <= span and (mid * n <= self.size or sum(1 for _ in self.picks(mid, n)) >= n)
            if fits:
                lo, best = mid + 1, mid
            else:
                hi = mid - 1
        return list(self.picks(max(best, 1), None if keep_all else n))


def _choose(n: int, min_gap: int, keep_all: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            picks = [_Bits([b["number"] for b in held], [b["bits"] for b in held]).spaced(n, min_gap, keep_all) for held in rb.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(picks, pa.list_(pa.int64()))], names=[rb.schema.names[0], "picks"])
    return run


def selected_arrays(sites: DataFrame, gene: str, pos: str, n: int, min_gap: int = 1, keep_all: bool = False) -> DataFrame:
    """(gene, picks): the chosen positions of each gene, ascending.

    Positions are bits: rows become bitmaps of 32,768 places per gene and bucket on the map side, however many rows (copies, isoforms) carry them, so
    a gene brings together an eighth of a byte per base of its locus. The search steps from pick to pick, n steps a round.
    """
    at = F.col(pos).cast("bigint")
    bits = (sites.filter(F.col(pos).isNotNull()).groupBy(gene, F.bitmap_bucket_number(at).alias("_number"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")))
    held = bits.groupBy(gene).agg(F.collect_list(F.struct(F.col("_number").alias("number"), F.col("_bits").alias("bits"))).alias("_held"))
    schema = T.StructType([held.schema[gene], T.StructField("picks", T.ArrayType(T.LongType()))])
    return held.select(gene, "_held").mapInArrow(_choose(n, min_gap, keep_all), schema)


def selected_positions(sites: DataFrame, gene: str, pos: str, n: int, min_gap: int = 1,
                       keep_all: bool = False) -> DataFrame:
    """(gene, pos) of the chosen positions."""
    return selected_arrays(sites, gene, pos, n, min_gap, keep_all).select(gene, F.explode("picks").alias(pos))


def spaced_selection(sites: DataFrame, gene: str, pos: str, n: int, min_gap: int = 1,
                     keep_all: bool = False) -> DataFrame:
    """Sites whose position is chosen for their gene; rows that share a chosen position all stay."""
    return sites.join(selected_positions(sites, gene, pos, n, min_gap, keep_all), [gene, pos], "left_semi")
