"""Arrow kernels on columns of short strings: rows of one length at a time, as a matrix of letters.

Column expressions with lambdas are interpreted letter by letter; these kernels take a batch at once. Each is a column function as
before, so callers stay plain expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import functions as F

_PAIRED = str.maketrans("ACGT", "TGCA")
#: Letters of a matrix that is worked on at a time.
CELLS = 1 << 18


def kernel(returns: str):
    """Column function from the maker of a function of Arrow arrays; made once per application, so that equal expressions stay equal."""
    def wrap(make):
        @lru_cache(maxsize=None)
        def held(application: str, *args):
            return F.arrow_udf(make(*args), returns, F.ArrowUDFType.SCALAR)

        def get(*args):
            return held(SparkContext.getOrCreate().applicationId, *args)

        get.plain, get.__doc__ = make, make.__doc__
        return get
    return wrap


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters, ends): bytes where all is ASCII, else code points. A null is empty."""
    texts = pa.array(texts.cast(pa.string()).fill_null("").to_pylist()) if texts.offset else texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1).astype(np.int64)
    letters = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[-1])) if ends[-1] else np.zeros(0, np.uint8)
    if not len(letters) or letters.max() < 128:
        return letters, ends
    held = texts.to_pylist()
    return np.frombuffer("".join(held).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(s) for s in held])])


def blocks(*columns: pa.Array) -> Iterator[tuple]:
    """(rows, matrix of each column): rows whose texts have the same lengths; rows with a null are left out."""
    flat = [_flat(c) for c in columns]
    known = np.ones(len(columns[0]), bool)
    for c in columns:
        if c.null_count:
            known &= c.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.stack([np.diff(ends) for _, ends in flat], 1)
    order = np.flatnonzero(known)
    order = order[np.lexsort(sizes[order].T)]
    if not len(order):
        return
    cuts = np.flatnonzero((np.diff(sizes[order], axis=0) != 0).any(1)) + 1
    for group in np.split(order, cuts):
        lengths = sizes[group[0]]
        step = max(1, CELLS // max(1, int(lengths.max())))
        for i in range(0, len(group), step):
            rows = group[i:i + step]
            yield (rows, *[letters[ends[rows][:, None] + np.arange(n)] for (letters, ends), n in zip(flat, lengths.tolist())])


def _looked_up(letters: np.ndarray, table: np.ndarray, other: int) -> np.ndarray:
    return table[letters] if letters.dtype == np.uint8 else np.where(letters < 256, table[np.minimum(letters, 255)], other)


@kernel("bigint")
def step_total(weights: tuple[int, ...]):
    """Column function: sum of the 16 ``weights`` over the dinucleotides; null below two letters or with any but A, C, G, T."""
    table = np.full(256, 4, np.uint8)
    table[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
    held = np.array(weights, np.int64)

    def total(texts: pa.Array) -> pa.Array:
        out, known = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        for rows, m in blocks(texts):
            if m.shape[1] < 2:
                continue
            code = _looked_up(m, table, 4)
            known[rows] = (code < 4).all(1)
            code = np.minimum(code, 3)
            out[rows] = held[code[:, :-1] * 4 + code[:, 1:]].sum(1)
        return pa.array(out, mask=~known)

    return total


@kernel("int")
def overlap():
    """Column function of (a, b): longest suffix of a that is a prefix of b; 0 where there is none or one is null."""
    def longest(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), np.int32)
        for rows, x, y in blocks(a, b):
            left = np.arange(len(rows))
            for i in range(min(x.shape[1], y.shape[1]), 0, -1):
                # most rows differ in the first or the last letter
                near = left[(x[left, -i] == y[left, 0]) & (x[left, -1] == y[left, i - 1])]
                near = near[(x[near, x.shape[1] - i:] == y[near, :i]).all(1)]
                if len(near):
                    out[rows[near]] = i
                    left = np.setdiff1d(left, near, assume_unique=True)
        return pa.array(out)

    return longest


@kernel("boolean")
def repeats(k: int):
    """Column function: some ``k`` letters come again further on, not overlapping themselves; null for null."""
    def found(texts: pa.Array) -> pa.Array:
        out, known = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
        for rows, m in blocks(texts):
            known[rows] = True
            n, left = m.shape[1], np.arange(len(rows))
            for d in range(k, n - k + 1):
                same = m[:, d:] == m[:, :n - d]
                # runs of k equal letters, put together from runs of powers of two
                have = 1
                while have < k:
                    more = min(have, k - have)
                    same = same[:, :-more] & same[:, more:]
                    have += more
                hit = same.any(1)
                if hit.any():
                    out[rows[left[hit]]] = True
                    m, left = m[~hit], left[~hit]
                    if not len(left):
                        break
        return pa.array(out, mask=~known)

    return found


@kernel("int")
def stem(loop: int):
    """Column function: most pairs in a row that a strand can fold into around at least ``loop`` letters; 0 for null."""
    paired = np.arange(256, dtype=np.uint32)
    for a, b in zip("ACGT", "ACGT".translate(_PAIRED)):
        paired[ord(a)] = ord(b)

    def longest(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.int32)
        for rows, m in blocks(texts):
            n = m.shape[1]
            other = paired.astype(np.uint8)[m] if m.dtype == np.uint8 else np.where(m < 256, paired[np.minimum(m, 255)], m)
            kind = np.uint8 if n < 512 else np.int32
            best = np.zeros(len(rows), kind)
            # runs of pairs from the outside in: (p, p + gap) goes on from (p - 1, p + gap + 1)
            outer = {n: np.zeros((len(rows), 0), kind), n + 1: np.zeros((len(rows), 0), kind)}
            for gap in range(n - 1, max(loop, 0), -1):
                run = np.zeros((len(rows), n - gap), kind)
                before = outer.pop(gap + 2, None)
                if before is not None and before.shape[1]:
                    run[:, 1:1 + before.shape[1]] = before
                run += 1
                run *= m[:, gap:] == other[:, :n - gap]
                outer[gap] = run
                best = np.maximum(best, run.max(1))
            out[rows] = best
        return pa.array(out)

    return longest


@kernel("string")
def others(allowed: str):
    """Column function: the distinct letters outside ``allowed``, sorted, as a string; null for null."""
    listed = np.zeros(256, bool)
    listed[np.frombuffer(allowed.encode(), np.uint8)] = True

    def left(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), None, object)
        for rows, m in blocks(texts):
            if m.dtype != np.uint8:
                out[rows] = ["".join(sorted({chr(c) for c in line} - set(allowed))) for line in m.tolist()]
                continue
            seen = np.zeros((len(rows), 256), bool)
            seen[np.arange(len(rows))[:, None], m] = True
            seen[:, listed] = False
            at, letter = np.nonzero(seen)
            text = letter.astype(np.uint8).tobytes().decode()
            cuts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(rows)))]).tolist()
            out[rows] = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        return pa.array(out, pa.string())

    return left
