"""Kernels that weigh all pairs of arm lengths around a point, for many points at once."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from ..functions.letters import blocks, kernel
from ..functions.thermo import DNA_RNA, melting_points

_PAIRED = {"A": "T", "C": "G", "G": "C", "T": "A"}
PAIR = "struct<arm5_len:int,arm3_len:int,tm5:double,tm3:double,score:double>"
FIGURES = "struct<n:bigint,n5:bigint,n3:bigint,bds5:string,bds3:string,tm5:double,tm3:double,score:bigint>"


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """As Spark rounds: half up on the decimals of the number. What lies next to a tie is rounded by them."""
    up = x * 10.0 ** digits
    out = np.rint(up)
    near = np.flatnonzero((np.abs(up - out) >= 0.499).ravel())
    out = (out + 0.0) / 10.0 ** digits
    step = Decimal(1).scaleb(-digits)
    for i in near.tolist():
        out.flat[i] = float(Decimal(repr(float(x.flat[i]))).quantize(step, ROUND_HALF_UP))
    return out


def _sums(m: np.ndarray, minus: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h, s, known): running sums over the dinucleotides of each row, on the other strand with ``minus``."""
    codes = np.full(256, 4, np.uint8)
    codes[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
    code = codes[m] if m.dtype == np.uint8 else np.where(m < 256, codes[np.minimum(m, 255)], 4)
    known = (code < 4).all(1) & (m.shape[1] > 1)
    code = np.minimum(code, 3)
    steps = [DNA_RNA[_PAIRED[b] + _PAIRED[a] if minus else a + b] for a in "ACGT" for b in "ACGT"]
    out = []
    for i in (0, 1):
        sums = np.zeros((len(m), max(1, m.shape[1])), np.int64)
        if m.shape[1] > 1:
            np.cumsum(np.array([x[i] for x in steps])[code[:, :-1] * 4 + code[:, 1:]], axis=1, out=sums[:, 1:])
        out.append(sums)
    return out[0], out[1], known


def _melted(h: np.ndarray, s: np.ndarray, a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Temperatures of [a, b) of each row, where ``ok``."""
    at, end = np.where(ok, a, 0), np.where(ok, b - 1, 0)
    rows = np.arange(len(h))[:, None]
    return melting_points(h[rows, end] - h[rows, at], s[rows, end] - s[rows, at], np.where(ok, b - a, 2))


def _texts(m: np.ndarray, rows: np.ndarray, a: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Reverse complements of [a, a + size) of the rows as numpy strings; empty where the size is 0."""
    paired = np.arange(256, dtype=np.uint32)
    for x, y in _PAIRED.items():
        paired[ord(x)] = ord(y)
    other = (paired.astype(np.uint8)[m] if m.dtype == np.uint8 else np.where(m < 256, paired[np.minimum(m, 255)], m)).astype(m.dtype)
    most = max(1, int(sizes.max(initial=1)))
    back = sizes[:, None] - 1 - np.arange(most)
    if not m.shape[1]:
        return np.zeros(len(rows), f"S{most}")
    text = other.ravel()[np.where(back >= 0, rows[:, None] * m.shape[1] + a[:, None] + back, 0)]
    text[back < 0] = 0
    return np.ascontiguousarray(text).view(f"{'S' if m.dtype == np.uint8 else 'U'}{most}")[:, 0]


def _largest(m: np.ndarray, first: np.ndarray, sizes: np.ndarray, ok: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the arms [first, first + size) has the largest reverse complement: numbers to the base 5, whose first digits are the last letters."""
    most = int(sizes[-1])
    digits = np.zeros(256, np.int64)
    digits[np.frombuffer(b"TGCA", np.uint8)] = np.arange(1, 5)
    at = first + np.arange(most)
    inside = (at >= 0) & (at < m.shape[1])
    letters = m[np.arange(len(m))[:, None], np.where(inside, at, 0)] if m.shape[1] else np.zeros(at.shape, np.uint8)
    value = np.cumsum(np.where(inside, digits[np.minimum(letters, 255)], 0) * 5 ** np.arange(most, dtype=np.int64), axis=1)[:, sizes - 1]
    pick = np.where(ok, value * 5 ** (most - sizes), -1).argmax(1)
    other = np.flatnonzero(~known & ok.any(1))
    if len(other) or most > 26:
        other = np.arange(len(m)) if most > 26 else other
        rows, at = np.nonzero(ok[other])
        texts = np.zeros((len(other), len(sizes)), f"U{most}")
        texts[rows, at] = _strings(_texts(m, other[rows], first[other[rows], 0], sizes[at])).to_pylist()
        pick[other] = np.argsort(texts, axis=1, kind="stable")[:, -1]
    return pick


def _strings(x: np.ndarray) -> pa.Array:
    return pa.array(x).cast(pa.string())


def _weighed(shortest: int, longest: int, start: int):
    """Of a block of points: every pair of their arm lengths, in order, with temperatures and scores in hundredths."""
    sizes = np.arange(shortest, longest + 1)

    def run(m: np.ndarray, pos5: np.ndarray, pos3: np.ndarray, energy: np.ndarray):
        h, s, known = _sums(m)
        cut, first, n = pos5[:, None] + 1, pos3[:, None], m.shape[1]
        ok5, ok3 = (sizes <= cut) & (cut <= n), (first >= 0) & (first + sizes <= n)
        tm5 = rounded(_melted(h, s, cut - sizes, np.broadcast_to(cut, ok5.shape), ok5), 2)
        tm3 = rounded(_melted(h, s, np.broadcast_to(first, ok3.shape), first + sizes, ok3), 2)
        off = np.abs(sizes - start)
        if energy.any():
            cents = np.rint(rounded(np.abs(tm5[:, :, None] - tm3[:, None, :]) + off[:, None] + off - energy[:, None, None], 2) * 100).astype(np.int64)
        else:
            # temperatures have two decimals, so scores are whole hundredths
            c5, c3 = (np.rint(x * 100).astype(np.int32) for x in (tm5, tm3))
            cents = np.abs(c5[:, :, None] - c3[:, None, :]) + (off[:, None] + off).astype(np.int32) * 100
        return sizes, ok5, ok3, tm5, tm3, cents, known

    return run


def _points(target: pa.Array, pos5: pa.Array, pos3: pa.Array, energy: pa.Array):
    good = pa.compute.and_(pos5.is_valid(), pos3.is_valid()).to_numpy(zero_copy_only=False)
    places = [x.fill_null(0).to_numpy(zero_copy_only=False) for x in (pos5, pos3, energy)]
    for rows, m in blocks(target):
        use = good[rows]
        rows, m = rows[use], m[use]
        for i in range(0, len(rows), 2048):
            part = rows[i:i + 2048]
            yield part, m[i:i + 2048], *[x[part] for x in places]


def _first(cents: np.ndarray, fits: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): the ``best`` smallest of each row that fit, in order; equal ones by place."""
    many = cents.shape[1]
    none = np.iinfo(np.int64).max
    by = np.where(fits, cents.astype(np.int64) * many + np.arange(many), none)
    if best < many:
        by = np.partition(by, best - 1, axis=1)[:, :best]
    by.sort(axis=1)
    r, at = np.nonzero(by != none)
    return r, by[r, at] % many


def _designs(shortest: int, longest: int, start: int, best: int | None):
    """Of flat points: where the designs of each end, and their columns; in the order of lengths, or the ``best`` by score and then lengths."""
    weigh = _weighed(shortest, longest, start)

    def made(target: pa.Array, pos5: pa.Array, pos3: pa.Array, energy: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        owner, held = [np.zeros(0, np.int64)], []
        for rows, m, p5, p3, e in _points(target, pos5, pos3, energy):
            sizes, ok5, ok3, tm5, tm3, cents, known = weigh(m, p5, p3, e)
            k, cents = len(sizes), cents.reshape(len(rows), -1)
            fits = (ok5[:, :, None] & ok3[:, None, :]).reshape(len(rows), -1)
            # no score, no difference: those of unknown letters stay in order
            r, c = np.nonzero(fits) if best is None else _first(np.where(known[:, None], cents, 0), fits, best)
            x, y, unknown = c // k, c % k, ~known[r]
            owner.append(rows[r])
            held.append([sizes[x].astype(np.int32), sizes[y].astype(np.int32), tm5[r, x], tm3[r, y], cents[r, c] / 100.0, unknown])
        rows = np.concatenate(owner)
        order = np.argsort(rows, kind="stable")
        if not held:
            held = [[np.zeros(0, np.int32)] * 2 + [np.zeros(0)] * 3 + [np.zeros(0, bool)]]
        *columns, unknown = [np.concatenate([h[i] for h in held])[order] for i in range(6)]
        return np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(target)))]), [
            pa.array(c, mask=None if i < 2 else unknown) for i, c in enumerate(columns)]

    return made


_NAMES = ["arm5_len", "arm3_len", "tm5", "tm3", "score"]


def _lists(ends: np.ndarray, columns: list[pa.Array], names: list[str]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(columns, names))


@kernel(f"array<{PAIR}>")
def pairs(shortest: int, longest: int, start: int, best: int | None):
    """Column function of (target, pos5, pos3, energy): all pairs of arms, or the ``best`` by score and then lengths."""
    weighed = _designs(shortest, longest, start, best)
    return lambda *points: _lists(*weighed(*points), _NAMES)


@kernel(f"array<{PAIR.replace('struct<', 'struct<member:int,')}>")
def ranked(shortest: int, longest: int, start: int):
    """Column function of an array of points (target, pos5, pos3, energy): the pairs of all of them by score and then lengths, with the place of their point."""
    weighed = _designs(shortest, longest, start, (longest - shortest + 1) ** 2)

    def made(points: pa.Array) -> pa.Array:
        flat = points.flatten()
        ends, columns = weighed(*[flat.field(i) for i in range(4)])
        sizes = pa.compute.list_value_length(points).fill_null(0).to_numpy()
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(len(flat)) - np.repeat(cuts[:-1], sizes)
        member = np.repeat(place, np.diff(ends))
        if (sizes > 1).any():
            row = np.repeat(np.repeat(np.arange(len(points)), sizes), np.diff(ends))
            score = columns[4].fill_null(-np.inf).to_numpy()          # no score comes first, as in a sort
            order = np.lexsort((member, columns[1].to_numpy(), columns[0].to_numpy(), score, row))
            member, columns = member[order], [c.take(pa.array(order)) for c in columns]
        return _lists(ends[cuts], [pa.array(member.astype(np.int32)), *columns], ["member", *_NAMES])

    return made


@kernel("struct<bds5:array<string>,bds3:array<string>>")
def texts(shortest: int, longest: int):
    """Column function of (target, pos5, pos3): the reverse complements of the arms of each length, null where one would run off the target."""
    sizes = np.arange(shortest, longest + 1)

    def made(target: pa.Array, pos5: pa.Array, pos3: pa.Array) -> pa.Array:
        k, none = len(sizes), pa.array(np.zeros(len(target)))
        at, held = np.full(len(target), -1), ([], [])
        for rows, m, p5, p3, _ in _points(target, pos5, pos3, none):
            n, every, size = m.shape[1], np.repeat(np.arange(len(rows)), k), np.tile(sizes, len(rows))
            cut = (p5 + 1)[:, None]
            at[rows] = np.arange(len(rows)) + sum(map(len, held[0])) // k
            for out, first, ok in zip(held, (p5[every] + 1 - size, p3[every]), ((sizes <= cut) & (cut <= n), (p3[:, None] >= 0) & (p3[:, None] + sizes <= n))):
                ok = ok.ravel()
                out.append(pa.compute.if_else(pa.array(ok), _strings(_texts(m, every, first, np.where(ok, size, 0))), pa.scalar(None, pa.string())))
        some = np.where(at < 0, 0, k)
        index = pa.array(np.repeat(at * k, some) + np.arange(int(some.sum())) % k)
        ends = pa.array(np.concatenate([[0], np.cumsum(some)]).astype(np.int32))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, (pa.chunked_array(x, pa.string()).combine_chunks() if x else pa.array([], pa.string())).take(index))
                                           for x in held], ["bds5", "bds3"])

    return made


@kernel(FIGURES)
def figures(shortest: int, longest: int, start: int):
    """Column function of (target, pos5, pos3, energy): how many pairs there are, their lengths and scores (in hundredths) added up, and the
    largest texts and temperatures. All pairs are made and weighed as in ``pairs``; none of them leaves the kernel."""
    weigh = _weighed(shortest, longest, start)

    def made(target: pa.Array, pos5: pa.Array, pos3: pa.Array, energy: pa.Array) -> pa.Array:
        n = len(target)
        whole = {c: np.zeros(n, np.int64) for c in ("n", "n5", "n3", "score")}
        temps = {c: np.zeros(n) for c in ("tm5", "tm3")}
        largest, held = {c: [] for c in ("bds5", "bds3")}, []
        melts = np.zeros(n, bool)
        for rows, m, p5, p3, e in _points(target, pos5, pos3, energy):
            sizes, ok5, ok3, tm5, tm3, cents, known = weigh(m, p5, p3, e)
            c5, c3 = ok5.sum(1), ok3.sum(1)
            whole["n"][rows], whole["n5"][rows], whole["n3"][rows] = c5 * c3, (ok5 * sizes).sum(1) * c3, (ok3 * sizes).sum(1) * c5
            whole["score"][rows] = (cents * (ok5[:, :, None] & ok3[:, None, :])).sum((1, 2), dtype=np.int64)
            temps["tm5"][rows], temps["tm3"][rows] = np.where(ok5, tm5, -np.inf).max(1), np.where(ok3, tm3, -np.inf).max(1)
            melts[rows] = known
            some = np.flatnonzero((c5 > 0) & (c3 > 0))
            held.append(rows[some])
            # of arms with the same end the longest is the largest text
            for c, pick, end in (("bds5", len(sizes) - 1 - ok5[:, ::-1].argmax(1), True), ("bds3", _largest(m, p3[:, None], sizes, ok3, known), False)):
                size = sizes[pick[some]]
                largest[c].append(_strings(_texts(m, some, p5[some] + 1 - size if end else p3[some], size)))
        none, at = ~melts | (whole["n"] == 0), np.full(n, -1)
        if held:
            at[np.concatenate(held)] = np.arange(sum(map(len, held)))
        index = pa.array(at, mask=at < 0)
        return pa.StructArray.from_arrays(
            [pa.array(whole["n"]), pa.array(whole["n5"]), pa.array(whole["n3"]), 
             *[pa.chunked_array(largest[c], pa.string()).combine_chunks().take(index) if held else pa.nulls(n, pa.string()) for c in ("bds5", "bds3")],
             *[pa.array(temps[c], mask=none) for c in ("tm5", "tm3")], pa.array(whole["score"], mask=none)],
            ["n", "n5", "n3", "bds5", "bds3", "tm5", "tm3", "score"])

    return made


@kernel("struct<left:int,right:int,tm_left:double,tm_right:double>")
def balanced(low: float, high: float, diff: float, shortest: int, longest: int, start: int):
    """Column function of (head, tail, minus): the pair of an arm at the end of head and one at the start of tail with the smallest difference, then
    closest to ``start``, then shortest; null where none is within the limits."""
    sizes = np.arange(shortest, longest + 1)
    order = np.array(sorted(((abs(a - start) + abs(b - start), a, b) for a in sizes.tolist() for b in sizes.tolist())))[:, 1:] - shortest

    def made(head: pa.Array, tail: pa.Array, minus: pa.Array) -> pa.Array:
        n, turned = len(head), minus.fill_null(False).to_numpy(zero_copy_only=False)
        left, right, found = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, bool)
        tm_left, tm_right = np.zeros(n), np.zeros(n)
        for rows, x, y in blocks(head, tail):
            for way in (False, True):
                use = np.flatnonzero(turned[rows] == way)
                for i in range(0, len(use), 2048):
                    part = use[i:i + 2048]
                    at, temps = rows[part], []
                    for m, from_end in ((x[part], True), (y[part], False)):
                        h, s, known = _sums(m, way)
                        ok = np.broadcast_to(sizes <= m.shape[1], (len(part), len(sizes))) & known[:, None]
                        a = np.broadcast_to(m.shape[1] - sizes if from_end else 0 * sizes, ok.shape)
                        t = _melted(h, s, a, a + sizes, ok)
                        temps.append(np.where(ok & (t >= low) & (t <= high), t, np.nan))
                    d = np.abs(temps[0][:, order[:, 0]] - temps[1][:, order[:, 1]])
                    d = np.where(d < diff, d, np.inf)
                    pick = d.argmin(1)
                    row = np.arange(len(part))
                    some = np.isfinite(d[row, pick])
                    i5, i3 = order[pick, 0], order[pick, 1]
                    found[at], left[at], right[at] = some, sizes[i5], sizes[i3]
                    tm_left[at], tm_right[at] = temps[0][row, i5], temps[1][row, i3]
        return pa.StructArray.from_arrays([pa.array(c, mask=~found) for c in (left, right, tm_left, tm_right)], ["left", "right", "tm_left", "tm_right"])

    return made
