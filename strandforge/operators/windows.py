"""Window generators: every fixed-length window with exact rolling sums.

Sequences are cut into overlapping pieces on the JVM side, so no task holds more than a piece at a time and
no base row is ever shuffled. The rolling sums themselves are differences of prefix sums over a piece; that
kernel is the only Python here (Arrow in, Arrow out). Temperatures, thresholds and selection stay in Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.sequence import revcomp
from ..functions.thermo import TABLES, NearestNeighbour, melting_point, melting_points

PIECE = 16384
_COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}
_SUMS = ["h_a", "s_a", "h_b", "s_b", "h_j", "s_j"]


def cut_pieces(df: DataFrame, seq: str, overlap: int, size: int = PIECE) -> DataFrame:
    """One row per piece of ``seq`` with ``piece``, ``piece_no`` and ``piece_start`` (0-based).

    Each piece carries the first ``overlap`` letters of the next one, so a window lies whole in the piece
    in which it starts. Cutting is one linear pass over the text.
    """
    size = max(size, overlap)
    parts = F.when(F.length(seq) <= size, F.array(F.col(seq))).otherwise(
        F.regexp_extract_all(F.col(seq), F.lit("(?s).{1,%d}" % size), F.lit(0)))
    # the last element pairs with null, whose left() is null and reads as empty
    with_next = F.zip_with("_parts", F.slice("_parts", 2, F.size("_parts")), lambda a, b: F.concat(
        a, F.coalesce(F.left(b, F.lit(overlap)), F.lit(""))))
    keep = [c for c in df.columns if c != seq]
    return (df.withColumn("_parts", parts)
            .select(*keep, F.length(seq).cast("bigint").alias("seq_len"),
                    F.posexplode(with_next).alias("piece_no", "piece"))
            .withColumn("piece_start", F.col("piece_no").cast("bigint") * size)
            .withColumn("piece_size", F.lit(size).cast("bigint")))


def _prefix(values: np.ndarray, pad: int) -> np.ndarray:
    out = np.zeros(len(values) + pad, np.int32 if len(values) < 1 << 22 else np.int64)
    np.cumsum(values, out=out[1:len(values) + 1])
    return out


def _near_limits(length: int, cut: int, table: NearestNeighbour, t):
    """Test that keeps every window within the limits ``t`` and few others: temperatures have a margin, ``passing`` decides."""
    def within(x: np.ndarray) -> np.ndarray:
        return (x > t.min_tm - 1e-6) & (x < t.max_tm + 1e-6)

    def share(n_base: np.ndarray) -> np.ndarray:
        return (n_base / length > t.min_g - 1e-6) & (n_base / length < t.max_g + 1e-6)

    def fits(sums: list[np.ndarray]) -> np.ndarray:
        front, back = melting_points(sums[0], sums[1], cut, table), melting_points(sums[2], sums[3], length - cut, table)
        whole = melting_points(sums[0] + sums[2] + sums[4], sums[1] + sums[3] + sums[5], length, table)
        return within(front) & within(back) & within(whole) & (np.abs(front - back) < t.max_tm_diff + 1e-6)

    return share, fits


def _rolling(length: int, cut: int, weights: np.ndarray, rotated: bool, base: int, keys: list[str], near=None, target: bool = True, listed: bool = False):
    """Kernel: for every window start in [win_from, win_to) of a piece, sums of its two parts; ``near`` leaves windows out early. ``listed``: a row
    per piece, which holds its windows as a list, so that keys are not copied to every window."""
    codes = np.full(256, 4, np.uint8)
    codes[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
    weights = weights.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            text = rb.column("piece")
            ends = np.frombuffer(text.buffers()[1], np.int32, rb.num_rows + 1, text.offset * 4).astype(np.int64)
            letters = np.frombuffer(text.buffers()[2], np.uint8) if ends[-1] else np.zeros(0, np.uint8)
            lo = rb.column("win_from").to_numpy()
            hi = rb.column("win_to").to_numpy()
            row = 0
            while row < rb.num_rows:          # about a quarter of a million letters at a time, whatever the batch size
                stop = min(rb.num_rows, max(row + 1, int(np.searchsorted(ends, ends[row] + (1 << 18)))))
                s = letters[ends[row]:ends[stop]]
                start = ends[row:stop] - ends[row]
                size = ends[row + 1:stop + 1] - ends[row:stop]
                first = np.maximum(lo[row:stop], 0)
                count = np.maximum(np.minimum(hi[row:stop], size - length + 1) - first, 0)
                total = int(count.sum())
                if total:
                    code = codes[s]
                    bad = _prefix(code == 4, 1)
                    hit = _prefix(code == base, 1)
                    code = np.minimum(code, 3)
                    step = code[:-1] * 4 + code[1:]
                    owner = np.repeat(np.arange(stop - row), count)
                    rel = np.arange(total) - np.repeat(np.cumsum(count) - count - first, count)
                    p = start[owner] + rel
                    n_base = hit[p + length] - hit[p]
                    if near:
                        kept = np.flatnonzero(near[0](n_base))
                        owner, rel, p, n_base = owner[kept], rel[kept], p[kept], n_base[kept]
                    h, e = _prefix(weights[0][step], 1), _prefix(weights[1][step], 1)
                    if rotated:
                        seam = code[p + length - 1] * 4 + code[p]
                    else:
                        seam = code[p + cut - 1] * 4 + code[p + cut]
                    sums = [h[p + cut - 1] - h[p], e[p + cut - 1] - e[p],
                            h[p + length - 1] - h[p + cut], e[p + length - 1] - e[p + cut],
                            weights[0][seam], weights[1][seam]]
                    if near:
                        kept = np.flatnonzero(near[1](sums))
                        owner, rel, p, n_base, sums = owner[kept], rel[kept], p[kept], n_base[kept], [x[kept] for x in sums]
                    texts = []
                    if target:
                        view = np.lib.stride_tricks.sliding_window_view(s, length)[p]
                        texts = [pa.StringArray.from_buffers(
                            len(p), pa.py_buffer(np.arange(0, length * len(p) + 1, length, dtype=np.int32)),
                            pa.py_buffer(np.ascontiguousarray(view)))]
                    names = ["rel", *["target"][:len(texts)], "n_base", "n_bad"] + _SUMS
                    columns = [pa.array(rel), *texts, pa.array(n_base.astype(np.int32)), pa.array((bad[p + length] - bad[p]).astype(np.int32)),
                               *[pa.array(x.astype(np.int32)) for x in sums]]
                    if listed:
                        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=stop - row))]).astype(np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(columns, names))
                        yield pa.RecordBatch.from_arrays([*[rb.column(k).slice(row, stop - row) for k in keys], lists], names=[*keys, "windows"])
                    else:
                        index = pa.array(owner + row)
                        yield pa.RecordBatch.from_arrays([rb.column(k).take(index) for k in keys] + columns, names=keys + names)
                row = stop

    return run


def _weights(table: NearestNeighbour, complement: bool) -> np.ndarray:
    """16 step weights indexed by the letters of the *target*, for the strand that is actually read."""
    rows = []
    for a in "ACGT":
        for b in "ACGT":
            rows.append(table.steps[_COMPLEMENT[b] + _COMPLEMENT[a]] if complement else table.steps[a + b])
    return np.array(rows, np.int64).T.copy()


def _fields(target: bool) -> list[T.StructField]:
    return [T.StructField("rel", T.LongType()), *[T.StructField("target", T.StringType())][:int(target)],
            *[T.StructField(c, T.IntegerType()) for c in ("n_base", "n_bad", *_SUMS)]]


def rolling_windows(pieces: DataFrame, keys: list[str], length: int, probe_strand: bool = True,
                    table: NearestNeighbour = TABLES["DNA_RNA"], limits=None, target: bool = True, listed: bool = False) -> DataFrame:
    """All windows of ``pieces`` that start in ``[win_from, win_to)`` (piece coordinates).

    ``probe_strand=True`` reads the reverse complement with its halves rotated, as probes are scored;
    ``False`` reads the target itself. Adds ``rel``, ``target``, ``n_base`` (G of the strand read),
    ``n_bad`` and the six sums, in which ``a`` is the front part of the target and ``j`` the seam.
    With ``limits`` most windows that ``filters.passing`` would drop stay in the kernel; it is still to be applied. ``target=False``
    leaves the text of the windows out. ``listed`` brings the windows of a piece out of the kernel as one row, for short pieces with wide keys.
    """
    cut = length - length // 2 if probe_strand else length // 2
    ends_count = bool(table.end_at_h or table.end_at_s)
    if ends_count and not target:
        raise ValueError("this table corrects for the ends of a duplex, which are read from the target")
    near = _near_limits(length, cut, table, limits) if limits is not None and not ends_count else None
    kernel = _rolling(length, cut, _weights(table, probe_strand), probe_strand,
                      "ACGT".index("C" if probe_strand else "G"), keys, near, target, listed)
    fields = _fields(target)
    held, rows = [pieces.schema[k] for k in keys], pieces.select(*keys, "piece", F.col("win_from").cast("bigint").alias("win_from"),
                                                                 F.col("win_to").cast("bigint").alias("win_to"))
    if listed:
        lists = T.StructField("windows", T.ArrayType(T.StructType(fields)))
        return rows.mapInArrow(kernel, T.StructType([*held, lists])).select(*keys, F.inline("windows"))
    return rows.mapInArrow(kernel, T.StructType([*held, *fields]))


def with_metrics(windows: DataFrame, length: int, probe_strand: bool = True,
                 table: NearestNeighbour = TABLES["DNA_RNA"]) -> DataFrame:
    """Turn sums into G content and the three temperatures. Null temperatures where a letter is unknown."""
    cut = length - length // 2 if probe_strand else length // 2
    known = F.col("n_bad") == 0

    def tm(h: Column, s: Column, n: int, *ends: int) -> Column:
        # A and T pair with each other, so either strand has the same ends
        weak = sum((F.substring("target", i + 1, 1).isin("A", "T").cast("int") for i in ends), F.lit(0)) if table.end_at_h or table.end_at_s else None
        return F.when(known, melting_point(h, s, n, table, weak))

    front = tm(F.col("h_a"), F.col("s_a"), cut, 0, cut - 1)
    back = tm(F.col("h_b"), F.col("s_b"), length - cut, cut, length - 1)
    outer = (cut, cut - 1) if probe_strand else (0, length - 1)
    whole = tm(F.col("h_a") + F.col("h_b") + F.col("h_j"), F.col("s_a") + F.col("s_b") + F.col("s_j"), length, *outer)
    # on either reading the front of the target pairs with the 5' arm
    return (windows.withColumn("g_content", F.col("n_base") / F.lit(float(length)))
            .withColumn("tm", whole).withColumn("tm_5", front).withColumn("tm_3", back)
            .withColumn("tm_diff", F.abs(F.col("tm_5") - F.col("tm_3")))
            .drop(*_SUMS, "n_base"))


def rotated_target(length: int) -> Column:
    """The target whose reverse complement is the rotated probe."""
    cut = length - length // 2
    return F.concat(F.substring("target", cut + 1, length), F.substring("target", 1, cut))


def margin(length: Column | str, share: float) -> Column:
    return F.floor((F.col(length) if isinstance(length, str) else length) * F.lit(share)).cast("bigint")


def windows_between(seqs: DataFrame, keys: list[str], lo: Column, hi: Column, length: int = 40,
                    probe_strand: bool = True, seq: str = "seq",
                    table: NearestNeighbour = TABLES["DNA_RNA"], limits=None, target: bool = True) -> DataFrame:
    """Every window start in ``[lo, hi)``, both given over ``keys`` and ``seq_len``, with its metrics; ``limits`` and ``target`` as in ``rolling_windows``."""
    pieces = (cut_pieces(seqs.select(*keys, seq), seq, length - 1)
              .withColumn("win_from", F.greatest(lo - F.col("piece_start"), F.lit(0)))
              .withColumn("win_to", F.least(hi - F.col("piece_start"), F.col("piece_size")))
              .filter("win_to > win_from"))
    out = rolling_windows(pieces, keys + ["seq_len", "piece_start"], length, probe_strand, table, limits, target)
    return with_metrics(out.withColumn("pos", F.col("piece_start") + F.col("rel"))
                        .drop("piece_start", "rel"), length, probe_strand, table)


def windows_bruteforce(seqs: DataFrame, keys: list[str], length: int = 40, share: float = 0.1,
                       probe_strand: bool = True, seq: str = "seq",
                       table: NearestNeighbour = TABLES["DNA_RNA"], limits=None, target: bool = True) -> DataFrame:
    """Every window start in ``[int(share*len), len - int(share*len) - length)`` with its metrics."""
    edge = margin("seq_len", share)
    return windows_between(seqs, keys, edge, F.col("seq_len") - edge - length, length, probe_strand, seq, table, limits, target)


def windows_at(seqs: DataFrame, keys: list[str], positions: str, length: int = 40, seq: str = "seq",
               table: NearestNeighbour = TABLES["DNA_RNA"]) -> DataFrame:
    """The windows that start at the array ``positions`` of each sequence, with their metrics."""
    cut = length - length // 2
    rolling = _rolling(length, cut, _weights(table, True), True, "ACGT".index("C"), [*keys, "pos"])
    texts = _cut_at(length, keys, seq, positions)
    rows = seqs.select(*keys, seq, positions)
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("pos", T.LongType()), *_fields(True)])
    return with_metrics(rows.mapInArrow(lambda batches: rolling(texts(batches)), schema).drop("rel"), length, True, table)


def _cut_at(length: int, keys: list[str], seq: str, positions: str):
    """Kernel: the ``length`` letters at each of the positions of a row, as pieces of one window; those that do not lie in the sequence are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            lists, text = rb.column(positions), rb.column(seq)
            at = lists.flatten()
            owner = np.repeat(np.arange(rb.num_rows), pa.compute.list_value_length(lists).fill_null(0).to_numpy())
            owner, at = owner[at.is_valid().to_numpy(zero_copy_only=False)], at.drop_null().to_numpy()
            ends = np.frombuffer(text.buffers()[1], np.int32, rb.num_rows + 1, text.offset * 4).astype(np.int64)
            letters = np.frombuffer(text.buffers()[2], np.uint8) if ends[-1] else np.zeros(0, np.uint8)
            inside = (at >= 0) & (at + length <= np.diff(ends)[owner])
            owner, at = owner[inside], at[inside].astype(np.int64)
            if len(at):
                cut = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(letters, length)[ends[owner] + at])
                pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.arange(0, length * len(at) + 1, length, dtype=np.int32)), pa.py_buffer(cut))
                index = pa.array(owner)
                yield pa.RecordBatch.from_arrays([*[rb.column(k).take(index) for k in keys], pa.array(at), pieces, pa.array(np.zeros(len(at), np.int64)),
                                                  pa.array(np.ones(len(at), np.int64))], names=[*keys, "pos", "piece", "win_from", "win_to"])

    return run


def windows_on_strand(seqs: DataFrame, keys: list[str], strand: str = "strand", length: int = 40,
                      share: float = 0.1, seq: str = "seq") -> DataFrame:
    """Target-strand windows: on strand -1 the target is the reverse complement of the window.

    The sequence is turned once, not every window; ``start`` and ``end`` stay in its given direction.
    """
    turned = seqs.withColumn(seq, F.when(F.col(strand) == -1, revcomp(seq)).otherwise(F.col(seq)))
    edge, back = margin("seq_len", share), (F.col(strand) == -1).cast("int")
    out = windows_between(turned, [*keys, strand], edge + back, F.col("seq_len") - edge - length + back,
                          length, probe_strand=False, seq=seq)
    start = F.when(F.col(strand) == -1, F.col("seq_len") - length - F.col("pos")).otherwise(F.col("pos"))
    return out.withColumn("start", start).withColumn("end", F.col("start") + length).drop("pos")


def windows_junction(seqs: DataFrame, keys: list[str], length: int = 40, reach: int = 100, step: int = 5,
                     seq: str = "seq") -> DataFrame:
    """Starts around one third and two thirds of the sequence, every ``step`` bases; ``ord`` is their order."""
    n = F.length(seq).cast("bigint")
    centres = F.array(F.floor(n / 3).cast("bigint"), F.floor(n * 2 / 3).cast("bigint"))
    around = (seqs.select(*keys, seq, n.alias("seq_len"), F.posexplode(centres).alias("centre_no", "centre"))
              .withColumn("first", F.greatest(F.col("centre") - reach, F.lit(0)))
              .withColumn("last", F.least(F.col("seq_len") - length, F.col("centre") + reach))
              .filter("last > first")
              .withColumn("piece", F.col(seq).substr((F.col("first") + 1).cast("int"),
                                                     (F.col("last") - F.col("first") + length).cast("int")))
              .withColumn("win_from", F.lit(0)).withColumn("win_to", F.col("last") - F.col("first")))
    out = (rolling_windows(around, keys + ["seq_len", "centre_no", "first"], length)
           .filter(F.col("rel") % step == 0)
           .withColumn("pos", F.col("first") + F.col("rel"))
           .withColumn("ord", F.col("centre_no").cast("bigint") * (2 * reach) + F.col("rel")))
    return with_metrics(out.drop("first", "rel", "centre_no"), length)


def windows_tiled(seqs: DataFrame, keys: list[str], length: int = 40, most: int = 30, seq: str = "seq") -> DataFrame:
    """Non-overlapping tiles of the reverse complement, centred, at most ``2*most`` of them per sequence."""
    n = F.length(seq).cast("bigint")
    tiles = F.least(F.floor(n / length).cast("bigint"), F.lit(2 * most).cast("bigint"))
    middle = (seqs.select(*keys, revcomp(seq).alias("_minus"), n.alias("_n"), tiles.alias("_tiles"))
              .filter("_tiles > 0")
              .withColumn("_st", F.floor(F.col("_n") / 2).cast("bigint") - F.floor(F.col("_tiles") * length / 2).cast("bigint")))
    core = F.col("_minus").substr((F.col("_st") + 1).cast("int"), (F.col("_tiles") * length).cast("int"))
    return (middle.select(*keys, "_st", F.posexplode(F.regexp_extract_all(core, F.lit(".{%d}" % length), F.lit(0)))
                          .alias("tile_no", "binding"))
            .select(*keys, F.col("tile_no").cast("bigint").alias("tile_no"),
                    (F.col("_st") + F.col("tile_no") * length).alias("pos"), "binding"))


def windows_random(seqs: DataFrame, keys: list[str], length: int, count: int, seed: int, seq: str = "seq") -> DataFrame:
    """``count`` distinct starts per sequence: those with the smallest seeded hash of (key, start).

    The draw is per sequence row, inside one expression: no shuffle, repeatable after a lost executor.
    Sequences too short for ``count`` windows of that length give none; ``random_rejects`` lists them.
    """
    n = F.length(seq)
    starts = F.sequence(F.lit(0), n - length)
    drawn = F.slice(F.sort_array(F.transform(starts, lambda p: F.struct(
        F.xxhash64(*[F.col(k) for k in keys], p, F.lit(seed)).alias("h"), p.alias("p")))), 1, count)
    return (seqs.filter((n >= length) & (n >= length * count))
            .select(*keys, seq, F.explode(drawn).alias("d"))
            .select(*keys, F.col("d.p").cast("bigint").alias("pos"),
                    F.col(seq).substr(F.col("d.p") + 1, F.lit(length)).alias("target")))


def random_rejects(seqs: DataFrame, keys: list[str], length: int, count: int, seq: str = "seq") -> DataFrame:
    """(keys, reason): the sequences of which ``windows_random`` draws nothing."""
    n = F.length(seq)
    reason = F.when(n.isNull(), "null").when((n < length) | (n < length * count), "too short")
    return seqs.select(*keys, reason.alias("reason")).filter("reason IS NOT NULL")
