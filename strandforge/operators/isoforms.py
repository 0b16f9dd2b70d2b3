"""Isoform algebra over exon fragments (splices) and windows that know which isoforms they touch.

Splices are the exons of a gene cut at every exon boundary of the gene, so they never overlap. All range
joins are equi-joins on (gene, bin): a gene with very many rows is spread over its bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.sequence import revcomp
from .filters import Thresholds, passing
from .ranking import first_per
from .spacing import selected_arrays
from .windows import PIECE, rolling_windows, windows_at, windows_between, windows_bruteforce, with_metrics

BIN = 512          # about an exon: few fragments share a bin, long exons take several


def _bins(lo: Column, hi: Column, width: int = BIN) -> Column:
    """Bins touched by the half-open interval [lo, hi)."""
    return F.explode(F.sequence(F.floor(lo / width), F.floor((hi - 1) / width)))


def locus_bounds(isoforms: DataFrame) -> DataFrame:
    """Smallest start and largest end per gene; region of its first isoform."""
    return isoforms.groupBy("gene").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                        F.min_by("region", "tx_order").alias("region"))


def exon_cuts(exons: DataFrame) -> DataFrame:
    """Exon rows with each exon boundary of their gene that lies strictly inside them (``cut``)."""
    points = exons.select("gene", F.explode(F.array("exon_start", "exon_end")).alias("cut")).distinct()
    points = points.withColumn("bin", F.floor(F.col("cut") / BIN))
    spans = (exons.select("gene", "exon_start", "exon_end").distinct().filter("exon_end > exon_start")
             .withColumn("bin", _bins(F.col("exon_start"), F.col("exon_end"))))
    return (spans.join(points, ["gene", "bin"]).filter("exon_start < cut AND cut < exon_end")
            .select("gene", "exon_start", "exon_end", "cut"))


def splices_of_exons(exons: DataFrame) -> DataFrame:
    """(gene, exon_start, exon_end, s, e): the fragments of every distinct exon."""
    cuts = exon_cuts(exons).groupBy("gene", "exon_start", "exon_end").agg(F.collect_set("cut").alias("cuts"))
    spans = exons.select("gene", "exon_start", "exon_end").distinct().join(cuts, ["gene", "exon_start", "exon_end"], "left")
    points = F.sort_array(F.concat(F.array("exon_start", "exon_end"), F.coalesce("cuts", F.array().cast("array<bigint>"))))
    pairs = F.zip_with(F.col("p"), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(a.alias("s"), b.alias("e")))
    return (spans.withColumn("p", points).withColumn("x", F.explode(pairs)).filter("x.e IS NOT NULL")
            .select("gene", "exon_start", "exon_end", "x.s", "x.e"))


def isoform_splices(exons: DataFrame, *extra: str) -> DataFrame:
    """Every splice of every isoform: exon rows (gene, tx_id, extra...) joined to the fragments of their exon."""
    return exons.join(splices_of_exons(exons), ["gene", "exon_start", "exon_end"]).select("gene", "tx_id", *extra, "s", "e")


def exon_splices(exons: DataFrame) -> DataFrame:
    """splices(gene, s, e, isoforms): each splice once, with the sorted isoforms that hold it."""
    return isoform_splices(exons).groupBy("gene", "s", "e").agg(F.array_sort(F.collect_set("tx_id")).alias("isoforms"))


def splice_counts(exons: DataFrame) -> DataFrame:
    """Splices of every isoform with the number of isoforms that hold them."""
    mine = isoform_splices(exons)
    return mine.join(mine.groupBy("gene", "s", "e").agg(F.count("*").alias("n")), ["gene", "s", "e"])


def unique_exons(exons: DataFrame) -> DataFrame:
    """Splices held by exactly one isoform."""
    return (isoform_splices(exons).groupBy("gene", "s", "e").agg(F.count("*").alias("n"), F.min("tx_id").alias("tx_id"))
            .filter("n = 1").drop("n"))


def introns(exons: DataFrame) -> DataFrame:
    """Gaps between neighbouring exons of each isoform, with the exons on both sides."""
    w = Window.partitionBy("gene", "tx_id").orderBy("exon_start")
    return (exons.select("gene", "tx_id", F.col("exon_start").alias("prev_start"), F.col("exon_end").alias("i_start"),
                         F.lead("exon_start").over(w).alias("i_end"), F.lead("exon_end").over(w).alias("next_end"))
            .filter("i_end IS NOT NULL"))


def intron_counts(exons: DataFrame) -> DataFrame:
    mine = introns(exons)
    return mine.join(mine.groupBy("gene", "i_start", "i_end").agg(F.count("*").alias("n")), ["gene", "i_start", "i_end"])


def unique_introns(exons: DataFrame) -> DataFrame:
    """Introns of exactly one isoform."""
    return intron_counts(exons).filter("n = 1").drop("n")


def merge_adjacent(intervals: DataFrame, keys: list[str], s: str = "s", e: str = "e") -> DataFrame:
    """Merge intervals where one starts exactly where the one before it ends (overlaps stay apart)."""
    w = Window.partitionBy(*keys).orderBy(s, e)
    starts = F.coalesce((F.col(s) != F.lag(e).over(w)).cast("int"), F.lit(1))
    return (intervals.withColumn("_new", starts).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "_island").agg(F.min(s).alias(s), F.max(e).alias(e)).drop("_island"))


def windows_isoform(isoforms: DataFrame, length: int = 40, ranges: bool = False) -> DataFrame:
    """Every genomic start of every isoform with ``start + length <= end``, and the window end.

    As ``ranges`` there is one row per isoform, from its first start ``pos`` to its last, ``pos_last``.
    """
    long = isoforms.filter(F.col("end") - F.col("start") >= length)
    if ranges:
        return long.withColumn("pos", F.col("start")).withColumn("pos_last", F.col("end") - length)
    return (long
            .withColumn("pos", F.explode(F.sequence(F.col("start"), F.col("end") - length)))
            .withColumn("pos_end", window_end("pos", length)))


def window_end(start: str, length: int) -> Column:
    """End of a window on the locus: windows never jump an intron (spliced windows do, see ``spliced_windows``)."""
    return F.col(start) + length


def window_segments(splices: DataFrame, isoforms: DataFrame, length: int = 40) -> DataFrame:
    """Runs of window starts that touch the same splices and lie in the same isoforms.

    A window starting at p touches the splice [s, e) exactly when s - length < p < e, so between change points
    the touched set is constant: one row per run replaces one row per window. Runs are cut at bin borders;
    within a (gene, bin) there are at most as many splices as bases, whatever the size of the gene.
    Columns: seg_start, seg_end (half-open), regions, iso_union, iso_inter, owners (isoforms whose range holds p).
    """
    def pieces(df: DataFrame, lo: Column, hi: Column, **cols: Column) -> DataFrame:
        cut = (df.withColumn("_lo", lo).withColumn("_hi", hi).filter("_hi > _lo")
               .withColumn("bin", _bins(F.col("_lo"), F.col("_hi"))))
        return cut.select("gene", "bin", F.greatest(F.col("_lo"), F.col("bin") * BIN).alias("lo"),
                          F.least(F.col("_hi"), (F.col("bin") + 1) * BIN).alias("hi"),
                          *[c.alias(n) for n, c in cols.items()])

    touch = pieces(splices, F.col("s") - length + 1, F.col("e"), s=F.col("s"), e=F.col("e"), isoforms=F.col("isoforms"))
    touch = touch.groupBy("gene", "bin").agg(F.sort_array(F.collect_list(F.struct("s", "e", "lo", "hi", "isoforms"))).alias("touch"))
    own = pieces(isoforms, F.col("start"), F.col("end") - length + 1, o=F.struct("tx_order", "tx_id", "start", "strand"))
    own = own.groupBy("gene", "bin").agg(F.sort_array(F.collect_list(F.struct("o", "lo", "hi"))).alias("own"))
    both = touch.join(own, ["gene", "bin"])
    points = F.array_sort(F.array_distinct(F.flatten(F.array(
        F.transform("touch", lambda t: t["lo"]), F.transform("touch", lambda t: t["hi"]),
        F.transform("own", lambda t: t["lo"]), F.transform("own", lambda t: t["hi"])))))
    runs = F.zip_with(F.col("p"), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    seg = both.withColumn("p", points).select("gene", "bin", "touch", "own", F.explode(runs).alias("r")).filter("r.b IS NOT NULL")

    def covering(c: str) -> Column:
        return F.filter(c, lambda t: (t["lo"] <= F.col("r.a")) & (t["hi"] >= F.col("r.b")))

    seg = seg.select("gene", "bin", F.col("r.a").alias("seg_start"), F.col("r.b").alias("seg_end"),
                     covering("touch").alias("t"), F.transform(covering("own"), lambda t: t["o"]).alias("owners"))
    return (seg.filter((F.size("t") > 0) & (F.size("owners") > 0))
            .select("gene", "bin", "seg_start", "seg_end", "owners",
                    F.transform("t", lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"))).alias("regions"),
                    F.array_sort(F.array_distinct(F.flatten(F.transform("t", lambda x: x["isoforms"])))).alias("iso_union"),
                    F.aggregate(F.slice("t", 2, F.size("t")), F.element_at("t", 1)["isoforms"],
                                lambda a, x: F.array_intersect(a, x["isoforms"])).alias("iso_inter")))


def overlapping_splices(segments: DataFrame) -> DataFrame:
    """(gene, seg_start, seg_end, start, end): window-start runs with each splice they touch."""
    return segments.select("gene", "seg_start", "seg_end", F.explode("regions").alias("x")).select(
        "gene", "seg_start", "seg_end", "x.start", "x.end")


def _spans(loci: DataFrame, isoforms: DataFrame) -> DataFrame:
    """(gene, strand, g_start, g_end, seq): the locus from the first to the last isoform base, per strand in use.

    Metrics depend on the window and the strand only, so they are computed once, not once per isoform.
    """
    span = isoforms.groupBy("gene", "strand").agg(F.min("start").alias("g_start"), F.max("end").alias("g_end"))
    text = F.col("seq").substr(F.col("g_start").cast("int"), (F.col("g_end") - F.col("g_start") + 1).cast("int"))
    return (loci.select("gene", "seq").join(span, "gene")
            .withColumn("seq", F.when(F.col("strand") == -1, revcomp(text)).otherwise(text)))


def _flip(start: Column, length: int) -> Column:
    """Genomic start <-> start on the span: the same formula both ways. On strand -1 the span begins at g_end."""
    return F.when(F.col("strand") == -1, F.col("g_end") - length + 1 - start).otherwise(start)


def _passing_starts(spans: DataFrame, t: Thresholds) -> DataFrame:
    """(gene, strand, pos, bin) of the windows of each span within the limits; ``pos`` is genomic (1-based locus)."""
    # starts run from g_start to g_end - length, one place further on the turned span
    back = (F.col("strand") == -1).cast("int")
    w = windows_between(spans, ["gene", "strand", "g_start", "g_end"], F.lit(0) + back, F.col("seq_len") - t.length + back, t.length, limits=t)
    pos = F.when(F.col("strand") == -1, _flip(F.col("pos"), t.length)).otherwise(F.col("g_start") + F.col("pos"))
    return passing(w, t).select("gene", "strand", pos.alias("pos")).withColumn("bin", F.floor(F.col("pos") / BIN))


def _windows_of(spans: DataFrame, picks: DataFrame, t: Thresholds) -> DataFrame:
    """The windows at the chosen genomic starts of each gene, within the limits on the strand they are read."""
    local = F.transform("picks", lambda p: F.when(F.col("strand") == -1, _flip(p, t.length)).otherwise(p - F.col("g_start")))
    inside = F.filter(local, lambda p: (p >= 0) & (p + t.length <= F.length("seq")))
    w = windows_at(spans.join(picks, "gene").withColumn("at", inside), ["gene", "strand", "g_start", "g_end"], "at", t.length)
    pos = F.when(F.col("strand") == -1, _flip(F.col("pos"), t.length)).otherwise(F.col("g_start") + F.col("pos"))
    return (passing(w, t).withColumn("pos", pos).drop("g_start", "g_end", "n_bad")
            .withColumn("bin", F.floor(F.col("pos") / BIN)))


def _sites(found: DataFrame, length: int, strategy: str) -> DataFrame:
    return (found.withColumn("sequence", revcomp("target")).withColumn("genomic_start", F.col("pos"))
            .withColumn("genomic_end", F.col("pos") + length).withColumn("position", F.col("pos") - F.col("owner.start"))
            .withColumn("length", F.lit(length)).withColumn("strategy", F.lit(strategy))
            .withColumn("isoform_overlap_num", F.size("target_isoforms"))
            .withColumn("isoform_id", F.col("owner.tx_id")).withColumn("overlapping_regions", F.col("regions"))
            .drop("owner", "owners", "regions", "pos", "bin", "seg_start", "seg_end", "iso_union", "iso_inter"))


def _in_segments(windows: DataFrame, segments: DataFrame) -> DataFrame:
    return windows.join(segments, ["gene", "bin"]).filter("seg_start <= pos AND pos < seg_end")


def specific_sites(loci: DataFrame, isoforms: DataFrame, splices: DataFrame, t: Thresholds) -> DataFrame:
    """Windows whose touched splices are shared by exactly one isoform, inside that isoform; spaced over the cap.

    Only starts travel until the spacing is settled; the chosen few are then read again with all their columns.
    """
    seg = window_segments(splices, isoforms, t.length).filter(F.size("iso_inter") == 1)
    seg = (seg.withColumn("owner", F.explode(F.filter("owners", lambda o: o["tx_id"] == F.element_at("iso_inter", 1))))
           .withColumn("target_isoforms", F.col("iso_inter")))
    spans = _spans(loci, isoforms)
    lean = seg.select("gene", "bin", "seg_start", "seg_end", F.col("owner.strand").alias("strand"))
    starts = _passing_starts(spans, t).join(lean, ["gene", "bin", "strand"]).filter("seg_start <= pos AND pos < seg_end")
    picks = selected_arrays(starts, "gene", "pos", t.max_sites)
    found = _in_segments(_windows_of(spans, picks, t), seg).filter(F.col("owner.strand") == F.col("strand"))
    return _sites(found, t.length, "isoform_specific")


def consensus_sites(loci: DataFrame, isoforms: DataFrame, splices: DataFrame, t: Thresholds) -> DataFrame:
    """Windows that touch at least one isoform, each place once (first isoform wins); spaced over the cap."""
    seg = window_segments(splices, isoforms, t.length).withColumn("target_isoforms", F.col("iso_union"))
    spans = _spans(loci, isoforms)
    lean = seg.select("gene", "bin", "seg_start", "seg_end",
                      F.explode(F.array_distinct(F.transform("owners", lambda o: o["strand"]))).alias("strand"))
    starts = _passing_starts(spans, t).join(lean, ["gene", "bin", "strand"]).filter("seg_start <= pos AND pos < seg_end")
    picks = selected_arrays(starts, "gene", "pos", t.max_sites)
    # one strand per gene is the rule; where isoforms differ, the first owner on the strand at hand counts
    mine = F.filter("owners", lambda o: o["strand"] == F.col("strand"))
    found = _in_segments(_windows_of(spans, picks, t), seg).withColumn("owner", F.get(mine, F.lit(0))).filter("owner IS NOT NULL")
    return first_strand(_sites(found.withColumn("_ord", F.col("owner.tx_order")), t.length, "isoform_consensus"))


def first_strand(sites: DataFrame) -> DataFrame:
    """One row per place: that of the isoform that comes first.

    Sites with a column ``genomic_last`` are ranges of starts (gene, genomic_start, genomic_last, _ord, tx_id). They are settled between
    their change points within (gene, bin) and stay ranges, so that no place is shuffled; ``window_places`` lists them.
    """
    if "genomic_last" in sites.columns:
        return _first_ranges(sites)
    return first_per(sites, ["gene", "genomic_start", "genomic_end"], ["_ord"]).drop("_ord")


def _first_ranges(sites: DataFrame) -> DataFrame:
    lo, hi = F.col("genomic_start"), F.col("genomic_last") + 1
    cut = sites.withColumn("bin", _bins(lo, hi, PIECE)).select(
        "gene", "bin", F.greatest(lo, F.col("bin") * PIECE).alias("lo"), F.least(hi, (F.col("bin") + 1) * PIECE).alias("hi"), "_ord", "tx_id")
    # isoforms with the same part of a bin: the first of them speaks for all, so a list has no more rows than there are parts
    held = (cut.groupBy("gene", "bin", "lo", "hi").agg(F.min(F.struct("_ord", "tx_id")).alias("o")).groupBy("gene", "bin")
            .agg(F.sort_array(F.collect_list(F.struct("o", "lo", "hi"))).alias("own")))
    points = F.sort_array(F.array_distinct(F.flatten(F.array(F.transform("own", lambda t: t["lo"]), F.transform("own", lambda t: t["hi"])))))
    runs = F.zip_with(F.col("p"), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    first = F.get(F.filter("own", lambda t: (t["lo"] <= F.col("r.a")) & (t["hi"] >= F.col("r.b"))), F.lit(0))
    return (held.withColumn("p", points).select("gene", "own", F.explode(runs).alias("r")).filter("r.b IS NOT NULL")
            .withColumn("f", first).filter("f IS NOT NULL")
            .select("gene", F.col("r.a").alias("genomic_start"), (F.col("r.b") - 1).alias("genomic_last"), F.col("f.o.tx_id").alias("tx_id")))


def window_places(ranges: DataFrame, length: int = 40) -> DataFrame:
    """Every place of ranges of window starts, with its end."""
    return (ranges.withColumn("genomic_start", F.explode(F.sequence("genomic_start", "genomic_last"))).drop("genomic_last")
            .withColumn("genomic_end", window_end("genomic_start", length)))


def order_by_coverage(sites: DataFrame) -> DataFrame:
    return sites.orderBy(F.col("isoform_overlap_num").desc(), "genomic_start", "gene")


def search_all(loci: DataFrame, isoforms: DataFrame, splices: DataFrame, t: Thresholds, strategy: str) -> DataFrame:
    """The chosen isoform strategy for genes with isoforms, brute force for the others; an error for any other name.

    ``brute_force`` and ``exon_junction`` take every gene, whether it has isoforms or not.
    """
    from ..plans.design import brute_force_sites, junction_sites
    whole = {"brute_force": brute_force_sites, "exon_junction": junction_sites}
    runs = {"isoform_specific": specific_sites, "isoform_consensus": consensus_sites}
    if strategy in whole:
        return whole[strategy](loci, t)
    if strategy not in runs:
        raise ValueError(f"unknown strategy {strategy!r}: {', '.join([*runs, *whole])}")
    known, run = isoforms.select("gene").distinct(), runs[strategy]
    with_iso = run(loci.join(known, "gene", "left_semi"), isoforms, splices, t)
    without = brute_force_sites(loci.join(known, "gene", "left_anti"), t)
    return with_iso.unionByName(without, allowMissingColumns=True)


# ---- spliced coordinates ------------------------------------------------------------------------

def _ordered(exons: DataFrame) -> DataFrame:
    """Per isoform its splices in order, with prefix lengths. Bounded by the splices of one isoform."""
    mine = isoform_splices(exons, "strand")
    got = mine.groupBy("gene", "tx_id", "strand").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("sp"))
    sums = F.aggregate("sp", F.array(F.lit(0).cast("bigint")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x["e"] - x["s"]))
    return got.withColumn("pre", sums)


def min_window_sums(exons: DataFrame) -> DataFrame:
    """(gene, tx_id, k, min_sum): smallest total length of k splices in a row; inside one row per isoform."""
    n = F.size("sp")
    sums = F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(
        k.alias("k"), F.array_min(F.transform(F.sequence(F.lit(0), n - k), lambda i: F.get("pre", i + k) - F.get("pre", i))).alias("m")))
    return _ordered(exons).select("gene", "tx_id", F.explode(sums).alias("x")).select(
        "gene", "tx_id", F.col("x.k").cast("bigint").alias("k"), F.col("x.m").alias("min_sum"))


def chain_length(exons: DataFrame, tolerance: int) -> DataFrame:
    """(gene, needed): splices in a row that a window half of ``tolerance`` bases may touch."""
    per_tx = min_window_sums(exons).filter(F.col("min_sum") >= tolerance).groupBy("gene", "tx_id").agg((F.min("k") + 1).alias("k"))
    return per_tx.groupBy("gene").agg(F.max("k").alias("needed"))


def splice_chains(exons: DataFrame, longest: int) -> DataFrame:
    """(gene, n, chain, isoforms): runs of 1..longest splices and the isoforms that hold them in a row."""
    n = F.size("sp")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.least(n, F.lit(longest))), lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: F.struct(k.alias("n"), chain_key(F.slice("sp", i, k)).alias("chain")))))
    return (_ordered(exons).select("gene", "tx_id", F.explode(runs).alias("x"))
            .groupBy("gene", F.col("x.n").cast("bigint").alias("n"), F.col("x.chain").alias("chain"))
            .agg(F.array_sort(F.collect_set("tx_id")).alias("isoforms")))


def chain_key(splices: Column) -> Column:
    return F.array_join(F.transform(splices, lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")


def _run_rows(length: int, tolerance: int, longest: int):
    """Kernel of ``spliced_runs``: the isoforms of a batch lie behind one another on one line, on which splices and changes are looked up."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            lists = rb.column("sp")
            cuts = lists.offsets.to_numpy().astype(np.int64)
            s, e = (lists.values.field(c).to_numpy()[cuts[0]:cuts[-1]] for c in ("s", "e"))
            cuts -= cuts[0]
            rows, count = rb.num_rows, np.diff(cuts)
            owner = np.repeat(np.arange(rows), count)
            before = np.concatenate([[0], np.cumsum(e - s)])
            pre = before[:-1] - before[cuts[:-1]][owner]
            total = before[cuts[1:]] - before[cuts[:-1]]
            base = np.concatenate([[0], np.cumsum(total + length + tolerance)])[:-1]
            at = base[owner] + pre

            # a run starts at the first window, where the window or its middle enters or leaves a splice, and every ``longest`` windows
            lo, hi = base + 1, base + total - length
            extra = np.maximum(total // longest, 0)
            turn = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra)
            points = np.unique(np.concatenate([lo, *[at - d for d in (0, length, half - tolerance, half + tolerance)],
                                               np.repeat(base, extra) + (turn + 1) * longest]))
            row = np.searchsorted(base, points, "right") - 1
            fits = (row >= 0) & (points >= lo[row]) & (points < hi[row])
            points, row = points[fits], row[fits]
            ends = np.minimum(np.append(points[1:], np.iinfo(np.int64).max), hi[row])

            def place(offset: int) -> np.ndarray:
                return np.searchsorted(at, points + offset, "right") - 1

            first, last, t1, t2 = place(0), place(length), place(half - tolerance), place(half + tolerance)
            off, off_end = points - base[row], ends - base[row]
            start, end = s[first] + off - pre[first], s[last] + off + length - pre[last]

            # chains that an isoform holds and a window of another may ask for: what lies between their outer splices is short
            splice, size = np.arange(len(s)), np.concatenate([pre[1:], [0]])
            size[cuts[1:][count > 0] - 1] = total[count > 0]
            held, n = [], 1
            while len(splice):
                inner = pre[splice + n - 1] - size[splice] if n > 1 else np.full(len(splice), -1)
                splice = splice[inner < 2 * tolerance]
                held.append((splice[size[splice + n - 1] - pre[splice] > 2 * tolerance], n))
                n += 1
                splice = splice[splice + n - 1 < cuts[1:][owner[splice]]]
            head, many = np.concatenate([h for h, _ in held] or [splice]), np.concatenate([np.full(len(h), k) for h, k in held] or [splice])
            asked = np.unique(t1 * n + t2 - t1)
            idle = ~np.isin(head * n + many - 1, asked)
            head, many = head[idle], many[idle]

            # rows: the runs, then the chains without a window of their own
            none = len(head)
            chain_at, chain_n = np.concatenate([t1, head]), np.concatenate([t2 - t1 + 1, many])
            index = pa.array(np.concatenate([row, owner[head]]))
            link = _stretches(chain_at, chain_n)
            pairs = np.stack([s[link], e[link]], 1).astype("<i8")
            chains = pa.BinaryArray.from_buffers(pa.binary(), len(chain_n), [None, pa.py_buffer(_offsets(chain_n * 16)), pa.py_buffer(pairs.tobytes())])
            touch = _stretches(first, last - first + 1)
            touched = pa.ListArray.from_arrays(pa.array(_offsets(np.concatenate([last - first + 1, np.zeros(none, np.int64)]))),
                                               pa.StructArray.from_arrays([pa.array(s[touch]), pa.array(e[touch])], ["s", "e"]))
            texts = _spliced(rb.column("seq"), s, e, cuts)
            pieces = [texts[r][a:b + length - 1] for r, a, b in zip(row.tolist(), off.tolist(), off_end.tolist())] + [""] * none
            wide = [np.concatenate([x, np.zeros(none, np.int64)]) for x in (off, off_end, start, end)]
            yield pa.RecordBatch.from_arrays(
                [*[rb.column(c).take(index) for c in ("gene", "tx_id", "strand")], chains, pa.array(chain_n), *map(pa.array, wide), touched,
                 pa.array(pieces, pa.string())], names=["gene", "tx_id", "strand", "chain", "n", "off", "off_end", "start", "end", "touched", "piece"])

    return run


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def _stretches(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each stretch, behind one another."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _spliced(seqs: pa.Array, s: np.ndarray, e: np.ndarray, cuts: np.ndarray) -> list[str]:
    """The text of each row's splices, joined; places count from 1, and what lies beyond the text is left out."""
    out = []
    for i, seq in enumerate(seqs.to_pylist()):
        part = slice(cuts[i], cuts[i + 1])
        text, n = seq or "", len(seq or "")
        # as substring() reads its place: 0 is the first base, what is below counts from the end
        places = [(a - 1 if a > 0 else n + a if a < 0 else 0, b - a) for a, b in zip(s[part].tolist(), e[part].tolist())]
        out.append("".join([text[max(a, 0):max(a + k, 0)] for a, k in places]))
    return out


def spliced_runs(loci: DataFrame, exons: DataFrame, length: int = 40, tolerance: int = 10) -> DataFrame:
    """Runs of spliced window starts [off, off_end) that touch the same splices, with their isoforms and their text ``piece``.

    ``touched`` are the splices of the window, ``n`` the number of splices within ``tolerance`` spliced bases of its
    middle, ``target_isoforms`` the isoforms that hold those in a row. ``start`` and ``end`` are the genomic ends of
    the first window; later ones move along. One row per run, so isoforms are looked up before any window exists. Each isoform is read once: it lists
    its runs and the other chains that it holds, and rows of a gene's chain meet in one place.
    """
    rows = (_ordered(exons).filter("tx_id IS NOT NULL").join(loci.select("gene", "seq"), "gene")
            .select("gene", "tx_id", "strand", "sp", "seq"))
    bounds = "chain binary, n bigint, off bigint, off_end bigint, start bigint, end bigint, touched array<struct<s: bigint, e: bigint>>, piece string"
    schema = T.StructType([rows.schema[c] for c in ("gene", "tx_id", "strand")] + T.StructType.fromDDL(bounds).fields)
    held = F.array_sort(F.collect_set("tx_id").over(Window.partitionBy("gene", "chain")))
    return (rows.mapInArrow(_run_rows(length, tolerance, PIECE // 4), schema).withColumn("target_isoforms", held)
            .filter("off_end > off").drop("chain"))


def spliced_windows(loci: DataFrame, exons: DataFrame, length: int = 40, tolerance: int = 10) -> DataFrame:
    """Windows of ``length`` exonic bases of every isoform, walked in spliced coordinates, with target metrics.

    ``target`` is the spliced target on the strand of the isoform. Windows are made run by run from the text next to
    it, and nothing is shuffled after the windows appear.
    """
    count = F.col("off_end") - F.col("off")
    pieces = (spliced_runs(loci, exons, length, tolerance)
              .withColumn("piece", F.when(F.col("strand") == -1, revcomp("piece")).otherwise(F.col("piece")))
              .withColumn("last", count - 1).withColumn("win_from", F.lit(0)).withColumn("win_to", count))
    keys = ["gene", "tx_id", "strand", "off", "last", "start", "end", "touched", "n", "target_isoforms"]
    w = with_metrics(rolling_windows(pieces, keys, length, probe_strand=False, listed=True), length, probe_strand=False)
    # on strand -1 the text is turned, so the windows of a run come from its end
    along = F.when(F.col("strand") == -1, F.col("last") - F.col("rel")).otherwise(F.col("rel"))
    return (w.withColumn("along", along).withColumn("off", F.col("off") + F.col("along"))
            .withColumn("start", F.col("start") + F.col("along")).withColumn("end", F.col("end") + F.col("along"))
            .drop("last", "along", "rel", "n_bad"))


def merged_regions(touched: str) -> Column:
    """Adjacent splices of a sorted list merged into exon intervals."""
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return F.aggregate(touched, empty, lambda a, x: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["e"] == x["s"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["s"].alias("s"), x["e"].alias("e")))))
        .otherwise(F.array_append(a, x)))


def unique_region_sequences(loci: DataFrame, exons: DataFrame, flank: int = 30) -> DataFrame:
    """(gene, tx_id, kind, r_start, strand, seq): RNA of regions owned by one isoform, and across introns it alone has.

    A junction joins at most ``flank`` bases of both exons. ``parts`` keeps the genomic intervals of the RNA, so
    positions on it can be lifted back.
    """
    regions = (merge_adjacent(unique_exons(exons), ["gene", "tx_id"])
               .select("gene", "tx_id", F.lit("region").alias("kind"), F.array(F.struct("s", "e")).alias("parts")))
    joints = unique_introns(exons).select("gene", "tx_id", F.lit("junction").alias("kind"), F.array(
        F.struct(F.greatest(F.col("prev_start"), F.col("i_start") - flank).alias("s"), F.col("i_start").alias("e")),
        F.struct(F.col("i_end").alias("s"), F.least(F.col("i_end") + flank, F.col("next_end")).alias("e"))).alias("parts"))
    strands = exons.select("gene", "tx_id", "strand").distinct()
    both = regions.unionByName(joints).join(strands, ["gene", "tx_id"]).join(loci.select("gene", "seq"), "gene")
    text = F.array_join(F.transform("parts", lambda x: F.col("seq").substr(x["s"].cast("int"), (x["e"] - x["s"]).cast("int"))), "")
    return both.withColumn("seq", F.when(F.col("strand") == -1, revcomp(text)).otherwise(text))


def lift(parts: str, offset: Column) -> Column:
    """Genomic position of a 0-based offset on the joined intervals ``parts`` (forward strand)."""
    first = F.element_at(parts, 1)
    size = first["e"] - first["s"]
    return F.when((offset < size) | (F.size(parts) == 1), first["s"] + offset).otherwise(
        F.element_at(parts, -1)["s"] + offset - size)


def unique_region_windows(loci: DataFrame, exons: DataFrame, length: int = 40, share: float = 0.1) -> DataFrame:
    """Target-strand windows of those sequences, lifted to the genome: ``pos`` is the smallest genomic base."""
    seqs = unique_region_sequences(loci, exons)
    keys = ["gene", "tx_id", "kind", "strand", "parts"]
    w = windows_bruteforce(seqs, keys, length, share, probe_strand=False)
    offset = F.when(F.col("strand") == -1, F.col("seq_len") - length - F.col("pos")).otherwise(F.col("pos"))
    return w.withColumn("rna_pos", F.col("pos")).withColumn("pos", lift("parts", offset))
