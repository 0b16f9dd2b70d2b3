"""Allele-specific arms around variants.

Variants are rows (region, v_start, v_end, ref, alt, strand), 1-based inclusive, with ``-`` for an insertion
(ref) or a deletion (alt). Local coordinates are 0-based on the padded sequence around the variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sequence import flip_position, mutate, revcomp, rounded
from ..functions.thermo import tm_nn
from ..session import cut_lineage
from . import arms
from .extraction import fetch_regions, genome_chunks
from .windows import PIECE, cut_pieces

PAD = 50
ARM_MIN, ARM_MAX, ARM_START = 15, 25, 20
#: Bases of a variant whose surroundings are read from one piece of its region; longer ones are put together from chunks.
LONGEST = 512


def with_type(variants: DataFrame) -> DataFrame:
    return variants.withColumn("kind", F.when(F.col("alt") == "-", "DEL").when(F.col("ref") == "-", "INS")
                               .when(F.col("v_start") == F.col("v_end"), "SNP").otherwise("MNP"))


def _around(variants: DataFrame, out: str, pad: int, seq: str, regions: DataFrame | None, region: str) -> DataFrame:
    """Adds ``out``, the bases max(1, v_start - pad) .. v_end + pad of the variant's region.

    With ``regions`` (region, seq) a variant meets only the overlapping piece of its region in which these bases start, on (region, piece), so no row carries a
    region's text; what is longer than the overlap is put together from chunks. Without it the text is the column ``seq`` of the variants.
    """
    first = F.greatest(F.col("v_start") - pad, F.lit(1))
    size = F.col("v_end") + pad - first + 1
    if regions is None:
        return variants.withColumn(out, F.col(seq).substr(first.cast("int"), size.cast("int")))
    # written once: short and long ones, and the bases that these ask for, are read from it, and what made the variants is not done again
    variants = cut_lineage(variants, "variants")
    overlap = 2 * pad + LONGEST
    piece = max(PIECE, overlap)
    texts = regions.select(F.col(region).alias("_region"), F.col(seq).alias("_seq"))
    pieces = cut_pieces(texts, "_seq", overlap, piece).select("_region", F.col("piece_no").cast("bigint").alias("_piece"), "piece", "piece_start")
    short = variants.filter(size <= overlap).withColumn("_at", F.floor((first - 1) / piece).cast("bigint"))
    met = short.join(pieces, (F.col(region) == F.col("_region")) & (F.col("_at") == F.col("_piece")), "left").select(
        *variants.columns, F.col("piece").substr((first - F.col("piece_start")).cast("int"), size.cast("int")).alias(out))
    long = variants.filter(size > overlap).select(*variants.columns, F.col(region).alias("_region"), first.alias("_first"), (F.col("v_end") + pad).alias("_last"))
    asked = long.select(F.col("_region").alias("region"), F.col("_first").alias("start"), F.col("_last").alias("end")).distinct()
    fetched = fetch_regions(asked, genome_chunks(texts, "_region", "_seq"), out="_text").select(
        F.col("region").alias("_r"), F.col("start").alias("_s"), F.col("end").alias("_e"), "_text")
    same = (F.col("_region") == F.col("_r")) & (F.col("_first") == F.col("_s")) & (F.col("_last") == F.col("_e"))
    return met.unionByName(long.join(fetched, same, "left").select(*variants.columns, F.col("_text").alias(out)))


def with_local(variants: DataFrame, seq: str = "seq", pad: int = PAD, regions: DataFrame | None = None, region: str = "gene") -> DataFrame:
    """Adds ``g_start`` and ``local`` (bases g_start .. v_end + pad, from base 1 on) and the local bounds of the variant."""
    first = F.greatest(F.col("v_start") - pad, F.lit(1))
    return (_around(variants, "local", pad, seq, regions, region).withColumn("g_start", first)
            .withColumn("l_start", F.col("v_start") - first).withColumn("l_end", F.col("v_end") - first))


def junctions(variants: DataFrame, seq: str = "seq", pad: int = PAD, regions: DataFrame | None = None, region: str = "gene") -> DataFrame:
    """One row per variant, allele and ligation point.

    ``allele`` ref or mut; ``target`` on the strand of the variant; ``pos5`` the last target base of the 5' arm and
    ``pos3`` the first of the 3' arm. Genomic ``g_pos5``/``g_pos3`` count on the reference; points inside new
    bases carry ``edit_kind`` (INS, RPS) and ``edit_offset``. A deletion takes its bases out of the mutated allele.
    """
    v = with_local(with_type(variants), seq, pad, regions, region)
    s, e, ins = F.col("l_start"), F.col("l_end"), F.col("kind") == "INS"
    deleted = F.col("kind") == "DEL"
    n_alt = F.length("alt").cast("bigint")
    mutated = F.when(ins, mutate("local", s, s, F.col("ref"), F.col("alt"))).otherwise(
        mutate("local", s, e + 1, F.col("ref"), F.col("alt")))
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")

    def point(allele: str, text: Column, p5: Column, base5: Column, base3: Column, kind: Column, offset: Column) -> Column:
        return F.struct(F.lit(allele).alias("allele"), text.alias("text"), p5.alias("p5"), base5.alias("base5"),
                        base3.alias("base3"), kind.alias("edit_kind"), offset.alias("edit_offset"))

    ref_points = F.transform(F.when(ins, F.array(s)).otherwise(F.sequence(s - 1, e)),
                             lambda p: point("ref", F.col("local"), p, p, p + 1, none, zero))
    mut_points = F.when(deleted, F.array(point("mut", mutated, s - 1, s - 1, e + 1, none, zero))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("bigint"), n_alt), lambda i: point(
            "mut", mutated, s + i, s, s + 1, F.when(ins, "INS").otherwise("RPS"), i)))
    keep = [c for c in variants.columns if c != seq]
    rows = v.select(*keep, "kind", "g_start", F.length("local").cast("bigint").alias("n_local"), F.explode(F.concat(ref_points, mut_points)).alias("x"))
    n = F.length("x.text").cast("bigint")
    p5, p3 = F.col("x.p5"), F.col("x.p5") + 1
    # for a deletion the two genomic ends count on the reference, else on the allele itself
    g_len = F.when(F.col("kind") == "DEL", F.col("n_local")).otherwise(n)
    return rows.select(
        *keep, "kind", "x.allele", F.when(F.col("strand") == -1, revcomp("x.text")).otherwise(F.col("x.text")).alias("target"),
        flip_position(p5, p3, n, "strand").alias("pos5"), flip_position(p3, p5, n, "strand").alias("pos3"),
        (F.col("g_start") + flip_position(F.col("x.base5"), F.col("x.base3"), g_len, "strand")).alias("g_pos5"),
        (F.col("g_start") + flip_position(F.col("x.base3"), F.col("x.base5"), g_len, "strand")).alias("g_pos3"),
        "x.edit_kind", "x.edit_offset")


def arm_grid(points: DataFrame, shortest: int = ARM_MIN, longest: int = ARM_MAX, start: int = ARM_START,
             mfe: str | None = None, best: int | None = None, by: list[str] | None = None) -> DataFrame:
    """All pairs of arm lengths per ligation point, with Tm of both arms and a score (smaller is better).

    Each arm length is scored once, from running sums over the target, before the two lists are paired. ``mfe`` names a column
    with the folding energy of the point, 0 where there is none. Arms that would run off the target are left out. With ``best`` only that
    many designs of a point go on, those that ``rank_designs`` puts first. The texts of the arms are a column of their own, made where they are asked for.

    With ``by`` points that share these columns are brought together first, a hundred times fewer rows than their designs, and the grid is one row for
    them: ``designs`` in the order of ``rank_designs``, which lists them, and ``_arms`` with the texts. ``target``, ``pos5`` and ``pos3`` stay behind unless named.
    """
    target, pos5, pos3, energy = _point(points, mfe)
    if by is not None:
        if best is not None:
            raise ValueError("all designs of points that are brought together are ranked")
        rows = points.select(*by, F.struct(target.alias("target"), pos5.alias("pos5"), pos3.alias("pos3"), energy.alias("energy")).alias("_p"))
        held = rows.groupBy(*by).agg(F.collect_list("_p").alias("_p"))
        texts = F.transform("_p", lambda p: F.struct(p["target"].alias("target"), p["pos5"].alias("pos5"), p["pos3"].alias("pos3")))
        return held.select(*by, arms.ranked(shortest, longest, start)(F.col("_p")).alias("designs"), texts.alias("_arms"))
    keep, k = [c for c in points.columns if c != "target"], shortest
    rows = points.withColumn("_x", arms.pairs(shortest, longest, start, best)(target, pos5, pos3, energy)).withColumn("_t", arms.texts(shortest, longest)(target, pos5, pos3))
    return rows.select(*keep, "_t", F.explode("_x").alias("x")).select(
        *keep, "x.arm5_len", "x.arm3_len", "x.tm5", "x.tm3", F.get("_t.bds5", F.col("x.arm5_len") - k).alias("bds5"),
        F.get("_t.bds3", F.col("x.arm3_len") - k).alias("bds3"), "x.score")


def arm_figures(points: DataFrame, shortest: int = ARM_MIN, longest: int = ARM_MAX, start: int = ARM_START, mfe: str | None = None) -> DataFrame:
    """Figures of the grid of each point that has one: pairs ``n``, lengths ``n5`` and ``n3`` and scores in hundredths added up, largest arms and Tm."""
    keep = [c for c in points.columns if c != "target"]
    made = arms.figures(shortest, longest, start)(*_point(points, mfe))
    return points.withColumn("_x", made).select(*keep, "_x.*").filter("n > 0")


def _point(points: DataFrame, mfe: str | None) -> list[Column]:
    energy = F.coalesce(F.col(mfe).cast("double"), F.lit(0.0)) if mfe else F.lit(0.0)
    return [F.col("target"), F.col("pos5").cast("bigint"), F.col("pos3").cast("bigint"), energy]


def rank_designs(grid: DataFrame, point: list[str]) -> DataFrame:
    """Designs of each point by score, then arm lengths; a point has at most a few hundred.

    A grid made ``by`` the columns of the point holds its designs in this order already; they are listed with their places, and nothing is shuffled or sorted.
    """
    if "designs" in grid.columns:
        if set(grid.columns) - {"designs", "_arms"} != set(point):
            raise ValueError("the grid was brought together by other columns")
        arm = F.get("_arms", F.col("x.member"))
        end = arm["pos5"].cast("int") + 2
        return (grid.select(*point, "_arms", F.posexplode("designs").alias("_at", "x"))
                .select(*point, "x.arm5_len", "x.arm3_len", "x.tm5", "x.tm3",
                        revcomp(arm["target"].substr(end - F.col("x.arm5_len"), F.col("x.arm5_len"))).alias("bds5"),
                        revcomp(arm["target"].substr(arm["pos3"].cast("int") + 1, F.col("x.arm3_len"))).alias("bds3"),
                        "x.score", (F.col("_at") + 1).alias("rank")))
    w = Window.partitionBy(*point).orderBy("score", "arm5_len", "arm3_len")
    return grid.withColumn("rank", F.row_number().over(w))


def _sides(seq: str, allele: str) -> tuple[Column, Column]:
    """(text left of the junction, text right of it) for the sequence with ``gap`` bases on both sides."""
    s, st, en = F.col(seq), F.col("st").cast("int"), F.col("en").cast("int")
    right = s.substr(en + 1, F.length(s))
    if allele == "ref":
        return F.left(s, en), right
    head = F.when(F.col("ref") == "-", F.left(s, en)).otherwise(F.left(s, st))
    return F.concat(head, F.when(F.col("alt") == "-", F.lit("")).otherwise(F.col("alt"))), right


def flanked(variants: DataFrame, seq: str = "seq", gap: int = PAD, regions: DataFrame | None = None, region: str = "gene") -> DataFrame:
    """Adds ``flank`` (the variant with ``gap`` bases on both sides) and its half-open bounds ``st``, ``en``."""
    first = F.greatest(F.col("v_start") - gap, F.lit(1))
    return (_around(variants, "flank", gap, seq, regions, region)
            .withColumn("st", F.col("v_start") - first).withColumn("en", F.col("v_end") - first + 1))


def allele_sites(variants: DataFrame, left: int = 20, right: int = 20, seq: str = "seq", gap: int = PAD, regions: DataFrame | None = None,
                 region: str = "gene") -> DataFrame:
    """Arms of given lengths on both sides of the junction, for the reference and the changed allele.

    Names follow the probe: on strand 1 the probe is the reverse complement, so its left arm binds the
    right side. ``coding_seq`` is the changed sequence on the strand of the variant.
    """
    v, out = flanked(variants, seq, gap, regions, region), []
    for allele in ("ref", "mut"):
        head, tail = _sides("flank", allele)
        out.append(v.withColumn("allele", F.lit(allele)).withColumn("_l", F.right(head, F.lit(left))).withColumn("_r", F.left(tail, F.lit(right)))
                   .withColumn("coding_seq", F.concat(head, tail)))
    both = out[0].unionByName(out[1])
    minus = F.col("strand") == -1
    plp_left = F.when(minus, F.col("_l")).otherwise(revcomp("_r"))
    plp_right = F.when(minus, F.col("_r")).otherwise(revcomp("_l"))
    # temperatures are those of the strand the arm pairs with, as read
    tm_l = tm_nn(F.when(minus, revcomp("_l")).otherwise(F.col("_r")))
    tm_r = tm_nn(F.when(minus, revcomp("_r")).otherwise(F.col("_l")))
    return (both.withColumn("plp_left", plp_left).withColumn("plp_right", plp_right)
            .withColumn("plp_bds", F.concat("plp_left", "plp_right"))
            .withColumn("plp_tm_left", tm_l).withColumn("plp_tm_right", tm_r).withColumn("plp_tm", tm_nn("plp_bds"))
            .withColumn("coding_seq", F.when(minus, revcomp("coding_seq")).otherwise(F.col("coding_seq")))
            .drop("_l", "_r", "flank", "st", "en", seq))


def arm_balance(variants: DataFrame, low: float = 45.0, high: float = 65.0, diff: float = 10.0, shortest: int = 10,
                longest: int = 30, start: int = 20, seq: str = "seq", gap: int = PAD, regions: DataFrame | None = None, region: str = "gene") -> DataFrame:
    """Best-balanced arm lengths per variant on the changed allele; null where no pair is within the limits.

    All lengths are weighed instead of walking from one to the next, which can go round without end. The choice
    is made in a kernel, row by row: smallest difference, then closest to ``start``, then shortest.
    """
    head, tail = _sides("flank", "mut")
    v = flanked(variants, seq, gap, regions, region).withColumn("_h", head).withColumn("_t", tail)
    best = arms.balanced(low, high, diff, shortest, longest, start)(F.col("_h"), F.col("_t"), F.col("strand") == -1)
    return (v.withColumn("_best", best).select(*[c for c in variants.columns if c != seq], F.col("_best.left").alias("left_len"),
                                               F.col("_best.right").alias("right_len"), F.col("_best.tm_left").alias("tm_left"),
                                               F.col("_best.tm_right").alias("tm_right")))


def ilock_arms(rows: DataFrame, target: str, link: Column, len5: int = 20, len3: int = 20) -> DataFrame:
    """Arms that share one base at the link: ``[link-len5+1, link+1)`` and ``[link, link+len3)``, 0-based."""
    t, at = F.col(target), link.cast("int")
    t5, t3 = t.substr(at - len5 + 2, F.lit(len5)), t.substr(at + 1, F.lit(len3))
    return (rows.withColumn("ilock_tm", rounded(tm_nn(t), 2)).withColumn("ilock_tm5", rounded(tm_nn(t5), 2))
            .withColumn("ilock_tm3", rounded(tm_nn(t3), 2)).withColumn("ilock_bds", revcomp(t))
            .withColumn("ilock_bds5", revcomp(t5)).withColumn("ilock_bds3", revcomp(t3)))
