"""Codes: random codes, distance screens, colour and grade libraries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.sequence import hamming, has_run
from ..session import cut_lineage
from .offtarget import packed, packed_mismatches

# Colours with the number of grades of each, as whole steps of their fraction.
COLORS = {"Green": 2, "Red": 5, "Blue": 5, "Yellow": 5}


def random_codes(spark: SparkSession, count: int, length: int = 20, seed: int = 0) -> DataFrame:
    """Seeded random codes; the same call gives the same codes on any cluster."""
    return with_random_code(spark.range(count).withColumnRenamed("id", "code_no"), "code_no", length, seed)


def with_random_code(rows: DataFrame, key: str, length: int = 20, seed: int = 0) -> DataFrame:
    letters = F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.substring(
        F.lit("ATCG"), (F.pmod(F.xxhash64(F.col(key), i, F.lit(seed)), F.lit(4)) + 1).cast("int"), F.lit(1)))
    return rows.withColumn("code", F.array_join(letters, ""))


def _close_pairs(left: DataFrame, right: DataFrame, closer_than: int, ordered: bool) -> DataFrame:
    """(a_no, a, b_no, b, distance) of left(a_no, a, a_bits) and right(b_no, b, b_bits) that differ in fewer places than ``closer_than``.

    Cut into ``closer_than + 1`` pieces, two codes that differ in fewer places share at least two of them, so they
    meet in an equi-join on a pair of pieces, and those met several times are one row. Any letters and any lengths, of which only equal ones meet;
    what has no packed code is compared letter by letter. With ``ordered``, only pairs with a_no < b_no.
    """
    pieces = closer_than + 1

    def piece(code: Column, i: Column) -> Column:
        lo, hi = (F.floor(F.length(code) * x / pieces).cast("int") for x in (i, i + 1))
        return code.substr(lo + 1, hi - lo)

    def keyed(df: DataFrame, code: str) -> DataFrame:
        cut = df.select("*", F.length(code).alias("size"), F.transform(F.sequence(F.lit(0), F.lit(closer_than)), lambda i: piece(F.col(code), i)).alias("cut"))
        keys = F.array(*[F.struct(F.lit(i * pieces + j).alias("pair_no"), F.concat(F.col("cut")[i], F.col("cut")[j]).alias("piece"))
                         for i, j in combinations(range(pieces), 2)])
        return cut.select("*", F.explode(keys).alias("k")).select("*", "k.pair_no", "k.piece").drop("k", "cut")

    # few rows meet in very many pairs: a fixed number of partitions, which adaptive execution does not merge by their size
    on, spread = ["size", "pair_no", "piece"], 4 * left.sparkSession.sparkContext.defaultParallelism
    a, b = keyed(left, "a").repartition(spread, *on).alias("l"), keyed(right, "b").repartition(spread, *on).alias("r")
    quick = packed_mismatches(F.col("a_bits"), F.col("b_bits"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on]
    met = a.join(b, [*same, F.coalesce(quick, F.lit(0)) < closer_than, *([F.col("a_no") < F.col("b_no")] if ordered else [])])
    one = met.groupBy("a_no", "a", "b_no", "b").agg(F.min(quick).alias("quick"))
    return one.select("a_no", "a", "b_no", "b", F.coalesce("quick", hamming(F.col("a"), F.col("b"))).cast("bigint").alias("distance")).filter(
        F.col("distance") < closer_than)


def hamming_pairs(codes: DataFrame, closer_than: int, length: int = 20) -> DataFrame:
    """(code_a, code_b, distance) of distinct codes closer than ``closer_than``, ``code_a < code_b``.

    Any letters and any length; what does not fit a packed code is compared letter by letter.
    """
    one = codes.select("code").distinct().filter(F.length("code") == length).withColumn("bits", packed("code"))
    a, b = (one.select(F.col("code").alias(f"{x}_no"), F.col("code").alias(x), F.col("bits").alias(f"{x}_bits")) for x in "ab")
    return _close_pairs(a, b, closer_than, True).select(F.col("a").alias("code_a"), F.col("b").alias("code_b"), "distance")


def diverse_codes(codes: DataFrame, apart: int = 10, batch: int = 4096) -> DataFrame:
    """Scan codes in order of (``code_no``, code) and keep each that differs from all kept ones in ``apart`` places or more.

    Codes with GGGGG are left out; codes of unequal length are never too close. The scan is a greedy independent set of the graph of codes that are too
    close, settled by rounds of joins: a code without a smaller undecided neighbour is kept, its neighbours are dropped, and the edges that are
    left are written for the next round. ``batch`` codes are settled at a time, so that most others go as neighbours of kept ones before their own
    pairs are looked for; of a batch, the driver learns its last place alone.
    """
    every = codes.filter(~has_run("code", "G", 5)).groupBy("code").agg(F.min("code_no").alias("code_no")).withColumn("bits", packed("code"))
    left, kept = cut_lineage(every.select(F.struct("code_no", "code").alias("no"), "code", "bits"), "codes"), None

    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select(F.col("no").alias(f"{x}_no"), F.col("code").alias(x), F.col("bits").alias(f"{x}_bits"))

    while True:
        head = left.orderBy("no").limit(batch)
        edge = head.agg(F.max("no").alias("no"), F.count("*").alias("n")).first()
        if edge.n < batch:
            fresh = _independent(left, _close_pairs(side(left, "a"), side(left, "b"), apart, True))
            kept = fresh if kept is None else kept.unionByName(fresh)
            return kept.select("code_no", "code")
        last = F.struct(F.lit(edge.no.code_no).alias("code_no"), F.lit(edge.no.code).alias("code"))
        head = left.filter(F.col("no") <= last)
        fresh = _independent(head, _close_pairs(side(head, "a"), side(head, "b"), apart, True))
        kept = fresh if kept is None else kept.unionByName(fresh)
        rest = left.filter(F.col("no") > last)
        close = _close_pairs(side(fresh, "a"), side(rest, "b"), apart, False).select(F.col("b_no").alias("no"))
        left = cut_lineage(rest.join(close, "no", "left_anti"), "codes")


def _independent(codes: DataFrame, edges: DataFrame) -> DataFrame:
    """(no, code_no, code, bits): ``codes`` without the neighbours of kept ones; ``edges`` has a_no < b_no."""
    edges, gone = cut_lineage(edges.select("a_no", "b_no"), "edges"), []
    while edges.limit(1).count():
        keep = edges.select("a_no").distinct().join(edges.select(F.col("b_no").alias("a_no")), "a_no", "left_anti")
        drop = cut_lineage(edges.join(keep, "a_no").select(F.col("b_no").alias("no")).distinct(), "dropped")
        gone.append(drop)
        # whatever a dropped code is too close to is no longer held back by it
        edges = cut_lineage(edges.join(drop, F.col("b_no") == F.col("no"), "left_anti").join(drop, F.col("a_no") == F.col("no"), "left_anti"), "edges")
    for drop in gone:
        codes = codes.join(drop, "no", "left_anti")
    return cut_lineage(codes.select("no", "no.code_no", "code", "bits"), "kept")


def seq_lib(codes: DataFrame, colors: dict[str, int] = COLORS, lib: str = "lib", order: str = "code_no") -> DataFrame:
    """seq_lib(lib, seq, color, grade, fraction): the first codes of each library dealt to colours and grades.

    ``order`` counts from 0 within the library. A library with too few codes gives no rows; ``seq_lib_rejects`` lists it.
    """
    spark = codes.sparkSession
    slots = [(n, c, g, g / steps) for n, (c, g, steps) in enumerate(
        (c, g, steps) for c, steps in colors.items() for g in range(steps + 1))]
    table = spark.createDataFrame(slots, "slot BIGINT, color STRING, grade INT, fraction DOUBLE")
    enough = codes.filter(F.col(order) == len(slots) - 1).select(lib)
    return (codes.filter(F.col(order) < len(slots)).join(enough, lib, "left_semi")
            .join(F.broadcast(table), F.col(order) == F.col("slot"))
            .select(lib, F.col("code").alias("seq"), "color", "grade", "fraction"))


def seq_lib_rejects(codes: DataFrame, colors: dict[str, int] = COLORS, lib: str = "lib", order: str = "code_no") -> DataFrame:
    """(lib, codes, reason): libraries that ``seq_lib``, and with it ``barcode_lib``, leaves out."""
    needed = sum(steps + 1 for steps in colors.values())
    return (codes.groupBy(lib).agg(F.count("*").alias("codes"), F.max(F.coalesce(F.col(order) == needed - 1, F.lit(False))).alias("_enough"))
            .filter("NOT _enough").select(lib, "codes", F.lit("too few codes").alias("reason")))


def grade_product(library: DataFrame, order: list[str], lib: str = "lib") -> DataFrame:
    """All combinations of one grade per colour, in a row per library that is exploded colour by colour.

    Columns ``<color>`` (grade) and ``<color>seq``. The lists are as long as the grades of a colour.
    """
    rows = library.groupBy(lib).agg(*[F.sort_array(F.collect_list(F.when(
        F.col("color") == c, F.struct("grade", "seq")))).alias(f"_{c}") for c in order])
    for c in order:
        rows = rows.withColumn(f"_{c}", F.explode(f"_{c}"))
    return rows.select(lib, *[F.col(f"_{c}.grade").alias(c) for c in order], *[F.col(f"_{c}.seq").alias(f"{c}seq") for c in order])


def barcode_lib(library: DataFrame, order: list[str], sum_num: int | None = 5,
                sum_list: tuple = ("Red", "Yellow", "Blue"), lib: str = "lib") -> DataFrame:
    """Combinations whose chosen grades add up to ``sum_num``, with their codes joined in colour order."""
    rows = grade_product(library, order, lib)
    total = sum((F.col(c) for c in sum_list[1:]), F.col(sum_list[0]))
    rows = rows.withColumn("sum", total.cast("bigint"))
    if sum_num is not None:
        rows = rows.filter(F.col("sum") == sum_num)
    return rows.withColumn("barcode", F.concat(*[F.col(f"{c}seq") for c in order]))


def code_lookup(wanted: DataFrame, library: DataFrame, lib: str = "lib") -> DataFrame:
    """(lib, color, grade) -> seq."""
    return wanted.join(library.select(lib, "color", "grade", "seq"), [lib, "color", "grade"])
