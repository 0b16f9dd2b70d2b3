"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

1. Equal vectors are one class, known by its vector and its smallest ids (as many as a result can need), so copies cost nothing.
2. Centres of lists come from k-means over a bounded sample; their number grows with the square root of the classes. Every class goes into the
   list of its nearest centre. Vectors are scaled to length 1, turned by one random rotation and stored in slices of a list, as blocks of
   columns; the original vectors lie beside them. Slices bound what a task holds, however large a list is.
3. A query meets the slices of its nearest lists. In each, distances over the first block are taken to all vectors; the exact distances of
   the nearest of them set the bar. Block by block, candidates whose distance so far, scaled to all dimensions, passes the bar by
   more than the test allows are abandoned; on a random rotation that distance is concentrated, so an abandoned candidate is a true
   neighbour only with small probability (``EPSILON``). Survivors are compared by cosine on the original vectors in double precision.
4. The best of every slice are merged; every query row takes the result of its class, without itself.

Queries are probed in a share of the lists (``probe_share``; 0.6 finds over nine in ten neighbours even where vectors have no clusters), and in
as many more as it takes to hold all that a result needs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do those of another
dimension than most (ties: the larger one); rows with a null id take no part; an id that is repeated is a candidate with each of its vectors; ties
go to the smaller id; with fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

NEAREST, PROBE_SHARE = 5, 0.6
#: Classes that centres are fitted on, rounds of k-means, lists per square root of the classes, and the most lists.
SAMPLE, ROUNDS, LISTS_PER_ROOT, MOST_LISTS = 16_384, 8, 1.0, 4096
SLICE, QUERY_BLOCK = 2048, 512
COLUMNS = 16
EPSILON = 2.1
SEED = 11


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int) -> list[tuple[int, int]]:
    return [(a, min(a + COLUMNS, dim)) for a in range(0, dim, COLUMNS)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def centres_of(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means; an empty list keeps its centre."""
    rng = np.random.default_rng(SEED)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = (sample @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 0, total / np.maximum(norm, 1e-30), centres)
    return centres


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """id, dim, vec (doubles as bytes) of the vectors that take part, of whatever dimension."""
    plain = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v")).filter(
        "id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")

    def kernel(batches):
        for b in batches:
            column = b.column("v")
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy() + 0.0  # -0 becomes 0
            vecs = [flat[a:z].tobytes() for a, z in zip(offsets[:-1], offsets[1:])]
            yield pa.record_batch([b.column("id"), pa.array(np.diff(offsets), pa.int32()), pa.array(vecs, pa.binary())], names=["id", "dim", "vec"])

    return plain.mapInArrow(kernel, "id bigint, dim int, vec binary")


def _nearest_lists(shared, only_first: bool):
    """Per class its list, or per query the lists that it probes."""
    def kernel(batches):
        centres, sizes, probes, need = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            vecs = b.column("vec").to_pylist()
            near = unit(np.frombuffer(b"".join(vecs)).reshape(len(vecs), -1)) @ centres.T
            if only_first:
                yield pa.record_batch([pa.array(near.argmax(axis=1), pa.int32()), *b.columns], names=["list", *b.schema.names])
                continue
            order = np.argsort(-near, axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            wanted = (np.arange(order.shape[1]) < probes) | (before < need)
            at, place = np.nonzero(wanted & (sizes[order] > 0))
            yield pa.record_batch([pa.array(order[at, place], pa.int32()), *[c.take(pa.array(at)) for c in b.columns]], names=["list", *b.schema.names])
    return kernel


def build_index(classes: DataFrame, dim: int, centres: np.ndarray, lists: dict[int, int]) -> DataFrame:
    """list, slice, ids, vecs, blocks: rotated vectors of a slice as blocks of columns."""
    turn = rotation(dim)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        raw = b"".join(rows["vec"])
        turned = (unit(np.frombuffer(raw).reshape(len(rows), dim)) @ turn).astype(np.float32)
        blocks = [np.ascontiguousarray(turned[:, a:z]).tobytes() for a, z in blocks_of(dim)]
        return pd.DataFrame({"list": [rows["list"].iloc[0]], "slice": [rows["slice"].iloc[0]], "ids": [[list(x) for x in rows["ids"]]], "vecs": [raw], "blocks": [blocks]})

    parts = F.create_map(*[F.lit(x) for k, n in lists.items() for x in (k, -(-n // SLICE))])
    cut = classes.withColumn("slice", F.pmod(F.xxhash64("vec"), parts[F.col("list")].cast("bigint")).cast("int"))
    return cut.groupBy("list", "slice").applyInPandas(pack, "list int, slice int, ids array<array<bigint>>, vecs binary, blocks array<binary>")


def scan(query: np.ndarray, blocks: list[np.ndarray], dim: int, need: int) -> np.ndarray:
    """Rows of a slice that may be among the ``need`` nearest to one rotated query."""
    count = len(blocks[0])
    done = blocks[0].shape[1]
    part = ((blocks[0] - query[:done]) ** 2).sum(axis=1)
    if count <= need or len(blocks) == 1:
        return np.arange(count) if count <= need else np.argpartition(part, need - 1)[:need]
    first = np.argpartition(part, need - 1)[:need]
    whole, at = part[first].copy(), done
    for block in blocks[1:]:
        whole += ((block[first] - query[at:at + block.shape[1]]) ** 2).sum(axis=1)
        at += block.shape[1]
    bar = whole.max()
    left = np.arange(count)
    for block in blocks[1:]:
        keep = part * (dim / done) <= bar * (1 + EPSILON / np.sqrt(done)) ** 2
        left, part = left[keep], part[keep]
        part = part + ((block[left] - query[done:done + block.shape[1]]) ** 2).sum(axis=1)
        done += block.shape[1]
        if len(left) > need and done == dim:
            bar = min(bar, np.partition(part, need - 1)[need - 1])
    return left[part <= bar * (1 + 1e-5) + 1e-9]


def _search(dim: int, need: int):
    turn = rotation(dim)

    def kernel(queries: pd.DataFrame, slices: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(slices):
            held = slices.iloc[0]
            blocks = [np.frombuffer(x, np.float32).reshape(len(held["ids"]), -1) for x in held["blocks"]]
            own = unit(np.frombuffer(held["vecs"]).reshape(-1, dim))
            asked = unit(np.frombuffer(b"".join(queries["vec"])).reshape(-1, dim))
            turned = (asked @ turn).astype(np.float32)
            for i, vec in enumerate(queries["vec"]):
                left = scan(turned[i], blocks, dim, need)
                score = (own[left] * asked[i]).sum(axis=1)
                some = sorted((-s, int(x)) for s, k in zip(score.tolist(), left.tolist()) for x in held["ids"][k])[:need]
                out += [(vec, x, -s) for s, x in some]
        return pd.DataFrame(out, columns=["vec", "near", "score"])
    return kernel


def nearest(rows: DataFrame, is_query, nearest: int = NEAREST, probe_share: float = PROBE_SHARE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` rows found of the largest cosine, for each row whose ``id`` satisfies ``is_query``."""
    spark, need = rows.sparkSession, nearest + 1  # a class may hold the query itself
    found = cut_lineage(usable(rows, vec_id, embedding), "vectors")
    most = found.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = most["dim"]
    found = found.filter(F.col("dim") == dim).select("id", "vec").distinct()
    low = found.withColumn("k", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("k") <= need)
    classes = cut_lineage(low.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    count = classes.count()
    # hashes below a bound that twice the sample is expected to reach: what tasks send does not grow with their number
    share = min(1.0, (2 * SAMPLE + 1000) / max(1, count))
    low_hash = classes.select("vec").filter(F.xxhash64("vec") <= int(share * (2**64 - 1)) - 2**63) if share < 1 else classes.select("vec")
    sample = [r["vec"] for r in low_hash.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()]  # bounded
    wanted = int(min(MOST_LISTS, max(1, LISTS_PER_ROOT * np.sqrt(count)), max(1, len(sample) // 4)))
    centres = centres_of(unit(np.frombuffer(b"".join(sample)).reshape(-1, dim)), wanted)
    listed = cut_lineage(classes.mapInArrow(_nearest_lists(spark.sparkContext.broadcast((centres, None, 0, 0)), True),
                                            "list int, vec binary, ids array<bigint>"), "lists")
    told = listed.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).collect()  # a row per list
    sizes = np.zeros(len(centres), np.int64)
    for r in told:
        sizes[r["list"]] = r["ids"]
    index = cut_lineage(build_index(listed, dim, centres, {r["list"]: r["n"] for r in told}), "index")
    queries = cut_lineage(found.filter(is_query), "queries")
    asked = queries.select("vec").distinct().mapInArrow(
        _nearest_lists(spark.sparkContext.broadcast((centres, sizes, int(np.ceil(probe_share * len(centres))), need)), False), "list int, vec binary")
    asked = cut_lineage(asked, "probes")
    load = {r["list"]: -(-r["count"] // QUERY_BLOCK) for r in asked.groupBy("list").count().collect()}  # a row per list
    if not load:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    blocks = F.create_map(*[F.lit(x) for k, n in load.items() for x in (k, n)])
    slices = F.create_map(*[F.lit(x) for r in told for x in (r["list"], -(-r["n"] // SLICE))])
    left = asked.withColumn("block", F.pmod(F.xxhash64("vec"), blocks[F.col("list")].cast("bigint")).cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), slices[F.col("list")] - 1)))
    right = index.filter(F.col("list").isin(list(load))).withColumn("block", F.explode(F.sequence(F.lit(0), blocks[F.col("list")] - 1)))
    keys = ["list", "slice", "block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(dim, need), "vec binary, near bigint, score double")
    nearer = Window.partitionBy("vec").orderBy(F.desc("score"), "near")
    best = cut_lineage(best.withColumn("k", F.row_number().over(nearer)).filter(F.col("k") <= need).drop("k"), "nearest")
    pairs = queries.withColumnRenamed("id", "query_id").join(best, "vec").filter("near <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "near")
    return (pairs.select("query_id", F.row_number().over(rank).alias("rank"), F.col("near").alias("vec_id"), "score")
            .filter(F.col("rank") <= nearest))
