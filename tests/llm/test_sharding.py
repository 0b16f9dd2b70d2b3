"""Jump consistent hashing against the published walk, on hostile rows and through written folders."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from strandforge.llm import sharding

from .test_operators import HOSTILE, documents


def walk(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * sharding.MULTIPLIER + 1) & ((1 << 64) - 1)
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_published_vectors(spark):
    given = [(1, 1, 0), (42, 57, 43), (0xDEAD10CC, 1, 0), (0xDEAD10CC, 666, 361), (256, 1024, 520)]
    for key, shards, want in given:
        assert walk(key, shards) == want
        assert spark.range(1).select(sharding.jump_shards(F.lit(key), [shards])[0].alias("s")).first().s == want


def test_walks(spark):
    rng = random.Random(5)
    keys = [0, 1, -1, 2**63 - 1, -2**63, *[rng.randrange(-2**63, 2**63) for _ in range(300)]]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for counts in ([1], [8, 9], [64, 65], [3, 700]):
        for r in df.select("k", sharding.jump_shards(F.col("k"), counts).alias("s")).collect():
            assert list(r.s) == [walk(r.k, n) for n in counts]
    with pytest.raises(ValueError):
        sharding.jump_shards(F.lit(1), [0])


def check(rows, given, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given)
    for r in rows:
        assert r.law == "key" and r.shard == walk(r.doc_id or 0, shards) and r.grown_shard in (r.shard, shards)
        assert r.grown_shard == walk(r.doc_id or 0, shards + 1)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_hostile(spark):
    given = HOSTILE + [(1, "again"), (1, HOSTILE[0][1]), (None, None), (None, None), (-7, "below"), (-2**63, ""), (2**63 - 1, "é")]
    check(sharding.sharded(documents(spark, clash=True, rows=given)).collect(), given, 8)
    check(sharding.sharded(documents(spark, rows=given), 1).collect(), given, 1)
    assert sharding.sharded(documents(spark, rows=[])).count() == 0


def test_many_copies_in_small_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 16)
    given = [(4, "copy")] * 1000 + [(5, "copy")] * 17 + [(None, None)] * 33
    check(sharding.sharded(documents(spark, rows=given), 2).collect(), given, 2)


def test_placement_keeps_columns(spark):
    docs = documents(spark).withColumn("Size", F.lit("x")).withColumn("slot", F.lit("y")).withColumn("shard", F.lit("z"))
    placed = sharding.place(docs, 5, grown=9)
    assert placed.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "size", "text_crc32", "law", "shard", "grown_shard"]
    assert placed.count() == len(HOSTILE) and "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    assert all(r.grown_shard >= 5 for r in sharding.moved(placed).collect())
    by_text = sharding.place(docs, 5, key=sharding.stable_key("text"))
    assert {r.doc_id: r.shard for r in by_text.collect()}[1] == {r.doc_id: r.shard for r in by_text.collect()}[2]


def test_written_folders(spark, tmp_path):
    sharding.write_shards(documents(spark), f"{tmp_path}/shards", 4, files=2)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted((str(r.doc_id), r.text or "") for r in back.collect()) == sorted((str(i), t or "") for i, t in HOSTILE)
    assert all(r.shard == walk(r.doc_id or 0, 4) for r in back.collect())
