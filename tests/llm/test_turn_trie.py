"""The trie of conversations against a plain one, and subtree totals of trees of any shape against a plain walk."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandforge.llm import queries, turn_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Nodes of the rebuilt conversations, one conversation after the other."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    leaves, saved, out = {}, {}, []
    for key in sorted(members, key=len, reverse=True):
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = sum(leaves[k] for k in kids[key]) if kids[key] else 1
        saved[key] = (len(members[key]) - 1) * n_words + sum(saved[k] for k in kids[key])
        out.append((members[key][0], len(key), members[key[:-1]][0] if key else None, len(members[key]), len(kids[key]), leaves[key], saved[key],
                    hashlib.sha256(",".join(map(str, ends[key])).encode()).hexdigest()))
    return sorted(map(str, out))


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    return sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


def hostile():
    rng = random.Random(8)
    rows = [(None, 0, "user", "nobody"), (0, None, None, None), (0, None, "user", ""), (0, 3, "user", "a b"), (0, 3, "user", "a b"),
            (41, 0, "system", "only one"), (40, 0, "user", "x"), (1 << 40, 5, "user", "far"), (63, 1, "a", "no base")]
    for c in range(1, 38):
        for t in range(rng.randint(0, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi there", "", "what\tnow\n?", "é €"])))
    return rows + [(59, t, "user", f"line {t % 3}") for t in range(120)] + [(58, t, "user", f"line {t % 3}") for t in range(90)]


@pytest.mark.parametrize("small", [False, True])
def test_hostile(spark, monkeypatch, small):
    if small:
        for name, value in (("BLOCK", 7), ("CHUNK_BITS", 1), ("FEW", 2), ("HEAVY", 10**6)):
            monkeypatch.setattr(turn_trie, name, value)
    rows = hostile()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", id string, depth int")
    assert got(turn_trie.conversation_trie(df)) == plain(rows)


def test_turnless_and_empty(spark):
    # conversations whose few turns all give way to those of an absent one
    bare = [c for c in range(61, 79) if zlib.crc32(str(c).encode()) % 4][:4]
    rows = [(c, 0, "user", "gone") for c in bare]
    assert got(turn_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert len(plain(rows)) == 1
    assert turn_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_table(spark):
    df = queries.table(spark, "/root/testdata/sf0.001", "conversations")
    assert got(turn_trie.conversation_trie(df)) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("shape", ["chain", "star", "random", "combs", "forest"])
def test_subtree_totals(spark, shape):
    rng = random.Random(shape)
    n = 400
    parent = {0: None}
    for v in range(1, n):
        parent[v] = {"chain": v - 1, "star": 0, "random": rng.randrange(v), "combs": v - 1 if v % 3 else max(0, v - 3),
                     "forest": rng.choice([None, v - 1, v - 1, rng.randrange(v)])}[shape]
    depth, kids = {}, defaultdict(int)
    for v in range(n):
        depth[v] = 0 if parent[v] is None else depth[parent[v]] + 1
        kids[parent[v]] += 1
    # names that say nothing of the order
    name = dict(zip(range(n), rng.sample(range(10**6), n)))
    name[None] = None
    worth = {v: rng.randint(-9, 9) for v in range(n)}
    total = dict(worth)
    for v in sorted(range(n), key=depth.get, reverse=True):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    nodes = spark.createDataFrame([(name[v], name[parent[v]], kids[v], depth[v], worth[v]) for v in range(n)],
                                  "id bigint, parent bigint, n_children bigint, depth bigint, worth bigint")
    told = turn_trie.subtree_totals(nodes, ["worth"]).collect()
    assert len(told) == n and {r.id: r.worth for r in told} == {name[v]: total[v] for v in range(n)}


def test_rounds_grow_slowly(spark, monkeypatch):
    rounds = []
    cut = turn_trie.cut_lineage
    monkeypatch.setattr(turn_trie, "cut_lineage", lambda df, label: rounds.append(label) or cut(df, label))
    nodes = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
                                     F.when(F.col("id") < 999, 1).otherwise(0).cast("bigint").alias("n_children"),
                                     F.col("id").alias("depth"), F.lit(1).cast("bigint").alias("one"))
    told = turn_trie.subtree_totals(nodes, ["one"])
    assert {r.id: r.one for r in told.collect()} == {v: 1000 - v for v in range(1000)}
    assert rounds.count("raked") <= 13
