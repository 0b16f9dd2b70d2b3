"""What the buckets of the similarity join write, and how often two rows of crowded buckets meet."""

import random

from strandforge.llm import jaccard


def near_copies(n: int) -> list[str]:
    rng = random.Random(5)
    base, texts = [f"w{i}" for i in range(150)], []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(150), rng.choice([2, 6, 7, 8, 9])):
            words[k] = f"x{i}k{k}"
        texts.append(" ".join(words))
    return texts


def test_pairs_of_crowded_buckets_meet_once(spark, monkeypatch):
    asked, rest = [], jaccard._rest_pairs
    monkeypatch.setattr(jaccard, "_rest_pairs", lambda *a: asked.append(a) or rest(*a))
    docs = spark.createDataFrame(list(enumerate(near_copies(240))), "doc_id bigint, text string")
    jaccard.similar_documents(docs)
    want = rest(*asked[0]).collect()
    with monkeypatch.context() as m:
        m.setattr(type(docs), "distinct", lambda df: df)
        every = rest(*asked[0]).collect()
    assert want and set(every) == set(want)
    assert len(every) <= 1.5 * len(want)


def test_no_pair_is_lost_beyond_the_listed_buckets(spark, monkeypatch):
    asked, rest = [], jaccard._rest_pairs
    monkeypatch.setattr(jaccard, "_rest_pairs", lambda *a: asked.append(a) or rest(*a))
    docs = spark.createDataFrame(list(enumerate(near_copies(120))), "doc_id bigint, text string")
    jaccard.similar_documents(docs)
    monkeypatch.setattr(jaccard, "CROWD", 0)
    want = set(rest(*asked[0]).collect())
    for firsts in (0, 1, 3):
        monkeypatch.setattr(jaccard, "FIRSTS", firsts)
        assert set(rest(*asked[0]).collect()) == want


def test_buckets_hold_no_turns_and_no_hub_twice(spark, monkeypatch):
    held, cut = {}, jaccard.cut_lineage
    monkeypatch.setattr(jaccard, "cut_lineage", lambda df, label="cut": held.setdefault(label, cut(df, label)) if label == "buckets" else cut(df, label))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " a b"), (3, text + " c"), (4, "none of these words")], "doc_id bigint, text string")
    got = {r.doc: r.component for r in jaccard.similar_documents(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    rows = held["buckets"].collect()
    assert rows and [f.name for f in held["buckets"].schema["hub1"].dataType] == ["gid", "n", "pos"]
    hubs = [(r.gid, [h.gid for h in (r.hub1, r.hub2) if h]) for r in rows]
    assert all(gid not in others and len(set(others)) == len(others) for gid, others in hubs)
