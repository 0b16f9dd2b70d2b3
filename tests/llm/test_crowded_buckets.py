"""A large group of near copies of which many do not link: few of its pairs are made, and no link is lost."""

import random

import numpy as np

from strandforge.llm import jaccard


def test_pairs_that_cannot_link_are_not_made(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(240):
        words = list(base)
        for k in rng.sample(range(150), rng.choice([2, 6, 7, 8, 9])):
            words[k] = f"x{i}k{k}"
        texts.append(" ".join(words))
    sets = [set(s.tolist()) for s in jaccard.shingle_sets([t.encode() for t in texts])]
    label = list(range(len(texts)))
    links = [(i, k) for i in range(len(texts)) for k in range(i) if 100 * len(sets[i] & sets[k]) >= 75 * len(sets[i] | sets[k])]
    for _ in texts:
        for i, k in links:
            label[i] = label[k] = min(label[i], label[k])

    made, verified = [], jaccard._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc: r.component for r in jaccard.similar_documents(docs).collect()}
    assert got == dict(enumerate(label)) and 1 < len(set(label)) < 240
    assert made[-1] <= 20  # 42 by sizes and places alone


def test_short_outlines_bound_from_above():
    rng = np.random.default_rng(3)
    for n, m, both in [(100, 110, 90), (1, 1, 1), (900, 700, 650), (5000, 4000, 3900), (150, 150, 0)]:
        h = rng.integers(0, 1 << 64, n + m - both, dtype=np.uint64)
        x, y = (jaccard.short_outline(s).view(np.uint64) for s in (h[:n], h[n - both:]))
        assert n - np.bitwise_count(x & ~y).sum() >= both <= m - np.bitwise_count(y & ~x).sum()
