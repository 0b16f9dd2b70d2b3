"""Line dedup through insertions and deletions, and joins of documents whose ids repeat or are missing."""

from __future__ import annotations

import random

import numpy as np
import pytest

from strandforge.llm import jaccard, line_dedup

from .test_operators import documents, words


@pytest.mark.parametrize("n", [1, 2, 40, 1000])
def test_cuckoo_removes_what_it_holds(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        k1, k2 = rng.integers(0, 2**63, (2, n + 60)).astype(np.uint64)
        held = line_dedup.Cuckoo.sized(2 * (n + 60))
        assert held.add(k1, k2)
        held.remove(k1[:n], k2[:n])
        assert held.maybe(k1[n:], k2[n:]).all() and np.count_nonzero(held.table) == 60
        assert held.add(k1[:n], k2[:n]) and held.maybe(k1, k2).all() and np.count_nonzero(held.table) == n + 60


def test_index_after_deletions_is_that_of_the_rest(spark):
    rng = random.Random(3)
    pool = [words(4, 100 + i) for i in range(60)]
    texts = {i: "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9))) for i in range(1, 121)}
    refs = line_dedup.line_refs(documents(spark, rows=list(texts.items()))).cache()
    index, held = line_dedup.LineIndex(spark, 3), set()
    for step in range(5):
        if step % 2 and held:
            ids = set(rng.sample(sorted(held), 40)) | {999}
            index.delete(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"))
            held -= ids
        else:
            ids = set(rng.sample(sorted(set(texts) - held), 50))
            index.insert(refs.filter(refs.doc.isin(list(ids))))
            held |= ids
    fresh = line_dedup.LineIndex(spark, 3)
    fresh.insert(refs.filter(refs.doc.isin(list(held))))
    for name in ("refs", "counts"):
        columns = sorted(getattr(index, name).columns)
        told, want = (sorted(map(tuple, getattr(i, name).select(columns).collect())) for i in (index, fresh))
        assert told == want and told
    drops = [sorted((r.doc, sorted(map(tuple, r["keys"]))) for r in i.drops().collect()) for i in (index, fresh)]
    assert drops[0] == drops[1] and drops[0]
    tables = {r.shard: line_dedup.Cuckoo(np.frombuffer(r.buckets, np.uint16).reshape(-1, line_dedup.SLOTS)) for r in index.filters.collect()}
    counts = index.counts.toPandas()
    for shard, keys in counts.groupby("shard"):
        assert tables[shard].maybe(*line_dedup._unsigned(keys)).all() and np.count_nonzero(tables[shard].table) == len(keys)
    index.delete(spark.createDataFrame([(i,) for i in held], "doc_id bigint"))
    assert index.counts.count() == index.refs.count() == 0
    index.insert(refs.filter(refs.doc.isin([1, 2, 3])))
    assert index.counts.count() == len({k for k in refs.filter("doc <= 3").select("k1", "k2").distinct().collect()})


def test_similar_documents_with_repeated_and_missing_ids(spark):
    body, other = words(60, 1), words(60, 2)
    rows = [(1, body), (1, other), (1, body), (2, body + " tail"), (None, body), (None, None), (3, other + " end"), (3, None), (0, words(40, 9)),
            (0, other), (5, words(50, 5)), (5, words(50, 6))]
    told = jaccard.similar_documents(documents(spark, rows=rows)).collect()
    assert len(told) == len(rows)
    assert {(r.doc, r.component) for r in told} == {(1, 0), (2, 0), (None, None), (3, 0), (3, 3), (0, 0), (5, 5)}
    assert jaccard.drop_similar(documents(spark, rows=rows)).count() == 6
