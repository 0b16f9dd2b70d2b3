"""Shards of the suffix index: slices of whole anchors, and marks that do not depend on how anchors are sliced."""

import numpy as np
import pandas as pd

from strandforge.llm import suffix_dedup


def test_parts_keep_anchors_whole(monkeypatch):
    rng = np.random.default_rng(3)
    for part in (1, 2, 7, 1000):
        monkeypatch.setattr(suffix_dedup, "PART", part)
        for n in (0, 1, 2, 50):
            anchor = np.sort(rng.integers(-6, 6, n))
            slices = list(suffix_dedup._parts(anchor))
            assert [i for s in slices for i in range(s.start, s.stop)] == list(range(n))
            for s in slices:
                assert s.start == 0 or anchor[s.start - 1] != anchor[s.start]
                assert s.stop - s.start <= part or len(set(anchor[s])) == 1


def test_shard_marks_the_same_however_it_is_sliced(monkeypatch):
    rng = np.random.default_rng(4)
    common = [bytes(rng.integers(97, 100, 168, dtype=np.uint8)) for _ in range(9)]  # equal windows have equal anchors
    rows = []
    for doc in range(60):
        anchor, cut = int(rng.integers(0, 9)), int(rng.integers(0, 69))
        rows.append((anchor, doc, doc * 7, 0, common[anchor][cut:cut + int(rng.integers(20, 168))]))
    rows = pd.DataFrame(rows, columns=["anchor", "doc", "tie", "start", "context"])
    told = []
    for part in (1, 16, 4096):
        monkeypatch.setattr(suffix_dedup, "PART", part)
        told.append(set(suffix_dedup._shard(rows).itertuples(index=False, name=None)))
    want = set()
    for anchor, group in rows.groupby("anchor"):
        seen, spans = set(), {}
        for r in group.sort_values(["doc", "tie", "start"]).itertuples():
            windows = [r.context[i:i + 100] for i in range(len(r.context) - 99)]
            spans[r.doc, r.tie] = [i for i, w in enumerate(windows) if w in seen]
            seen |= set(windows)
        for (doc, tie), places in spans.items():
            if places:
                assert places[-1] - places[0] < 100  # one run
                want.add((doc, tie, places[0], places[-1] + 100))
    assert want and told[0] == told[1] == told[2] == want
    assert len(suffix_dedup._shard(rows.iloc[:1])) == 0 and len(suffix_dedup._shard(rows.iloc[:0])) == 0
