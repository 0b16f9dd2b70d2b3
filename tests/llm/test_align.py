"""Lockstep merging against a plain merge over the two libraries, and corpus counts against a plain count."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandforge.llm import align, queries

from .test_operators import HOSTILE, documents, words

MORE = [(20, "a▁b"), (21, "<|endoftext|> and <s> and <unk> <0x41>"), (22, " lead"), (23, "trail "), (24, "two  blanks\n\n \t x"),
        (25, " 　 ﻿"), (26, "é \U0001f600\U0001f468‍\U0001f469"), (27, "aaaa" * 3000), (28, words(3000, 9)), (1, "again"),
        (29, "\x00\x01"), (30, " "), (31, "\n"), (32, "don't we'll 12 345,678.9 x_y")]


def plain(given):
    """Rows and pairs by the libraries alone, one document and one token at a time."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=queries.pieces_path())
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in letters}
    byte_of.update({chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in letters)})
    rows = []
    for doc, text in given:
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            rows.append((doc, 0, 0, 0, 0, "", []))
            continue
        i = j = 0
        a_end, b_end = len(a_bytes[0]), len(b_bytes[0])
        links, groups, left, right = [], [], [a[0]], [b[0]]
        while True:
            links.append((a[i], b[j]))
            step_a, step_b = a_end <= b_end, b_end <= a_end
            if a_end == b_end:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
                if i + 1 == len(a):
                    break
            if step_a:
                i += 1
                a_end += len(a_bytes[i])
                left.append(a[i])
            if step_b:
                j += 1
                b_end += len(b_bytes[j])
                right.append(b[j])
        rows.append((doc, len(a), len(b), len(groups), len(links), ";".join(groups), links))
    return rows


def want(given):
    rows = plain(given)
    docs = Counter(p for r in rows for p in set(r[6]))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(str((*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[5] else "", sum(docs[p] == best[p[0]] for p in r[6]),
                       sum(docs[p] for p in r[6]))) for r in rows)


def got(df):
    return sorted(str((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum)) for r in df.collect())


@pytest.mark.parametrize("hot", [0, 40, align.HOT_PAIRS])
def test_hostile(spark, monkeypatch, hot):
    monkeypatch.setattr(align.link_scores, "__defaults__", (hot,))
    given = HOSTILE + MORE
    assert got(align.scored(documents(spark, clash=True, rows=given), queries.ranks_path(), queries.pieces_path())) == want(given)


def test_empty(spark):
    assert align.scored(documents(spark, rows=[]), queries.ranks_path(), queries.pieces_path()).count() == 0


def test_given_table(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    assert got(queries.QUERIES["op12_align"](spark, "/root/testdata/sf0.001")) == want([(r.doc_id, r.text) for r in docs.collect()])


def test_written_groups(spark):
    given = HOSTILE + MORE
    told = align.align_tokens(documents(spark, rows=given), queries.ranks_path(), queries.pieces_path(), ("groups", "pairs"))
    assert sorted((str(r.doc), r.groups) for r in told.collect()) == sorted((str(r[0]), r[5]) for r in plain(given))
    pairs = {r.doc: {(p.a, p.b): p.links for p in r.pairs} for r in told.filter("doc > 1").collect()}
    assert pairs == {r[0]: dict(Counter(r[6])) for r in plain(given) if r[0] and r[0] > 1}


def test_lanes_change_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = [rng.integers(1, 400, 40)]
    a_ends, b_ends, first, stop, base = [], [], [], [], 0
    for n in sizes[0]:
        width = int(n) * 7
        a = np.unique(np.append(rng.choice(width, int(n), replace=False), width))
        b = np.unique(np.append(rng.choice(width, int(n), replace=False), width))
        a, b = a[a > 0], b[b > 0]
        first.append(sum(map(len, a_ends)))
        a_ends.append(a + base)
        b_ends.append(b + base)
        stop.append(first[-1] + len(a))
        base += width
    args = np.concatenate(a_ends), np.concatenate(b_ends), np.array(first), np.array(stop)
    told = [sorted(zip(*(x.tolist() for x in align.merge(*args)[:2])))]
    monkeypatch.setattr(align, "LANE", 5)
    told.append(sorted(zip(*(x.tolist() for x in align.merge(*args)[:2]))))
    assert told[0] == told[1]
    a0 = np.append(0, args[0][:-1])
    b0 = np.append(0, args[1][:-1])
    assert told[0] == [(i, j) for i in range(len(a0)) for j in range(len(b0)) if max(a0[i], b0[j]) < min(args[0][i], args[1][j])]


def test_threshold(spark):
    counts = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,)], "docs bigint")
    assert [align.hot_threshold(counts, n) for n in (0, 1, 2, 3, 4, 5)] == [16, 4, 4, 2, 2, 1]
    assert align.hot_threshold(counts.filter(F.lit(False)), 5) == 1
