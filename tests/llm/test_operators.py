"""The dealt operators against brute force on small hostile tables: nulls, empty and long texts, repeats, empty tables, clashing names."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from strandforge.llm import ann, decontaminate, jaccard, langid, line_dedup, packing, pii, queries, suffix_dedup, toxicity, warc
from tools.compare import canon

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ", row string, doc string, words string, keys int, score string, n int, own string, list int, data string, hits int"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7))) for _ in range(n))


BODY = words(120, 1)
HOSTILE = [
    (1, BODY), (2, BODY), (3, BODY + " and a tail"), (4, None), (5, ""), (6, " \n\n\t"), (7, "\n".join([words(8, 2)] * 3)),
    (8, words(8, 2).upper() + "\n" + words(40, 3)), (9, "1" * 3000), (10, words(4000, 4)), (11, "é€😀 " * 80), (12, "éé " + words(40, 3)), (13, "ab"),
    (14, "call +1 (425) 555-9684 or mail a.b@c.example.com from 10.0.0.1, card 4111 1111 1111 1111"), (None, "no id " + words(30, 5)), (15, BODY[50:]),
]


def documents(spark, clash: bool = False, rows=HOSTILE):
    extra = ("r", "d", "w", 1, "s", 2, "o", 3, "x", 4) if clash else ()
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *extra) for i, t in rows], DOCS + (CLASH if clash else ""))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    order = sorted(df.columns)
    cur = con.execute(queries.SQL[name])
    at = [sorted(d[0] for d in cur.description).index(c) for c in order]
    names = [d[0] for d in cur.description]
    assert sorted(names) == order and at == list(range(len(order)))
    got = sorted(tuple(canon(r[c]) for c in order) for r in df.collect())
    assert got and got == sorted(tuple(canon(r[names.index(c)]) for c in order) for r in cur.fetchall())


# 1

def test_ann_hostile(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 400)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] * 8), (404, [None] * 8), (405, [1.0] * 7), (406, [float("inf")] * 8), (None, [1.0] * 8), (7, rows[7][1])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "id % 50 = 0", probe_share=1.0).collect()
    held = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:400]}
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == set(range(0, 400, 50))
    hit = 0
    for q, found in by.items():
        found.sort()
        assert [k for k, _, _ in found] == [1, 2, 3, 4, 5] and all(abs(s - held[q] @ held[v]) < 1e-12 for _, v, s in found)
        want = sorted((-round(float(held[q] @ v), 12), i) for i, v in held.items() if i != q)[:5]
        hit += len({i for _, i in want} & {v for _, v, _ in found})
    assert hit >= 0.9 * 5 * len(by)
    assert [v for _, v, _ in by[300]] == [301, 302, 303, 304, 305]


def test_ann_few_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = ann.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema), "id = 0").collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 2), (2, 1)]
    assert ann.nearest(spark.createDataFrame([], schema), "id = 0").count() == 0


# 2

def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    lines = [(i, [(p, low(p.strip(strip))) for p in (t or "").split("\n")]) for i, t in rows]
    held = {}
    for i, parts in lines:
        for _, k in parts:
            if len(k) >= 10:
                held.setdefault(k, set()).add(i)
    return {i: (len(p), "\n".join(x for x, k in p if len(held.get(k, ())) < 2 or min(held[k]) == i)) for i, p in lines}


def test_line_dedup_hostile(spark):
    rows = [r for r in HOSTILE if r[0] is not None]
    want = brute_lines(rows)
    out = line_dedup.dedup_lines(documents(spark, True, rows)).collect()
    assert {r.doc_id: (r.n_lines, r.text or "") for r in out} == want and out[0].row == "r"
    assert line_dedup.dedup_lines(documents(spark, rows=HOSTILE)).count() == len(HOSTILE)
    assert line_dedup.dedup_lines(documents(spark, rows=[])).count() == 0


# 3

def plain_spans(t):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, t):
            g = re.sub(r"[^0-9]", "", m[0])
            if (k == 1 and any(int(x) > 255 for x in m[0].split("."))) or (k == 2 and not (14 <= len(g) <= 19 and pii.luhn(g))) or (k == 3 and not 10 <= len(g) <= 15):
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


ODD = ["a@b.c@d.e", "..@x.y a@b@c.d", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "+1 (2) 345-678-9012 ", "4111 1111 1111 1111-", "x" * 50 + "@y.z", "@a.b", "a@b", "é@b.co 1.1.1.1é"]


def test_base_spans():
    rng = random.Random(4)
    for t in ODD + ["".join(rng.choice("a1@.+ -") for _ in range(60)) for _ in range(500)]:
        assert pii.base_spans(t) == plain_spans(t), t


def test_pii_long_stretches():
    """A number is found wherever it lies in a stretch that is cut."""
    known = {f: i + 1 for i, f in enumerate(("bias", "groups3-3-4", "first0", "last0"))}
    weights = np.zeros((4, 5))
    weights[:, 1], weights[3, 2:] = -45, (40, 10, 10)
    field, filler, number = pii.Field(known, weights), "7 ab " * 600, " 425-555-9610 "
    for at in [0, *range(pii.STRETCH - 30, pii.STRETCH + 15, 3), pii.STRETCH + 245]:
        text = filler[:at] + number + filler[at:]
        assert field.added(text, []) == [(at + 1, at + 13, 3)], at
    assert field.added(filler, []) == []


def test_pii_hostile(spark):
    rows = HOSTILE + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, f"{words(5, i)} +1 (425) 555-96{10 + i} {words(5, i + 50)} {i}@mail.example.com") for i in range(40)]
    docs = documents(spark, True, rows)
    got = {r.doc_id: r for r in pii.find_spans(docs, pii.train(docs)).collect()}
    for i, t in rows:
        base = plain_spans(t or "")
        r = got[i]
        joined = [f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base]
        assert r.base_sha256 == sha(",".join(joined).encode()) and [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[2] == j for x in base) for j in range(4)]
        assert set(joined) <= set(r.spans.split(",")) or not joined
    empty = documents(spark, rows=[])
    assert pii.find_spans(empty, pii.train(empty)).count() == 0


def test_field_adds_what_patterns_miss():
    rng = random.Random(1)
    number = lambda: f"+1 ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
    field = pii.fit([f"{words(6, i)} {number()} {words(6, i + 100)}" for i in range(80)])
    text = words(5, 300) + " 001 (425) 555-9684 " + words(5, 301)
    assert [text[s:e] for s, e, k in field.added(text, pii.base_spans(text)) if k == 3] == ["001 (425) 555-9684"]
    assert field.added("in 1999 there were 23 of 45", []) == []


def test_posteriors_sum_over_segmentations():
    text, known = "ab 12 cd 3", {}
    lattice = pii.Lattice(text, 0, len(text), known, learn=True)
    scores = np.random.default_rng(0).normal(size=(len(lattice.segments), 4))

    def every(j):
        if j == 0:
            yield 0.0, []
            return
        for v, s in every(j - 1):
            yield v, s
        for k, (i, e) in enumerate(lattice.segments):
            if e == j:
                for v, s in every(i):
                    for kind in range(4):
                        yield v + scores[k, kind], [*s, (k, kind)]
    all_ways = list(every(len(lattice.tokens)))
    total, want = sum(np.exp(v) for v, _ in all_ways), np.zeros_like(scores)
    for v, s in all_ways:
        for k, kind in s:
            want[k, kind] += np.exp(v) / total
    assert np.allclose(lattice.posteriors(scores), want)
    assert max(all_ways)[1] == lattice.best(scores)


# 4

def test_decontamination_hostile(spark):
    item = words(30, 9)
    rows = [*HOSTILE, (50, words(20, 6) + " " + item.upper() + " " + words(20, 7)), (51, words(600, 8) + " " + item), (52, "short item")]
    bench = spark.createDataFrame([(1, item), (2, "Short, item!"), (3, None), (4, "..."), (5, item)], "item_id bigint, text string")
    got = {r.doc_id: r.contamination for r in decontaminate.contamination(documents(spark, True, rows), bench).collect()}
    assert len(got[50].hit_words) == 30 and sorted(got[50].items) == [1, 5] and got[50].n_words == 70
    assert sorted(got[52].items) == [2] and got[4].n_words == 0 and not got[1].hit_words
    kept = {r.doc_id for r in decontaminate.drop_contaminated(documents(spark, rows=rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {50, 52}
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(documents(spark, rows=rows), none).count() == len(rows)
    assert decontaminate.drop_contaminated(documents(spark, rows=[]), bench).count() == 0


# 5

def test_packing_hostile(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [r for r in HOSTILE if r[0] is not None]
    want = {i: [*bpe.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    got = packing.pack_documents(documents(spark, True, rows), queries.ranks_path()).collect()
    held, places = {}, {}
    for r in got:
        ids = list(struct.unpack(f"<{r.length}I", r.ids))
        held.setdefault(r.doc_id, []).append((r.start, ids))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.doc_tokens == len(want[r.doc_id])
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in held.items()} == want
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(documents(spark, rows=[]), queries.ranks_path()).count() == 0


def test_packing_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"hello {end} world", end, end + end, f" {end} ", f"a  {end}\n\n b", f"x{end}y  z {end[:-1]}{end}", f"<|{end}|>", f"it{end}'s  é{end}\t日本 "]
    rows = list(enumerate(texts))
    pieces = packing.pack_documents(documents(spark, rows=rows), queries.ranks_path()).collect()
    held = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        held.setdefault(r.doc_id, []).extend(struct.unpack(f"<{r.length}I", r.ids))
    assert held == {i: [*bpe.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}
    assert held[0] == [31373, 220, 50256, 995, 0]


# 6

def test_suffix_automaton_knows_all_factors():
    rng = random.Random(5)
    for _ in range(30):
        text = [rng.randint(1, 3) for _ in range(rng.randint(1, 25))]
        table = langid.automaton(np.array(text), 4)
        for _ in range(50):
            probe = [rng.randint(1, 3) for _ in range(rng.randint(1, 6))]
            state = 0
            for c in probe:
                state = int(table[state, c])
                if not state:
                    break
            assert bool(state) == any(text[i:i + len(probe)] == probe for i in range(len(text)))


def test_phrases_are_longest_matches():
    sample = words(60, 1)
    model = langid.Model({"x": [sample], "y": [words(60, 2)]}, 300)
    text = langid.fold(words(60, 3))[:langid.LANE]
    cut = langid.fold(sample)[:300]
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in cut:
            n += 1
        at, count = at + n, count + 1
    symbols = model.symbols(text)
    lanes = np.zeros((langid.LANE, 1), np.int32)
    lanes[:len(symbols), 0] = symbols
    assert model.phrases(lanes)[0, 0] == count


def test_langid_hostile(spark):
    rows = [*HOSTILE, (300, "²³ 12"), (301, "日本")]
    docs = documents(spark, True, rows)
    got = {r.doc_id: r for r in langid.predict_language(docs, langid.train(docs)).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {4, 5, 6, 9, 300} and got[1].lang_pred == "en" and got[301].lang_pred == "en"
    none = langid.train(documents(spark, rows=[]))
    assert {r.lang_pred for r in langid.predict_language(docs, none).collect()} == {"und"}


def test_langid_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = entry.queries()["op6_langid"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in told) >= 0.95 * len(told)


# 7

def brute_bytes(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        for s in range(len(t) - 99):
            seen.setdefault(t[s:s + 100], (i, s))
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 99):
            if seen[t[s:s + 100]] != (i, s):
                gone[s:s + 100] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[i] = (len(t), int(gone.sum()), int((edge == 1).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup_hostile(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    passage = words(40, 77)
    rows = [r for r in HOSTILE if r[0] is not None] + [(400 + i, words(10, i) + passage + words(10, i + 900)) for i in range(60)] + [(500, "ab" * 300), (501, "ba" * 200)]
    got = suffix_dedup.dedup_bytes(documents(spark, True, rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == brute_bytes([(i, (t or "").encode()) for i, t in rows])
    assert suffix_dedup.dedup_bytes(documents(spark)).count() == len(HOSTILE) and suffix_dedup.dedup_bytes(documents(spark, rows=[])).count() == 0


def test_run_index_marks_later_starts():
    rng = random.Random(1)
    for _ in range(100):
        length = rng.choice([2, 3, 5, 8])
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 8))]
        gone, _ = suffix_dedup.marked(texts, [np.arange(len(texts)), np.zeros(len(texts), np.int64)], length)
        seen, want = set(), []
        for t in texts:
            for i in range(len(t) + 1):
                whole = len(t) - i >= length
                want.append(whole and t[i:i + length] in seen)
                if whole:
                    seen.add(t[i:i + length])
        assert gone.tolist() == want


# 8

def brute_components(rows):
    sets = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[ \t-\r]+", low) if x]
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_hostile(spark):
    rng = random.Random(2)
    rows = [r for r in HOSTILE if r[0] is not None]
    for i in range(80):
        w = BODY.split()
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9)}"
        rows.append((1000 + i, " ".join(w)))
    got = jaccard.similar_documents(documents(spark, True, rows)).collect()
    assert {r.doc: (r.n, r.component) for r in got} == brute_components(rows)
    assert jaccard.similar_documents(documents(spark, rows=[])).count() == 0
    kept = {r.doc_id for r in jaccard.drop_similar(documents(spark, rows=rows)).collect()}
    assert kept == {c for _, c in brute_components(rows).values()}


def test_outlines_bound_what_sets_share():
    rng = np.random.default_rng(5)
    for _ in range(300):
        pool = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
        x, y = (np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in range(2))
        common = len(np.intersect1d(x, y))
        bound = jaccard.most_common(jaccard.outline(x), jaccard.outline(y), len(x), len(y))
        assert common <= bound <= min(len(x), len(y))
    apart = [np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64)) for _ in range(2)]
    assert jaccard.most_common(*map(jaccard.outline, apart), 1000, 1000) < 600
    assert jaccard.most_common(jaccard.outline(x), jaccard.outline(x), len(x), len(x)) == len(x)


# 9

def test_warc_hostile(spark):
    rows = [(1, "u", "<p>é"), (2, None, "<p>é"), (3, "v", None), (4, "w", ""), (5, "x\r\ny: z", "a\r\n\r\nWARC/1.1\r\n" * 50), (6, "y", "q" * 300_000)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), 6: ("response", None)}
    assert all(got[i].payload_bytes == len((h or "").encode()) for i, _, h in rows)
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# 10

def test_gradients_match_differences():
    model = toxicity.Model.fresh({"a": 1, "b": 2})
    x = np.random.default_rng(1).normal(size=(5, 2 * toxicity.WIDTH)).astype(np.float32)
    ids, labels = np.array([[0, 1, 2], [3, 4, 0]]), np.array([1.0, 0.0], np.float32)

    def loss():
        logits = model.run(model.project(x), ids).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(logits)) - labels * logits))
    grad, _ = model.gradients(x, ids, labels, np.ones(2, np.float32))
    for name in ("att", "in_f", "state_b", "out"):
        at = tuple(0 for _ in model.weights[name].shape)
        old = model.weights[name][at]
        model.weights[name][at] = old + 1e-2
        up = loss()
        model.weights[name][at] = old - 1e-2
        down = loss()
        model.weights[name][at] = old
        assert abs((up - down) / 2e-2 - grad[name][at]) < 2e-3, name


def test_windows_cover_all_words():
    for n in range(1, 200):
        starts = toxicity.window_starts(n)
        assert {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def test_toxicity_hostile(spark):
    rng = random.Random(3)
    rows = [*HOSTILE, *[(1000 + i, words(rng.randint(5, 60), i) + (" you vile idiot " if i % 4 == 0 else " ") + words(5, i + 999)) for i in range(400)]]
    labels = spark.createDataFrame([(i, int("idiot" in (t or "")) if i >= 1000 else 0) for i, t in rows if i] + [(1, None), (2, 7), (None, 1)], "doc_id bigint, toxic int")
    docs = documents(spark, True, rows)
    model = toxicity.train(docs, labels)
    got = {r.doc_id: float(r.score) for r in toxicity.score_toxicity(docs, model).collect()}
    held = [(i, t) for i, t in rows if i and i >= 1000 and zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= 0.7) == ("idiot" in t) for i, t in held) >= 0.9 * len(held) and all(0 <= s <= 1 for s in got.values())
    assert toxicity.score_toxicity(documents(spark, rows=[]), model).count() == 0
    none = toxicity.train(documents(spark, rows=[]), labels)
    assert toxicity.score_toxicity(documents(spark), none).count() == len(HOSTILE)


# the pipeline

def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.cut_lineage(stage(spark, docs, SF), name)
        if k < 4:
            assert out.columns == columns and out.dtypes == docs.dtypes and 0 < out.count() <= before
            if name == "line_dedup":
                want = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
                assert {r.doc_id: r.text or "" for r in out.collect()} == {i: t for i, (_, t) in want.items()}
            if name == "jaccard_join":
                want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
                assert {r.doc_id for r in out.collect()} == {c for _, c in want.values()}
            before, docs = out.count(), out
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
