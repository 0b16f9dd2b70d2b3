"""Rules on small fixtures: golden temperatures, spacing traces, brute-force comparisons."""

import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import inputs
from strandforge.functions import sequence as sq, thermo
from strandforge.operators import barcodes, filters, isoforms, offtarget, panels, ranking, variants, windows
from strandforge.operators.spacing import BUCKET, _Bits, selected_arrays, spaced_array, spaced_selection
from strandforge.plans.design import brute_force_sites, screened_sites
from strandforge.session import scratch_path
from strandforge.sources import alignments, fasta, genes

# published demo probes: probe, G content as printed, Tm of the rotated probe and of both arms
GOLDEN = [
    ("GGGTACTTCAGGGTCAGGATACCTCTCTTGCTCTGGGCCT", "0.30", 71.938908, 56.212959, 56.899136),
    ("GCCACACGCAGCTCATTGTAGAAGGTGTGGTGCCAGATCT", "0.30", 69.193924, 51.573170, 55.480791),
    ("AGCACAGGGTGCTCCTCAGGGGCCACACGCAGCTCATTGT", "0.30", 73.899303, 62.661977, 55.756453),
    ("AGCTGGCCAAAGAGAAGGGTTACCCGGGATACTGACCTGG", "0.35", 77.943755, 62.730855, 60.511062),
    ("GCCTGTGGTACGACCAGAGGCATACAGGGACAGCACAGCC", "0.33", 76.296854, 60.445315, 60.942867),
    ("GGGCGCGCGCCCAAGCTCAGGGGACAAAGGAAGCGCAGAC", "0.40", 79.984075, 66.530283, 64.181487),
    ("ATCCTCCTCTTAGGAGTGGGGGTGGCTTTTGGGAGGGTGA", "0.42", 70.027333, 53.385485, 58.217493),
    ("GGGTGGCTTTTGGGAGGGTGAGGGACTTCCTGTAACCACT", "0.40", 72.130998, 60.236678, 53.853247),
]


def tm(seq):
    h = 1.9 - sum(thermo.DNA_RNA[seq[i:i + 2]][0] for i in range(len(seq) - 1)) / 10
    s = -3.9 - sum(thermo.DNA_RNA[seq[i:i + 2]][1] for i in range(len(seq) - 1)) / 10
    s += 0.368 * (len(seq) - 1) * math.log(0.05)
    return 1000 * h / (s + 1.987 * math.log(12.5e-9)) - 273.15


def revcomp(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def dna(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def test_golden_temperatures(spark):
    df = spark.createDataFrame(GOLDEN, "probe STRING, g STRING, full DOUBLE, t3 DOUBLE, t5 DOUBLE")
    a3, a5, full = sq.arms("probe", 40)
    got = df.select("*", thermo.tm_nn(full).alias("x"), thermo.tm_nn(a3).alias("x3"), thermo.tm_nn(a5).alias("x5"),
                    sq.fixed_point(sq.g_content("probe"), 2, 60).alias("gx")).collect()
    for r in got:
        assert (r.x, r.x3, r.x5) == pytest.approx((r.full, r.t3, r.t5), abs=1e-6)
        assert r.gx == r.g


def test_golden_probes_from_windows(spark):
    """The same numbers from the rolling sums, and the limits accept them (two hold GGGG across the middle)."""
    df = spark.createDataFrame([(i, revcomp(g[0])) for i, g in enumerate(GOLDEN)], "i INT, seq STRING")
    w = windows.windows_between(df, ["i"], F.lit(0), F.lit(1)).orderBy("i").collect()
    for r, g in zip(w, GOLDEN):
        assert (r.tm, r.tm_3, r.tm_5) == pytest.approx(g[2:], abs=1e-6)
    kept = filters.passing(windows.windows_between(df, ["i"], F.lit(0), F.lit(1)), filters.DEMO).count()
    assert kept == len(GOLDEN)


def test_windows_equal_direct_sums_across_pieces(spark, monkeypatch):
    rng = random.Random(5)
    seqs = [(i, dna(rng, n, "ACGTN" if i % 2 else "ACGT")) for i, n in enumerate([39, 40, 41, 400, 1003])]
    df = spark.createDataFrame(seqs, "i INT, seq STRING")
    monkeypatch.setattr(windows.cut_pieces, "__defaults__", (100,))
    for length in (40, 21):
        got = {(r.i, r.pos): r for r in windows.windows_between(df, ["i"], F.lit(0), F.col("seq_len") - length + 1, length).collect()}
        assert len(got) == sum(max(0, len(s) - length + 1) for _, s in seqs)
        for i, s in seqs:
            for p in range(len(s) - length + 1):
                t, r = s[p:p + length], got[i, p]
                assert r.target == t
                if "N" in t:
                    assert r.tm is None
                    continue
                probe = revcomp(t)
                a3, a5 = probe[:length // 2], probe[length // 2:]
                assert (r.tm, r.tm_3, r.tm_5) == pytest.approx((tm(a5 + a3), tm(a3), tm(a5)), abs=1e-9)
                assert r.g_content == pytest.approx(probe.count("G") / length)


def plain_spacing(p, n, min_gap=1, keep_all=False):
    if not p or (len(p) <= n and not keep_all):
        return p
    lo, hi, best = 0, p[-1] - p[0], None

    def picks(gap):
        out = [p[0]]
        for x in p[1:]:
            if x - out[-1] >= gap:
                out.append(x)
        return out
    while lo <= hi:
        mid = (lo + hi) // 2
        if len(picks(mid)) >= n and mid > min_gap:
            best, lo = picks(mid), mid + 1
        else:
            hi = mid - 1
    if best is None:
        return p if keep_all else p[:n]
    return best if keep_all else best[:n]


@pytest.mark.parametrize("keep_all,min_gap", [(False, 1), (True, 3)])
def test_spacing_follows_the_search(spark, keep_all, min_gap):
    rng = random.Random(1)
    cases = [[0, 1, 2, 4, 6, 8], [7], list(range(50))]
    cases += [sorted(rng.sample(range(rng.choice([12, 60, 5000])), rng.randint(1, 12))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(cases)), "i INT, p ARRAY<BIGINT>")
    for r in df.withColumn("x", spaced_array(F.col("p"), 4, min_gap, keep_all)).collect():
        assert r.x == plain_spacing(r.p, 4, min_gap, keep_all), r.p
    if not keep_all:
        assert plain_spacing([0, 1, 2, 4, 6, 8], 4) == [0, 1, 2, 4]


@pytest.mark.parametrize("keep_all,min_gap,n", [(False, 1, 4), (True, 3, 4), (False, 40, 30), (True, 1, 1)])
def test_spacing_on_bitmaps_follows_the_search(spark, keep_all, min_gap, n):
    rng = random.Random(2)
    cases = [[0], [-40_000, -1, 0, 1, 32_768, 32_769, 70_000], list(range(-20, 40)), [5, 5_000_000_000]]
    cases += [sorted(rng.sample(range(rng.choice([0, -90_000]), rng.choice([12, 60, 5000, 200_000])), rng.randint(1, 12))) for _ in range(100)]
    cases += [sorted(rng.sample(range(100_000), 3000))]
    rows = [(f"g{i}", p) for i, ps in enumerate(cases) for p in ps + ps[:2]] + [("none", None)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "gene STRING, pos BIGINT")
    got = {r.gene: r.picks for r in selected_arrays(df, "gene", "pos", n, min_gap, keep_all).collect()}
    want = {f"g{i}": plain_spacing(p, n, min_gap, keep_all) if keep_all or len(p) > n else p for i, p in enumerate(cases)}
    assert got == want
    assert spaced_selection(df, "gene", "pos", n, min_gap, keep_all).count() == sum(
        sum(q in want[g] for q in [p]) for g, p in rows if p is not None)


def test_ten_million_positions_of_one_gene(spark):
    df = spark.range(0, 40_000_000, 4).select(F.lit("g").alias("gene"), (F.col("id") + F.col("id") % 3).alias("pos"))
    picks = selected_arrays(df, "gene", "pos", 100).first().picks
    assert len(picks) == 100 and min(b - a for a, b in zip(picks, picks[1:])) >= 404_030
    p = np.arange(4, 40_000_000, 4)
    p += p % 3
    numbers = np.unique((p - 1) // BUCKET + 1)
    bits = np.zeros((len(numbers), BUCKET), np.uint8)
    bits[np.searchsorted(numbers, (p - 1) // BUCKET + 1), (p - 1) % BUCKET] = 1
    held = _Bits(numbers.tolist(), [m.tobytes() for m in np.packbits(bits, axis=1, bitorder="little")])
    assert held.size == len(p) and sum(map(len, held.bitmaps)) < 6_000_000
    tracemalloc.start()
    held.spaced(100, 1, False)
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_brute_force_has_at_most_the_cap_and_genomic_places(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([("A", dna(rng, 3000, "ACGTGC"), 1000, 4000, 1), ("B", dna(rng, 2000, "ACGTGC"), 500, 2500, -1)],
                               "gene STRING, seq STRING, start BIGINT, end BIGINT, strand INT")
    t = filters.DEMO.but(max_sites=7)
    rows = brute_force_sites(df, t).collect()
    for r in rows:
        want = 1000 + r.position if r.gene == "A" else 2500 - r.position - 40
        assert (r.genomic_start, r.genomic_end) == (want, want + 40)
    assert {g: sum(r.gene == g for r in rows) for g in "AB"} == {"A": 7, "B": 7}


def test_rank_of_a_key_that_holds_most_rows(spark):
    rows = [("hot" if i % 3 else f"k{i % 11}", i * 7 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "k STRING, x BIGINT")
    got = {(r.k, r.x): (r.n, r.n_of) for r in ranking.ranked(df, ["k"], F.floor(F.col("x") / 64), ["x"], "n").collect()}
    for k in {r[0] for r in rows}:
        xs = sorted(x for kk, x in rows if kk == k)
        assert [got[k, x] for x in xs] == [(i + 1, len(xs)) for i in range(len(xs))]


def test_diverse_codes_equal_the_plain_scan_over_many_rounds(spark):
    rng = random.Random(2)
    rows = [(i, dna(rng, 20)) for i in range(1200)]
    kept = []
    for i, c in rows:
        if "GGGGG" not in c and all(sum(a != b for a, b in zip(c, k)) >= 10 for _, k in kept):
            kept.append((i, c))
    df = spark.createDataFrame(rows, "code_no BIGINT, code STRING")
    got = sorted((r.code_no, r.code) for r in barcodes.diverse_codes(df, batch=150).collect())
    assert got == kept


def test_hamming_pairs_equal_all_pairs(spark):
    rng = random.Random(4)
    base = [dna(rng, 20) for _ in range(30)]
    codes = base + ["".join(c if rng.random() > .2 else rng.choice("ACGT") for c in b) for b in base for _ in range(3)]
    df = spark.createDataFrame([(c,) for c in codes], "code STRING")
    u = sorted(set(codes))
    for d in (3, 6):
        want = {(a, b) for a in u for b in u if a < b and sum(x != y for x, y in zip(a, b)) < d}
        got = [(r.code_a, r.code_b) for r in barcodes.hamming_pairs(df, d).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_offtarget_hits_equal_a_full_scan(spark, monkeypatch):
    rng = random.Random(6)
    a = dna(rng, 300)
    b = dna(rng, 50) + a[100:180] + dna(rng, 50) + revcomp(a[20:90]) + "N" + a[:45]
    b = b[:70] + ("A" if b[70] != "A" else "C") + b[71:]
    refs = {"a": a, "b": b, "c": a[5:44]}
    targets = sorted({a[p:p + 40] for p in range(0, 260, 7)})
    monkeypatch.setattr(windows.cut_pieces, "__defaults__", (64,))
    got = {tuple(r) for r in offtarget.offtarget_hits(
        spark.createDataFrame([(t,) for t in targets], "target STRING"),
        spark.createDataFrame(list(refs.items()), "ref STRING, seq STRING"), "ref").select("target", "ref", "pos", "frame", "mismatches").collect()}
    want = set()
    for name, s in refs.items():
        for p in range(len(s) - 39):
            for t in targets:
                for frame, x in ((-1, t), (1, revcomp(t))):
                    off = sum(u != v for u, v in zip(x, s[p:p + 40]))
                    if off <= 1 and "N" not in s[p:p + 40]:
                        want.add((t, name, p, frame, off))
    assert got == want


@pytest.mark.parametrize("mismatches, lengths", [(0, (3, 40, 70)), (1, (40, 50, 25, 33)), (2, (40, 9, 100)), (3, (50,))])
def test_offtarget_hits_of_any_length(spark, monkeypatch, mismatches, lengths):
    rng = random.Random(7)
    a = dna(rng, 220)
    b = dna(rng, 20) + a[60:170] + revcomp(a[20:90]) + "N" + a[:105]
    b = "".join(rng.choice("ACGT") if c != "N" and rng.random() < .03 else c for c in b)
    refs = [("a", a), ("b", b), ("b", a[5:64]), ("c", "AC"), ("d", "A" * 45)]
    targets = sorted({x[p:p + n] for n in lengths for x in (a, "A" * 120) for p in range(0, len(x) - n, 17)} | {dna(rng, lengths[0])})
    monkeypatch.setattr(windows.cut_pieces, "__defaults__", (64,))
    got = [tuple(r) for r in offtarget.offtarget_hits(
        spark.createDataFrame([(t,) for t in targets + targets[:2]], "target STRING"),
        spark.createDataFrame(refs, "ref STRING, seq STRING"), "ref", mismatches).collect()]
    want = []
    for name, s in refs:
        for t in targets:
            for p in range(len(s) - len(t) + 1):
                for frame, x in ((-1, t), (1, revcomp(t))):
                    off = sum(u != v for u, v in zip(x, s[p:p + len(t)]))
                    if off <= mismatches and "N" not in s[p:p + len(t)]:
                        want.append((t, name, p, frame, off, (len(t) - off) / len(t), len(t) - 4.0 * off))
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("mismatches, length", [(0, 40), (1, 32), (1, 40), (2, 50)])
def test_only_windows_that_share_a_seed_leave_the_kernel(spark, mismatches, length):
    rng = random.Random(13)
    text = dna(rng, 400_000)
    targets = [text[p:p + length] for p in range(0, 399_000, 500)] + [dna(rng, length) for _ in range(800)]
    slots = offtarget._slots([length], mismatches)
    seeds = [(s, t[e[p]:e[p + 1]]) for t in targets for s, (_, p, e) in enumerate(slots)]
    code = str.maketrans("ACGT", "0123")
    held = offtarget.seed_filter(spark.createDataFrame([(s, int(x.translate(code), 4)) for s, x in seeds], "slot INT, seed BIGINT"), len(seeds))
    known = set(seeds)
    true = sum((s, x[p + e[q]:p + e[q + 1]]) in known for x in (text, revcomp(text)) for p in range(len(text) - length + 1)
               for s, (_, q, e) in enumerate(slots))
    pieces = windows.cut_pieces(spark.createDataFrame([("a", text)], "ref STRING, seq STRING"), "seq", length - 1)
    rests = len(slots[0][2]) - 2
    left = pieces.select("ref", "piece_start", "piece_size", "piece").mapInArrow(
        offtarget._candidates(slots, "ref", spark.sparkContext.broadcast(held)),
        "ref STRING, pos BIGINT, frame INT, slot INT, seed BIGINT" + "".join(f", r{i} BIGINT" for i in range(rests))).count()
    assert 798 * len(slots) <= true <= left <= 2 * true


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(offtarget, "MOST_WORDS", 5)
    test_offtarget_hits_of_any_length(spark, monkeypatch, 1, (40, 50, 25, 33))


def test_sites_of_another_length_are_screened_and_others_rejected(spark):
    rng = random.Random(10)
    a = dna(rng, 900)
    texts = {"A": a, "B": dna(rng, 500) + "N" + a[150:700] + dna(rng, 100)}
    seqs = spark.createDataFrame(list(texts.items()), "gene STRING, seq STRING")

    def bound(target, seq):
        return any(sum(u != v for u, v in zip(x, seq[p:p + len(x)])) <= 1
                   for x in (target, revcomp(target)) for p in range(len(seq) - len(target) + 1))

    for t in (filters.DEMO.but(length=50), filters.DEMO):
        sites = {(r.gene, r.target) for r in brute_force_sites(seqs, t).collect()}
        want = {(g, x) for g, x in sites if not bound(x, texts["B" if g == "A" else "A"])}
        assert {(r.gene, r.target) for r in screened_sites(seqs, t, seqs).collect()} == want and set() < want < sites
    asked = spark.createDataFrame([("A", a[:30]), ("A", "N" + a[:39]), ("A", None), ("A", "A")], "gene STRING, target STRING")
    kept, rejects = offtarget.specific_by_search(asked, seqs)
    assert [r.target for r in kept.collect()] == [a[:30]]
    assert {(r.target, r.reason) for r in rejects.collect()} == {("N" + a[:39], "letters"), (None, "null"), ("A", "length")}
    with pytest.raises(ValueError):
        screened_sites(seqs, filters.DEMO, seqs, 40)


def test_variants_lie_along_whole_texts(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: len(r.seq) for r in inputs.transcripts(spark, sf).collect() if r.seq}
    places = {}
    for r in inputs.variants_along(spark, sf).drop("seq").collect():
        assert r.ref and r.alt and 1 <= r.v_start <= r.v_end <= texts[r.doc_id // 1000000]
        places.setdefault(r.doc_id // 1000000, []).append(r.v_start)
    assert places.keys() == texts.keys() and min(texts.values()) < 400
    for doc, starts in places.items():
        starts.sort()
        assert starts[0] == 1 and starts[-1] == texts[doc] and all(0 < b - a <= inputs.ALONG for a, b in zip(starts, starts[1:]))


def test_random_draws_are_repeatable_and_sound(spark):
    df = spark.createDataFrame([(1, "ACGT" * 100), (2, "ACGTA" * 10)], "i INT, seq STRING")
    a = sorted(map(tuple, windows.windows_random(df, ["i"], 40, 5, 9).collect()))
    assert a == sorted(map(tuple, windows.windows_random(df.repartition(7), ["i"], 40, 5, 9).collect()))
    assert [x[0] for x in a] == [1] * 5 and len({x[1] for x in a}) == 5
    assert all(t == ("ACGT" * 100)[p:p + 40] for _, p, t in a)
    codes = [r.code for r in barcodes.random_codes(spark, 200, 20, 3).collect()]
    assert all(len(c) == 20 and set(c) <= set("ACGT") for c in codes) and len(set(codes)) > 190


def test_spliced_windows_follow_the_transcript(spark):
    rng = random.Random(8)
    seq = dna(rng, 400)
    ex = [("g", "t1", 11, 61, 1), ("g", "t1", 101, 181, 1), ("g", "t2", 11, 61, -1), ("g", "t2", 101, 131, -1), ("g", "t2", 201, 260, -1)]
    exons = spark.createDataFrame(ex, "gene STRING, tx_id STRING, exon_start BIGINT, exon_end BIGINT, strand INT")
    loci = spark.createDataFrame([("g", seq)], "gene STRING, seq STRING")
    rows = isoforms.spliced_windows(loci, exons, 40, 10).collect()
    bases = {t: [p for _, u, s, e, _ in sorted(ex) if u == t for p in range(s, e)] for t in ("t1", "t2")}
    assert {(r.tx_id, r.off) for r in rows} == {(t, o) for t, b in bases.items() for o in range(1, len(b) - 40)}
    for r in rows:
        b = bases[r.tx_id]
        assert (r.start, r.end) == (b[r.off], b[r.off + 40])
        text = "".join(seq[p - 1] for p in b[r.off:r.off + 40])
        assert r.target == (text if r.tx_id == "t1" else revcomp(text))
        near = b[r.off + 10:r.off + 31]
        holds = [t for t in ("t1", "t2") if any(bases[t][i:i + len(near)] == near for i in range(len(bases[t])))]
        assert r.tx_id in r.target_isoforms and set(holds) >= set(r.target_isoforms)


@pytest.mark.parametrize("digits,bits", [(2, 60), (1, 50)])
def test_fixed_point_rounds_like_printf(spark, digits, bits):
    rng = random.Random(7)
    xs = [k / 40 for k in range(41)] + [0.875, 0.125] if digits == 2 else [rng.uniform(8, 120) for _ in range(300)] + [72.25, 50.05]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE").select("x", sq.fixed_point("x", digits, bits).alias("s"))
    assert all(r.s == f"{r.x:.{digits}f}" for r in df.collect())


def test_fasta_and_gene_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c1 first > record\r\nACGT\r\nAC\r\n>c2\nGGG\n\n>empty\n")
    got = {r.name: (r.header, r.seq) for r in fasta.scan_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"c1": ("c1 first > record", "ACGTAC"), "c2": ("c2", "GGG"), "empty": ("empty", "")}
    (tmp_path / "g.txt").write_text("Actb\n\n 0 \nnan\n Tuba1a \nActb\n")
    assert [r.gene_name for r in genes.read_gene_table(spark, str(tmp_path / "g.txt")).orderBy("row_no").collect()] == ["Actb", "Tuba1a", "Actb"]
    with pytest.raises(ValueError):
        (tmp_path / "g.csv").write_text("name\nx\n")
        genes.read_gene_table(spark, str(tmp_path / "g.csv"))


def test_alignment_documents(spark, tmp_path):
    hsp = "<Hsp><Hsp_num>{n}</Hsp_num><Hsp_score>{s}</Hsp_score><Hsp_evalue>0.5</Hsp_evalue><Hsp_query-frame>1</Hsp_query-frame><Hsp_hit-frame>-1</Hsp_hit-frame><Hsp_identity>19</Hsp_identity><Hsp_align-len>20</Hsp_align-len></Hsp>"
    one = ("<?xml version=\"1.0\"?>\n<BlastOutput><BlastOutput_iterations><Iteration><Iteration_query-def>Actb_1|pos=3</Iteration_query-def><Iteration_hits>"
           "<Hit><Hit_num>1</Hit_num><Hit_id>x</Hit_id><Hit_def>mouse Actb</Hit_def><Hit_hsps>" + hsp.format(n=1, s=20) + hsp.format(n=2, s=11)
           + "</Hit_hsps></Hit><Hit><Hit_num>2</Hit_num><Hit_id>y</Hit_id><Hit_def>human</Hit_def><Hit_hsps>" + hsp.format(n=1, s=18)
           + "</Hit_hsps></Hit></Iteration_hits></Iteration><Iteration><Iteration_query-def>Actb_2</Iteration_query-def><Iteration_hits></Iteration_hits></Iteration>"
           "</BlastOutput_iterations></BlastOutput>")
    (tmp_path / "b1.xml").write_text(one)
    (tmp_path / "b2.xml").write_text('<?xml version="1.0"?>\n<BlastOutput>\n</BlastOutput>')
    rows = alignments.scan_alignments(spark, str(tmp_path)).collect()
    assert sorted((r.query_id, r.hit_rank or 0, r.hsp_no or 0, r.score) for r in rows if r.score) == [
        ("Actb_1", 1, 1, 20.0), ("Actb_1", 1, 2, 11.0), ("Actb_1", 2, 1, 18.0)]
    assert [r.query_id for r in rows if r.score is None] == ["Actb_2"]
    assert {r.identity for r in rows if r.score} == {0.95}


def test_scratch_follows_the_named_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("name", sorted(thermo.TABLES))
def test_windows_melt_as_their_strings(spark, name):
    """Window sums give the temperatures of the rotated probe and both arms, end terms included."""
    table, seq = thermo.TABLES[name], "".join(random.Random(7).choice("ACGT") for _ in range(300))
    pieces = spark.createDataFrame([("g", seq, 0, 260)], "gene STRING, piece STRING, win_from BIGINT, win_to BIGINT")
    for strand in (True, False):
        w = windows.with_metrics(windows.rolling_windows(pieces, ["gene"], 40, strand, table), 40, strand, table)
        front, back = F.left("target", F.lit(20)), F.right("target", F.lit(20))
        read = sq.revcomp if strand else (lambda s: s)
        whole = F.concat(back, front) if strand else F.col("target")
        rows = w.select("tm", "tm_5", "tm_3", thermo.tm_nn(read(whole), table).alias("x"), thermo.tm_nn(read(front), table).alias("x5"),
                        thermo.tm_nn(read(back), table).alias("x3")).collect()
        assert len(rows) == 260
        for r in rows:
            assert (r.tm, r.tm_5, r.tm_3) == pytest.approx((r.x, r.x5, r.x3), abs=1e-9)


def test_codes_of_any_length_and_letters(spark):
    draw = random.Random(3)
    for length, letters in ((25, "ACGT"), (40, "ACGT"), (20, "ACGTN")):
        codes = ["".join(draw.choice(letters) for _ in range(length)) for _ in range(20)]
        codes += ["".join(draw.choice(letters) if draw.random() < .2 else c for c in x) for x in codes]
        df = spark.createDataFrame(list(enumerate(codes)), "code_no BIGINT, code STRING")
        apart = lambda a, b: sum(x != y for x, y in zip(a, b))
        want = sorted((a, b, apart(a, b)) for a in set(codes) for b in set(codes) if a < b and apart(a, b) < 6)
        assert sorted(tuple(r) for r in barcodes.hamming_pairs(df, 6, length).collect()) == want
        kept = []
        for n, c in enumerate(codes):
            if "GGGGG" not in c and c not in codes[:n] and all(apart(c, k) >= 8 for k in kept):
                kept.append(c)
        for batch in (7, 2000):
            assert [r.code for r in barcodes.diverse_codes(df, 8, batch).orderBy("code_no").collect()] == kept


def test_nothing_vanishes_without_a_word(spark):
    stem = "ACGTTGCATCAGGATTCACCGATAGC"
    fold = stem + "AAAA" + stem[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert spark.createDataFrame([(fold,)], "s STRING").select(sq.longest_stem("s").alias("n")).first().n == 26
    sites = spark.createDataFrame([(f"G{i}", 1, "A" * 40) for i in range(5)] + [("G0", 2, "A" * 39)], "gene STRING, pos BIGINT, binding STRING")
    listed = spark.createDataFrame([(f"G{i}", i) for i in range(5)], "gene STRING, gene_order BIGINT")
    two = spark.createDataFrame([(0, "CC"), (1, "GG")], "idx BIGINT, barcode STRING")
    probes, rejects = panels.multi_site_panel(sites, listed, two)
    assert probes.count() == 2
    assert sorted((r.gene, r.reason) for r in rejects.collect()) == [("G0", "length"), *[(f"G{i}", "no barcode") for i in (2, 3, 4)]]
    asked = spark.createDataFrame([("A" * 40,), ("A" * 30,), ("N" + "A" * 39,), (None,)], "target STRING")
    assert {r.reason for r in offtarget.unsearchable(asked).collect()} == {"length", "letters", "null"}
    with pytest.raises(ValueError):
        isoforms.search_all(None, None, None, None, "exon_skipping")


def test_short_libraries_and_sequences_are_listed(spark):
    codes = spark.createDataFrame([(lib, i, "ACGT") for lib, n in (("full", 21), ("more", 30), ("short", 20)) for i in range(n)], "lib STRING, code_no BIGINT, code STRING")
    assert {r.lib for r in barcodes.seq_lib(codes).collect()} == {"full", "more"}
    assert [tuple(r) for r in barcodes.seq_lib_rejects(codes).collect()] == [("short", 20, "too few codes")]
    seqs = spark.createDataFrame([(1, "A" * 200), (2, "A" * 199), (3, ""), (4, None)], "i INT, seq STRING")
    assert {r.i for r in windows.windows_random(seqs, ["i"], 40, 5, 9).collect()} == {1}
    assert {tuple(r) for r in windows.random_rejects(seqs, ["i"], 40, 5).collect()} == {(2, "too short"), (3, "too short"), (4, "null")}


def test_search_all_knows_exon_junction(spark):
    texts = {g: dna(random.Random(g), 700) for g in ("A", "B")} | {"C": "ACGT" * 5}
    loci = spark.createDataFrame(list(texts.items()), "gene STRING, seq STRING")
    t = filters.DEMO.but(max_sites=12)
    every = windows.windows_between(loci, ["gene"], F.lit(0), F.col("seq_len") - 39, 40)
    good = {(r.gene, r.pos) for r in filters.passing(every, t).select("gene", "pos").collect()}
    want = set()
    for g, seq in texts.items():
        tried = [p for c in (len(seq) // 3, 2 * len(seq) // 3) for p in range(max(0, c - 100), min(len(seq) - 40, c + 100), 5)]
        want |= {(g, p, revcomp(seq[p:p + 40]), "exon_junction") for p in [p for p in tried if (g, p) in good][:12]}
    got = isoforms.search_all(loci, None, None, t, "exon_junction").select("gene", "position", "sequence", "strategy").collect()
    assert len(got) == len(want) > 12 and {tuple(r) for r in got} == want


@pytest.mark.parametrize("start", [5, 30, 200])
def test_variant_places_at_region_starts(spark, start):
    seq = "".join(random.Random(9).choice("ACGT") for _ in range(400))
    v = spark.createDataFrame([(seq, start, start)], "seq STRING, v_start BIGINT, v_end BIGINT")
    r = variants.with_local(v).first()
    assert seq[r.g_start - 1:r.g_start - 1 + len(r.local)] == r.local and r.local[r.l_start] == seq[start - 1]


@pytest.mark.parametrize("piece, longest", [(16_384, 512), (120, 4), (300, 40)])
def test_variants_meet_only_pieces_of_their_regions(spark, monkeypatch, piece, longest):
    monkeypatch.setattr(variants, "PIECE", piece)
    monkeypatch.setattr(variants, "LONGEST", longest)
    rng = random.Random(21)
    texts = {"a": dna(rng, 5000), "b": dna(rng, 90), "c": "", "d": dna(rng, 1)}
    rows = [(n, g, p, p + rng.choice([0, 0, 1, 2, 30, 700])) for n, (g, p) in enumerate(
        (g, p) for g, s in texts.items() for p in sorted({1, 2, 49, 50, 51, 52, len(s) - 1, len(s), len(s) + 3, *rng.choices(range(1, len(s) + 2), k=60)}) if p > 0)]
    rows.append((len(rows), "nowhere", 5, 5))
    places = spark.createDataFrame([(n, g, s, e, texts.get(g, "")[s - 1:e] or "A", "T", rng.choice([1, -1])) for n, g, s, e in rows],
                                   "n INT, gene STRING, v_start BIGINT, v_end BIGINT, ref STRING, alt STRING, strand INT")
    regions = spark.createDataFrame(list(texts.items()), "gene STRING, seq STRING")
    carried = places.join(regions, "gene", "left")
    for form in (variants.with_local, variants.flanked):
        got = form(places, regions=regions)
        assert "seq" not in got.columns
        want = form(carried).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got = variants.junctions(places.filter("v_end - v_start < 40"), regions=regions)
    assert sorted(map(str, got.collect())) == sorted(map(str, variants.junctions(carried.filter("v_end - v_start < 40")).select(got.columns).collect()))
