"""Kernels against plain loops, and plans that no longer move what they need not."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from strandforge.functions import probes, sequence as sq, thermo
from strandforge.operators import filters, isoforms, variants, windows

from .test_core import dna, revcomp, tm


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(31)
    return [None, "", "A", "ACGT", "acgt", "ACGTNACGT", "é" * 20, "ACGTÄACGTACGTÄACGT", "ACG" * 30, *[dna(rng, rng.randrange(1, 90), "ACG") for _ in range(200)],
            *[(s := dna(rng, 12)) + dna(rng, rng.randrange(0, 9)) + (s if rng.random() < .5 else revcomp(s)) for _ in range(200)]]


def test_letter_kernels_equal_plain_loops(spark, texts):
    pairs = list(zip(texts, texts[7:] + texts[:7])) + [(s[:30], s[20:]) for s in texts[-100:]]
    df = spark.createDataFrame(pairs, "a STRING, b STRING").select(
        "a", "b", sq.suffix_prefix_overlap("a", "b").alias("over"), sq.has_long_repeat("a").alias("long"), sq.longest_stem("a").alias("stem"),
        thermo.tm_nn("a").alias("tm"), F.concat_ws("", probes.invalid_letters("a")).alias("bad"))
    rows = df.collect()
    assert any(r.over > 5 for r in rows) and any(r.long for r in rows) and any(r.stem > 9 for r in rows)
    for r in rows:
        a, b = r.a or "", r.b or ""
        assert r.over == max((i for i in range(1, min(len(a), len(b)) + 1) if a[-i:] == b[:i]), default=0)
        assert r.long == (None if r.a is None else any(a.find(a[i:i + 8], i + 8) >= 0 for i in range(len(a) - 7)))
        assert r.stem == max((k for k in range(3, len(a) // 2 + 1) if any(
            a.find(revcomp(a[i:i + k]), i + k + 3) >= 0 for i in range(len(a) - k + 1))), default=0)
        assert r.bad == "".join(sorted(set(a.upper()) - set("ATCGN")))
        assert (r.tm is None) == (len(a) < 2 or bool(set(a) - set("ACGT"))) and (r.tm is None or r.tm == pytest.approx(tm(a), abs=1e-9))


def test_rounding_equals_the_decimal_way(spark):
    rng = random.Random(32)
    xs = [0.0, -0.0, 1e-9, -1e-9, 0.125, 0.0000005, 2.5e-6, 1.0000005, 62.1234565, 1e12 + .5, float("inf"), float("nan"), None, *[rng.uniform(-90, 90) for _ in range(5000)],
          *[rng.randrange(10 ** 9) / 10 ** 7 for _ in range(5000)]]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE")
    assert [str(r[0]) for r in df.select(sq.rounded("x", 6)).collect()] == [str(r[0]) for r in df.select(F.round("x", 6)).collect()]


def test_kernel_keeps_all_windows_within_limits(spark):
    rng = random.Random(33)
    df = spark.createDataFrame([(i, dna(rng, rng.randrange(0, 3000)) + "N" + dna(rng, 200)) for i in range(20)], "i INT, seq STRING")
    some, every = (windows.windows_bruteforce(df, ["i"], limits=t) for t in (filters.DEMO, None))
    want = sorted(map(str, filters.passing(every, filters.DEMO).collect()))
    assert sorted(map(str, filters.passing(some, filters.DEMO).collect())) == want and 0 < len(want) <= some.count() < every.count() / 2
    bare = windows.windows_bruteforce(df, ["i"], target=False)
    assert sorted(map(str, bare.collect())) == sorted(map(str, every.select(bare.columns).collect()))


def test_failed_checks_without_lambdas(spark):
    rng = random.Random(34)
    df = spark.createDataFrame([(1, dna(rng, 2000) + "N" + dna(rng, 100))], "i INT, seq STRING")
    got = filters.with_failed_checks(windows.windows_bruteforce(df, ["i"]), filters.DEMO)
    report = filters.target_strand_report(windows.windows_bruteforce(df, ["i"], probe_strand=False))
    assert "isnotnull(lambda" not in plan(got) and "map_filter" not in plan(report)
    assert any("tm_range" in r.failed_checks for r in got.collect())
    for r in report.collect():
        assert all(v is False for v in r.evaluation.values()) and (r.wanted is None or r.wanted == (not r.evaluation))
        assert ("G_pct_condition" in r.evaluation) == (not 0.3 <= r.target.count("G") / 40 <= 0.7)


def test_ranges_settle_like_single_places(spark):
    rng = random.Random(35)
    rows = [(f"g{i % 9}", f"t{i}", i % 4, a, a + rng.choice([10, 39, 40, 41, 500, 40000]), 1) for i, a in ((i, rng.randrange(1, 40000)) for i in range(60))]
    iso = spark.createDataFrame(rows + rows[:5], "gene STRING, tx_id STRING, tx_order INT, start BIGINT, end BIGINT, strand INT")
    w = isoforms.windows_isoform(iso, ranges=True).select("gene", F.col("pos").alias("genomic_start"), F.col("pos_last").alias("genomic_last"), F.col("tx_order").alias("_ord"), "tx_id")
    got = isoforms.window_places(isoforms.first_strand(w)).collect()
    want = {}
    for g, t, o, a, b, _ in rows:
        for p in range(a, b - 39):
            want[g, p] = min(want.get((g, p), (o, t)), (o, t))
    assert len(got) == len(want) and {(r.gene, r.genomic_start): r.tx_id for r in got} == {k: t for k, (_, t) in want.items()}
    assert all(r.genomic_end == r.genomic_start + 40 for r in got)


def test_arms_equal_plain_pairs(spark):
    rng = random.Random(36)
    rows = [(i, s, p, p + 1) for i, s in enumerate([dna(rng, rng.randrange(0, 110)) for _ in range(80)] + ["ACGTN" * 15, None]) for p in sorted({-1, 14, rng.randrange(0, 110)}) if p < len(s or "") or p < 0]
    points = spark.createDataFrame(rows, "doc_id INT, target STRING, pos5 BIGINT, pos3 BIGINT")
    def two(x):
        return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    want = {}
    for i, s, p, q in rows:
        for k in range(15, 26):
            for n in range(15, 26):
                if s is not None and k <= p + 1 and q + n <= len(s):
                    a, b = s[p + 1 - k:p + 1], s[q:q + n]
                    t5, t3 = (None, None) if "N" in s else (two(tm(a)), two(tm(b)))
                    want[i, p, k, n] = (t5, t3, revcomp(a), revcomp(b), None if t5 is None else two(abs(t5 - t3) + abs(k - 20) + abs(n - 20)))
    full = variants.arm_grid(points)
    got = {(r.doc_id, r.pos5, r.arm5_len, r.arm3_len): (r.tm5, r.tm3, r.bds5, r.bds3, r.score) for r in full.collect()}
    assert got == want and len(want) > 2000
    keys = ["doc_id", "pos5"]
    first = variants.rank_designs(variants.arm_grid(points, best=3), keys).filter("rank <= 3")
    assert sorted(map(str, first.collect())) == sorted(map(str, variants.rank_designs(full, keys).filter("rank <= 3").collect()))
    assert variants.arm_grid(points, best=3).groupBy(keys).count().agg(F.max("count")).first()[0] == 3
    figures = variants.arm_figures(points).drop("pos3")
    slow = full.groupBy(keys).agg(F.count("*").alias("n"), F.sum("arm5_len").alias("n5"), F.sum("arm3_len").alias("n3"), F.max("bds5").alias("bds5"), F.max("bds3").alias("bds3"),
                                  F.max("tm5").alias("tm5"), F.max("tm3").alias("tm3"), F.sum(F.round(F.col("score") * 100).cast("bigint")).alias("score"))
    assert sorted(map(str, figures.collect())) == sorted(map(str, slow.select(figures.columns).collect()))
