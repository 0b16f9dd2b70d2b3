"""Runs of spliced windows: isoforms are read once, and runs and chains are those of the plain walk."""

import random

from strandforge.operators import isoforms

from .test_kernels import dna


def walked(exons, length=40, tolerance=10):
    """(tx, off) -> (start, end, chain of the middle, touched) by stepping through the bases of every isoform."""
    points = {p for _, _, s, e, _ in exons for p in (s, e)}
    splices = {}
    for _, tx, s, e, _ in sorted(exons, key=lambda x: x[2]):
        cuts = sorted({s, e} | {p for p in points if s < p < e})
        splices.setdefault(tx, []).extend(zip(cuts, cuts[1:]))
    out, held = {}, {}
    for tx, sp in splices.items():
        at = [(p, i) for i, (s, e) in enumerate(sp) for p in range(s, e)]
        for off in range(1, len(at) - length):
            mid = [at[off + length // 2 + d][1] for d in (-tolerance, tolerance)]
            out[tx, off] = (at[off][0], at[off + length][0], tuple(sp[mid[0]:mid[1] + 1]), [tuple(x) for x in sp[at[off][1]:at[off + length][1] + 1]])
    for _, _, chain, _ in out.values():
        held[chain] = sorted(tx for tx, sp in splices.items() if any(tuple(sp[i:i + len(chain)]) == chain for i in range(len(sp))))
    return out, held


def made(spark, exons, size, seed):
    loci = spark.createDataFrame([("g", dna(random.Random(seed), size))], "gene STRING, seq STRING")
    rows = spark.createDataFrame(exons, "gene STRING, tx_id STRING, exon_start BIGINT, exon_end BIGINT, strand INT")
    return loci, rows


def test_runs_and_chains_equal_the_plain_walk(spark):
    rng = random.Random(31)
    exons = []
    for tx in ("t1", "t2", "t3", "t4"):
        at = rng.randint(1, 30)
        for _ in range(25):
            end = at + rng.choice([3, 7, 12, 40, 90])
            exons.append(("g", tx, at, end, -1 if tx == "t3" else 1))
            at = end + rng.choice([2, 5, 30])
    # the same exons again at the end of another isoform, which is too short there for windows of its own
    exons += [("g", "t5", s, e, 1) for _, tx, s, e, _ in exons if tx == "t1"][-3:]
    loci, rows = made(spark, exons, 3000, 5)
    want, held = walked(exons)
    got = {}
    for r in isoforms.spliced_windows(loci, rows).collect():
        assert (r.tx_id, r.off) not in got
        got[r.tx_id, r.off] = (r.start, r.end, r.n, [tuple(x) for x in r.touched], r.target_isoforms)
    assert got == {k: (a, b, len(c), t, held[c]) for k, (a, b, c, t) in want.items()}


def test_isoforms_are_read_once_and_runs_are_bounded(spark):
    exons = [("g", "t1", 1, 9001, 1), ("g", "t2", 1, 4001, 1), ("g", "t2", 5001, 9001, 1)]
    loci, rows = made(spark, exons, 9100, 6)
    plan = isoforms.spliced_windows(loci, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 4  # exons with their cuts, spans, isoforms and the text; not three times over
    runs = isoforms.spliced_runs(loci, rows).collect()
    assert max(r.off_end - r.off for r in runs) <= 4096
    assert {t: sum(r.off_end - r.off for r in runs if r.tx_id == t) for t in ("t1", "t2")} == {"t1": 8959, "t2": 7959}
    assert all(len(r.piece) == r.off_end - r.off + 39 for r in runs)
