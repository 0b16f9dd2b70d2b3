"""Threshold filters over window and probe rows."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequence import g_content, has_run
from .windows import rotated_target


@dataclass(frozen=True)
class Thresholds:
    """Limits of the search; bounds are inclusive. Defaults are the library defaults, not the demo's."""
    length: int = 40
    max_sites: int = 30
    min_g: float = 0.4
    max_g: float = 0.7
    max_run: int = 4
    min_tm: float = 45.0
    max_tm: float = 65.0
    max_tm_diff: float = 10.0
    min_free_energy: float = -10.0

    def but(self, **changes) -> "Thresholds":
        return replace(self, **changes)


DEMO = Thresholds(max_sites=100, min_g=0.3, max_g=0.7, max_run=3, min_tm=50.0, max_tm=80.0)


def _g_run(t: Thresholds) -> Column:
    # a run of G in the rotated probe is a run of C in the rotated target
    return has_run(rotated_target(t.length), "C", t.max_run + 1)


def passing(windows: DataFrame, t: Thresholds) -> DataFrame:
    """Rows within every limit, cheapest test first. Rows with unknown letters have null Tm and drop out."""
    return (windows.filter(F.col("g_content").between(t.min_g, t.max_g))
            .filter(F.col("tm_3").between(t.min_tm, t.max_tm) & F.col("tm_5").between(t.min_tm, t.max_tm)
                    & F.col("tm").between(t.min_tm, t.max_tm) & (F.col("tm_diff") <= t.max_tm_diff))
            .filter(~_g_run(t)))


def _chosen(tests: list[Column], values: list[Column]) -> Column:
    """Of one constant per subset of the tests that of those that hold; no lambda, so rows are not worked on letter by letter."""
    held = F.lit(0)
    for i, test in enumerate(tests):
        held = held + F.when(test, F.lit(1 << i)).otherwise(F.lit(0))
    return F.get(F.array(*values), held)


def filter_counts(checked: DataFrame, gene: str = "gene") -> DataFrame:
    """Sites before and after the limits per gene, from rows with ``passed``."""
    return checked.groupBy(gene).agg(F.count("*").alias("before"), F.count_if("passed").alias("after"))


def with_failed_checks(windows: DataFrame, t: Thresholds, free_energy: str | None = None) -> DataFrame:
    """Every check evaluated: names of the failed ones in ``failed_checks``, and ``passed``."""
    def outside(c: str) -> Column:
        return ~F.col(c).between(t.min_tm, t.max_tm)

    unknown = F.col("tm").isNull()
    checks = [
        (~F.col("g_content").between(t.min_g, t.max_g), "g_content"),
        (_g_run(t), "consecutive_g"),
        (unknown, "tm_calculation_error"),
        (unknown | outside("tm"), "tm_range"),
        (unknown, "tm_half_calculation_error"),
        (outside("tm_3"), "tm_3prime_range"),
        (outside("tm_5"), "tm_5prime_range"),
        (F.col("tm_diff") > t.max_tm_diff, "tm_diff"),
    ]
    if free_energy:
        checks.append((F.col(free_energy) < t.min_free_energy, "rna_structure"))
    failed = _chosen([bad for bad, _ in checks], [
        F.array(*[F.lit(name) for i, (_, name) in enumerate(checks) if mask >> i & 1]).cast("array<string>") for mask in range(1 << len(checks))])
    return windows.withColumn("failed_checks", failed).withColumn("passed", F.size("failed_checks") == 0)


def passing_free_energy(sites: DataFrame, energies: DataFrame, on: list[str], least: float = -10.0) -> DataFrame:
    """Keep sites whose supplied folding energy is not below ``least``; sites without one are kept."""
    return (sites.join(energies, on, "left")
            .filter(F.coalesce(F.col("mfe") >= least, F.lit(True))))


def passing_target_strand(windows: DataFrame, min_g=0.3, max_g=0.7, run=5, low=50.0, high=65.0, diff=5.0) -> DataFrame:
    """The earlier rule set: temperatures on the target strand, run length exact, no limit on the whole Tm."""
    return windows.filter(target_strand_tests(min_g, max_g, run, low, high, diff)["all"])


def target_strand_tests(min_g=0.3, max_g=0.7, run=5, low=50.0, high=65.0, diff=5.0,
                        mfe: str | None = None, mfe_least: float = -10.0) -> dict[str, Column]:
    tests = {
        "G_condition": ~has_run("target", "G", run),
        "G_pct_condition": F.col("g_content").between(min_g, max_g),
        "Tm_condition": F.col("tm_3").between(low, high) & F.col("tm_5").between(low, high),
        "Tm_thre_condition": F.col("tm_diff") <= diff,
    }
    if mfe:
        tests["mfe_condition"] = F.coalesce(F.col(mfe) >= mfe_least, F.lit(True))
    both = F.lit(True)
    for c in tests.values():
        both = both & c
    return {**tests, "all": both}


def target_strand_report(windows: DataFrame, **limits) -> DataFrame:
    """Rows kept; ``evaluation`` maps each failed test to false, ``wanted`` tells whether all hold."""
    tests = target_strand_tests(**limits)
    names = [n for n in tests if n != "all"]
    failed = [F.map_from_arrays(F.array(*[F.lit(n) for n in some]).cast("array<string>"), F.array(*[F.lit(False) for _ in some]).cast("array<boolean>"))
              for some in ([n for i, n in enumerate(names) if mask >> i & 1] for mask in range(1 << len(names)))]
    return (windows.withColumn("evaluation", _chosen([~tests[n] for n in names], failed))
            .withColumn("wanted", tests["all"]))


def simple_g_test(seq: str) -> Column:
    """No run of five G and a G share of 0.3 to 0.7."""
    return ~has_run(seq, "G", 5) & g_content(seq).between(0.3, 0.7)


def listed_messenger(records: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """Records of listed genes whose molecule type is mRNA."""
    return records.filter(F.col("mol_type") == "mRNA").join(
        genes.select(F.col("gene_name").alias(gene)).distinct(), gene, "left_semi")


def threshold_errors(params: DataFrame) -> DataFrame:
    """Check rows of limits; ``errors`` lists what is wrong with each."""
    rules = [
        (F.col("length") <= 0, "binding_site_length must be > 0"),
        (F.col("max_sites") <= 0, "max_binding_sites must be > 0"),
        (~F.col("min_g").between(0, 1), "min_g_content must be between 0 and 1"),
        (~F.col("max_g").between(0, 1), "max_g_content must be between 0 and 1"),
        (F.col("min_g") >= F.col("max_g"), "min_g_content must be < max_g_content"),
        (F.col("min_tm") >= F.col("max_tm"), "min_tm must be < max_tm"),
    ]
    return params.withColumn("errors", F.array_compact(F.array(*[F.when(bad, F.lit(m)) for bad, m in rules])))
