"""Quality checks of assembled probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .letters import others
from .sequence import col, fixed_point, gc_content, has_long_repeat


def invalid_letters(probe: Column | str) -> Column:
    """Distinct letters outside A, T, C, G, N, sorted."""
    return F.split(_invalid(probe), "")


def _invalid(probe: Column | str) -> Column:
    return others("ATCGN")(F.upper(col(probe)))


def _said(messages: list[Column]) -> Column:
    # without a lambda, which would have all of the messages interpreted
    return F.array_except(F.array(*messages), F.array(F.lit(None).cast("string")))


def with_quality(probes: DataFrame, probe: str = "probe") -> DataFrame:
    """Adds ``warnings``, ``errors`` and ``is_valid``."""
    p = F.col(probe)
    gc = gc_content(F.upper(p))
    warnings = [
        F.when(F.length(p) < 50, F.lit("Probe sequence is short")),
        F.when(F.length(p) > 200, F.lit("Probe sequence is long")),
        F.when((gc < 0.3) | (gc > 0.7), F.concat(F.lit("Abnormal GC content: "), fixed_point(gc, 2, 60))),
        F.when(has_long_repeat(p), F.lit("Contains long repeats")),
    ]
    bad = F.upper(p).rlike("[^ATCGN]")
    errors = _said([F.when(bad, F.concat(F.lit("Invalid bases: "), _invalid(p)))])
    return (probes.withColumn("warnings", _said(warnings)).withColumn("errors", errors)
            .withColumn("is_valid", F.size("errors") == 0))
