"""Nearest-neighbour melting temperatures from exact integer sums.

Enthalpy and entropy are kept as positive tenths (78 stands for -7.8), so sums are exact in any order
and are turned into a temperature once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, functions as F

from .letters import step_total
from .sequence import col

# Fixed values from here to the end of the block: published nearest-neighbour parameters,
# dinucleotide as read 5'->3' -> (-10 dH kcal/mol, -10 dS cal/(mol K)).
# DNA probe on RNA: Sugimoto et al. 1995.
DNA_RNA = {
    "AA": (78, 219), "AC": (59, 123), "AG": (91, 235), "AT": (83, 239),
    "CA": (90, 261), "CC": (93, 232), "CG": (163, 471), "CT": (70, 197),
    "GA": (55, 135), "GC": (80, 171), "GG": (128, 319), "GT": (78, 216),
    "TA": (78, 232), "TC": (86, 229), "TG": (104, 284), "TT": (115, 364),
}
# RNA on RNA: Freier et al. 1986.
RNA_RNA = {
    "AA": (66, 184), "AC": (102, 262), "AG": (76, 192), "AT": (57, 155),
    "CA": (105, 278), "CC": (122, 297), "CG": (80, 194), "CT": (76, 192),
    "GA": (133, 355), "GC": (142, 349), "GG": (122, 297), "GT": (102, 262),
    "TA": (81, 226), "TC": (133, 355), "TG": (105, 278), "TT": (66, 184),
}
# DNA on DNA: SantaLucia and Hicks 2004.
DNA_DNA = {
    "AA": (76, 213), "AC": (84, 224), "AG": (78, 210), "AT": (72, 204),
    "CA": (85, 227), "CC": (80, 190), "CG": (106, 272), "CT": (78, 210),
    "GA": (82, 222), "GC": (98, 244), "GG": (80, 190), "GT": (84, 224),
    "TA": (72, 204), "TC": (82, 222), "TG": (85, 227), "TT": (76, 213),
}
GAS_CONSTANT = 1.987
STRAND_TERM = 12.5e-9      # 25 nM minus half of 25 nM
SODIUM = 0.05              # mol/l
SALT_FACTOR = 0.368
KELVIN = 273.15


@dataclass(frozen=True)
class NearestNeighbour:
    name: str
    steps: dict = field(hash=False)
    init_h: int            # tenths, sign as published
    init_s: int
    end_at_h: int = 0      # per terminal A or T
    end_at_s: int = 0


TABLES = {
    "DNA_RNA": NearestNeighbour("DNA_RNA", DNA_RNA, 19, -39),
    "RNA_RNA": NearestNeighbour("RNA_RNA", RNA_RNA, 0, -108),
    "DNA_DNA": NearestNeighbour("DNA_DNA", DNA_DNA, 2, -57, 22, 69),
}


def table_for(sequence_type: str, target_type: str) -> NearestNeighbour:
    """DNA on RNA, RNA on RNA, and DNA on DNA for every other pairing."""
    if (sequence_type, target_type) == ("DNA", "RNA"):
        return TABLES["DNA_RNA"]
    if (sequence_type, target_type) == ("RNA", "RNA"):
        return TABLES["RNA_RNA"]
    return TABLES["DNA_DNA"]


def strand_entropy() -> float:
    return GAS_CONSTANT * math.log(STRAND_TERM)


def salt_per_step() -> float:
    return SALT_FACTOR * math.log(SODIUM)


def melting_point(h: Column, s: Column, length, table: NearestNeighbour = TABLES["DNA_RNA"],
                  at_ends: Column | None = None) -> Column:
    """Temperature in Celsius from summed tenths ``h`` and ``s`` of a duplex of ``length`` bases."""
    steps = F.lit(float(length - 1)) if isinstance(length, int) else (length - 1).cast("double")
    top, bottom = F.lit(table.init_h) - h, F.lit(table.init_s) - s
    if at_ends is not None and (table.end_at_h or table.end_at_s):
        top, bottom = top + at_ends * table.end_at_h, bottom + at_ends * table.end_at_s
    entropy = (bottom.cast("double") / 10.0 + steps * F.lit(salt_per_step())) + F.lit(strand_entropy())
    return (F.lit(1000.0) * (top.cast("double") / 10.0)) / entropy - F.lit(KELVIN)


def melting_points(h: np.ndarray, s: np.ndarray, length, table: NearestNeighbour = TABLES["DNA_RNA"]) -> np.ndarray:
    """``melting_point`` for kernels, in the same order of operations; for tables without end terms."""
    entropy = ((table.init_s - s) / 10.0 + (length - 1) * salt_per_step()) + strand_entropy()
    return (1000.0 * ((table.init_h - h) / 10.0)) / entropy - KELVIN


_HIGH = 1 << 20


def step_sums(seq: Column | str, table: NearestNeighbour = TABLES["DNA_RNA"]) -> tuple[Column, Column]:
    """(h, s) of a short string, in tenths; null when it holds anything but A, C, G, T."""
    packed = step_total(tuple(h * _HIGH + s for h, s in (table.steps[a + b] for a in "ACGT" for b in "ACGT")))(col(seq))
    return F.shiftright(packed, 20), packed.bitwiseAND(_HIGH - 1)


def tm_nn(seq: Column | str, table: NearestNeighbour = TABLES["DNA_RNA"]) -> Column:
    """Melting temperature of a short string (an arm, a probe)."""
    s = col(seq)
    h, e = step_sums(s, table)
    ends = None
    if table.end_at_h or table.end_at_s:
        ends = (F.left(s, F.lit(1)).isin("A", "T").cast("int")
                + F.right(s, F.lit(1)).isin("A", "T").cast("int"))
    return melting_point(h, e, F.length(s), table, ends)
