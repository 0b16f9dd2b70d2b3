"""Sequence functions as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import letters


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revcomp(seq: Column | str) -> Column:
    """Reverse complement; N and any other letter stay as they are (see ``has_bad_letters``)."""
    return F.reverse(F.translate(col(seq), "ACGT", "TGCA"))


def has_bad_letters(seq: Column | str, allowed: str = "ACGTN") -> Column:
    return col(seq).rlike(f"[^{allowed}]")


def base_count(seq: Column | str, base: str) -> Column:
    s = col(seq)
    return F.length(s) - F.length(F.replace(s, F.lit(base), F.lit("")))


def g_content(seq: Column | str) -> Column:
    return base_count(seq, "G") / F.length(col(seq)).cast("double")


def gc_content(seq: Column | str) -> Column:
    return (base_count(seq, "G") + base_count(seq, "C")) / F.length(col(seq)).cast("double")


def has_run(seq: Column | str, base: str, n: int) -> Column:
    return F.contains(col(seq), F.lit(base * n))


def left(seq: Column | str, n) -> Column:
    return F.left(col(seq), F.lit(n) if isinstance(n, int) else n)


def skip(seq: Column | str, n: int) -> Column:
    """Everything after the first ``n`` letters."""
    return F.substring(col(seq), n + 1, 2**31 - 1)


def arms(probe: Column | str, length: int) -> tuple[Column, Column, Column]:
    """(3' arm, 5' arm, full): the front half, the back half and the rotation back + front."""
    arm3, arm5 = left(probe, length // 2), skip(probe, length // 2)
    return arm3, arm5, F.concat(arm5, arm3)


def middle(seq: Column | str, width: int = 32) -> Column:
    """The middle ``width`` letters, the part handed to an aligner."""
    s = col(seq)
    half = F.floor(F.length(s) / 2).cast("int")
    return s.substr(half - width // 2 + 1, F.lit(width))


def strip_n(seq: Column | str) -> Column:
    return F.replace(col(seq), F.lit("N"), F.lit(""))


def tandem_copies(seq: Column | str, copies: int = 3) -> Column:
    """Rolling-circle product: the reverse complement repeated head to tail."""
    return F.repeat(F.upper(revcomp(seq)), copies)


def hamming(a: Column | str, b: Column | str, ignore_case: bool = False, unequal=None) -> Column:
    """Mismatches of equal-length strings; ``unequal`` (null or -1) when the lengths differ."""
    a, b = col(a), col(b)
    if ignore_case:
        a, b = F.upper(a), F.upper(b)
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int"))
    count = F.aggregate(pairs, F.lit(0), lambda acc, v: acc + v)
    return F.when(F.length(a) == F.length(b), count).otherwise(F.lit(unequal).cast("int"))


def suffix_prefix_overlap(a: Column | str, b: Column | str) -> Column:
    """Longest suffix of ``a`` that is a prefix of ``b``."""
    return letters.overlap()(col(a), col(b))


def has_long_repeat(seq: Column | str, k: int = 8) -> Column:
    """True when some k-mer occurs twice without overlapping itself."""
    return letters.repeats(k)(col(seq))


def longest_stem(seq: Column | str, shortest: int = 3, longest: int | None = None, loop: int = 3) -> Column:
    """Longest stem a strand can fold into, from inverted repeats with a loop of at least ``loop``; up to ``longest`` if that is given."""
    best = letters.stem(loop)(col(seq))
    if longest is not None:
        best = F.least(best, F.lit(max(longest, shortest)))
    return F.when(best >= shortest, best).otherwise(F.lit(0))


def mutate(seq: Column | str, start, end, ref: Column | str, alt: Column | str) -> Column:
    """Apply a change to ``seq[start:end]`` (0-based, half-open). ``-`` marks an insertion or a deletion."""
    s, ref, alt = col(seq), col(ref), col(alt)
    start, end = col(start).cast("int"), col(end).cast("int")
    head = F.when(ref == "-", F.left(s, end)).otherwise(F.left(s, start))
    body = F.when(alt == "-", F.lit("")).otherwise(alt)
    return F.concat(head, body, s.substr(end + 1, F.length(s)))


def flip_position(pos: Column | str, other: Column | str, length, strand: Column | str) -> Column:
    """Position on the strand-corrected target: itself on strand 1, ``length - other - 1`` on strand -1."""
    return F.when(col(strand) == 1, col(pos)).otherwise(col(length) - col(other) - 1)


def format_gene(name: Column | str, organism: str) -> Column:
    """Mouse: first letter upper and the rest lower; human: upper; otherwise unchanged."""
    n = col(name)
    if organism == "mouse":
        return F.concat(F.upper(F.left(n, F.lit(1))), F.lower(skip(n, 1)))
    return F.upper(n) if organism == "human" else n


def fixed_point(x: Column | str, digits: int, bits: int = 50) -> Column:
    """A non-negative number with ``digits`` decimals, rounded from its exact binary value, ties to even.

    ``bits`` says how far to scale so that the double is a whole number: 50 suits 8 <= x < 4096,
    60 suits 2**-7 <= x < 8.
    """
    ten, unit, half = 10 ** digits, 1 << bits, 1 << (bits - 1)
    whole = (col(x) * F.lit(float(unit))).cast("bigint").cast("decimal(38,0)") * F.lit(ten).cast("decimal(6,0)")
    unit_c = F.lit(unit).cast("decimal(20,0)")
    rest = whole % unit_c
    down = ((whole - rest) / unit_c).cast("bigint")
    up = (rest > half) | ((rest == half) & (down % 2 == 1))
    # only what lies next to a tie needs all the digits
    near = col(x) * F.lit(float(ten))
    q = F.when(F.abs(near - F.rint(near)) < 0.499, F.rint(near).cast("bigint")).otherwise(down + up.cast("bigint"))
    return F.concat(F.floor(q / ten).cast("string"), F.lit("."), F.lpad((q % ten).cast("string"), digits, "0"))


def rounded(x: Column | str, digits: int) -> Column:
    """``F.round`` of a double by plain arithmetic; what lies next to a tie, or is large or not finite, takes the decimal way."""
    c, scale = col(x), F.lit(float(10 ** digits))
    up = c * scale
    whole = F.rint(up)
    # up to a billion the product is off by less than 1e-6; adding zero turns -0.0 into 0.0 as decimals do
    plain = (F.abs(up) < 1e9) & (F.abs(up - whole) < 0.499)
    return F.when(plain, (whole + F.lit(0.0)) / scale).otherwise(F.round(c, digits))
