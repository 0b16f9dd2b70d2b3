"""Personal data by fixed patterns and a semi-Markov conditional random field.

The fixed patterns give the base spans. The field looks at every stretch of text around a digit, an at sign or a bracketed "at", cuts it into
tokens and scores whole candidate segments of at most ``LONGEST`` tokens by features of the span: shape, digit groups, check sums, ends and
neighbours. Dynamic programming over the stretch chooses boundaries and types jointly (a token outside all segments scores 0). A
chosen segment is added where its posterior reaches ``SURE`` and it meets no base span; base spans always stay. A long stretch is judged in overlapping
pieces, so a segment of up to ``OVERLAP`` characters is seen whole wherever it lies.

The field is trained on a bounded sample of stretches that hold base spans, together with rewritten copies of them (spelt-out signs, other
separators), by conditional likelihood. Its weights, a few thousand numbers, are broadcast.

Defined cases: a null or empty text has no spans; a sample without base spans trains nothing and adds nothing; rows that repeat an id are judged each by
their own text; equal scores go to the shorter segment, then to the kind listed first. Matching time is linear in the text, also on long runs of digits.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .common import keep_columns, struct_field

KINDS = ["email", "ip", "card", "phone"]
#: Documents that are trained on and the longest among them; stretches taken from them; rounds; step.
SAMPLE, SAMPLE_CHARS, STRETCHES, ROUNDS, STEP = 400, 20_000, 500, 6, 0.5
LONGEST, AROUND, SURE = 14, 24, 0.95
#: A longer stretch is judged in pieces that answer for the segments starting in so many characters, and see so many more at both ends.
STRETCH, OVERLAP = 2000, 250

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]+|[\[(]at[\])]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[\d_]")
_AT = ("(at)", "[at]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, by start, then kind."""
    out: list[Span] = []
    end = at = 0
    backwards = text[::-1] if "@" in text else ""
    while (at := text.find("@", at)) >= 0:
        before = _LOCAL.match(backwards, len(text) - at, len(text) - end).end() - (len(text) - at)
        domain = _DOMAIN.match(text, at + 1) if before else None
        if domain:
            out.append((at - before, domain.end(), 0))
            end = domain.end()
        at += 1
    if any(c.isdigit() for c in text):
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        out += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def stretches(text: str) -> list[tuple[int, int]]:
    """Stretches around all seeds, merged where they meet."""
    out: list[list[int]] = []
    for m in _SEED.finditer(text):
        a, z = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = z
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def pieces(text: str):
    """(from, to, first, last): what a piece sees of a stretch, and where the segments start that it answers for."""
    for a, z in stretches(text):
        for x in range(a, z, STRETCH):
            yield max(a, x - OVERLAP), min(z, x + STRETCH + OVERLAP), x, min(z, x + STRETCH)


def _class(c: str) -> str:
    return "0" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def span_features(text: str, start: int, end: int, tokens: int) -> list[str]:
    """Features of a whole candidate segment."""
    s = text[start:end]
    shape, last = [], ""
    for c in s:
        if (k := _class(c)) != last:
            shape.append(k)
            last = k
    digits = _digits(s)
    groups = "-".join(str(min(len(g), 6)) for g in re.findall(r"[0-9]+", s)[:6])
    before = text[start - 1] if start else "^"
    after = text[end] if end < len(text) else "$"
    return ["bias", f"tokens{tokens}", f"digits{min(len(digits), 20)}", "shape" + "".join(shape[:24]), "groups" + groups,
            f"at{s.count('@')}{any(x in s for x in _AT)}", f"dots{min(s.count('.'), 5)}", f"first{_class(s[0])}", f"last{_class(s[-1])}",
            f"before{_class(before)}", f"after{_class(after)}", f"blank{min(s.count(' '), 4)}", "luhn" if len(digits) > 13 and luhn(digits) else "plain"]


class Lattice:
    """Candidate segments of one stretch: those of at most ``LONGEST`` tokens that hold a seed."""

    def __init__(self, text: str, a: int, z: int, known: dict[str, int], learn: bool = False):
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, a, z)]
        seeds = [bool(_SEED.match(text, s)) or text[max(0, s - 1):e + 1] in _AT for s, e in self.tokens]
        held = np.concatenate([[0], np.cumsum(seeds)]) if seeds else np.zeros(1, int)
        self.segments = [(i, j) for j in range(1, len(self.tokens) + 1) for i in range(j - 1, max(-1, j - 1 - LONGEST), -1) if held[j] > held[i]]
        rows = []
        for i, j in self.segments:
            names = span_features(text, self.tokens[i][0], self.tokens[j - 1][1], j - i)
            rows.append([known.setdefault(f, len(known) + 1) if learn else known.get(f, 0) for f in names])
        self.features = np.array(rows, np.int64).reshape(len(rows), -1)
        self.starts = np.array([i for i, _ in self.segments], np.int64)
        ends = np.array([j for _, j in self.segments], np.int64)
        self.at = np.searchsorted(ends, np.arange(len(self.tokens) + 2))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return weights[:, self.features].sum(axis=2).T  # segment x kind

    def posteriors(self, scores: np.ndarray) -> np.ndarray:
        """Probability of every segment and kind, by the forward and backward recursions."""
        n, whole = len(self.tokens), np.logaddexp.reduce(scores, axis=1)
        forward, backward = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            k = slice(self.at[j], self.at[j + 1])
            forward[j] = np.logaddexp.reduce(np.append(forward[self.starts[k]] + whole[k], forward[j - 1]))
        total = np.full(n + 1, -np.inf)
        for j in range(n, 0, -1):
            total[j - 1] = np.logaddexp(total[j - 1], backward[j])
            k = slice(self.at[j], self.at[j + 1])
            i = self.starts[k]
            total[i] = np.logaddexp(total[i], backward[j] + whole[k])  # starts of one end are distinct
            backward[j - 1] = total[j - 1]
        ends = np.array([j for _, j in self.segments])
        return np.exp(forward[self.starts][:, None] + scores + backward[ends][:, None] - forward[n])

    def best(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """(segment, kind) of the best segmentation."""
        n = len(self.tokens)
        value, back = np.zeros(n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for k in range(self.at[j], self.at[j + 1]):
                kind = int(scores[k].argmax())
                if (v := value[self.starts[k]] + scores[k, kind]) > value[j]:
                    value[j], back[j] = v, (k, kind)
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                out.append(back[j])
                j = int(self.starts[back[j][0]])
        return out[::-1]


class Field:
    def __init__(self, known: dict[str, int], weights: np.ndarray):
        self.known, self.weights = known, weights

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans beyond the base ones."""
        out: list[Span] = []
        if not self.known:
            return out
        for a, z, first, last in pieces(text):
            if not any(c not in " \t\n" for c in text[a:z]):
                continue
            lattice = Lattice(text, a, z, self.known)
            if not lattice.segments:
                continue
            scores = lattice.scores(self.weights)
            best = lattice.best(scores)
            if not best:
                continue
            sure = lattice.posteriors(scores)
            for k, kind in best:
                i, j = lattice.segments[k]
                s, e = lattice.tokens[i][0], lattice.tokens[j - 1][1]
                if not first <= s < last or (out and s < out[-1][1]):
                    continue
                if sure[k, kind] >= SURE and not any(s < y and x < e for x, y, _ in base):
                    out.append((s, e, kind))
        return out


def _rewritten(text: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """The stretch itself, and copies with spelt-out signs or other separators inside its spans."""
    forms = [lambda s, k: s, lambda s, k: s.replace("@", " (at) ") if k == 0 else s.replace(".", "-") if k == 3 else s,
             lambda s, k: s.replace("@", "[at]") if k == 0 else s.replace("+", "00", 1) if k == 3 else s.replace("-", ".").replace(" ", ".") if k == 2 else s]
    out = []
    for form in forms:
        parts, own, at, shift = [], [], 0, 0
        for s, e, k in spans:
            if s < at:
                continue
            new = form(text[s:e], k)
            parts += [text[at:s], new]
            own.append((s + shift, s + shift + len(new), k))
            shift += len(new) - (e - s)
            at = e
        out.append(("".join(parts) + text[at:], own))
    return out


def fit(texts: list[str], rounds: int = ROUNDS, most: int = STRETCHES) -> Field:
    """A field trained on the stretches of ``texts``; deterministic."""
    known: dict[str, int] = {}
    held = []
    for text in texts:
        if len(held) >= most:
            break
        for cut, spans in _rewritten(text, base_spans(text)) if base_spans(text) else ():
            for a, z, _, _ in pieces(cut):
                lattice = Lattice(cut, a, z, known, learn=True)
                place = {(lattice.tokens[i][0], lattice.tokens[j - 1][1]): k for k, (i, j) in enumerate(lattice.segments)}
                gold = [(place.get((s, e)), k) for s, e, k in spans if a <= s and e <= z]
                if lattice.segments and len(lattice.tokens) < 400 and all(g is not None for g, _ in gold):
                    held.append((lattice, gold))
    if not any(gold for _, gold in held):
        return Field({}, np.zeros((len(KINDS), 1)))
    weights, power = np.zeros((len(KINDS), len(known) + 1)), np.full((len(KINDS), len(known) + 1), 1e-6)
    weights[:, known["bias"]] = -2
    for turn in range(rounds):
        for at in np.random.default_rng(turn).permutation(len(held)):
            lattice, gold = held[at]
            off = -lattice.posteriors(lattice.scores(weights))
            for k, kind in gold:
                off[k, kind] += 1
            for kind in range(len(KINDS)):
                strong = np.nonzero(np.abs(off[:, kind]) > 1e-4)[0]
                if len(strong):
                    grad = np.bincount(lattice.features[strong].ravel(), np.repeat(off[strong, kind], lattice.features.shape[1]), len(known) + 1)
                    some = np.nonzero(grad)[0]
                    power[kind, some] += grad[some] ** 2
                    weights[kind, some] += STEP * (grad[some] / np.sqrt(power[kind, some]) - 2e-3 * weights[kind, some])
    weights[:, 0] = 0
    return Field(known, weights)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


ADDED = [*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]


def _find(field, text_name: str):
    def kernel(batches):
        for b in batches:
            counts, hashes, spans = [], [], []
            for text in struct_field(b.column("row"), text_name):
                text = text.as_py() or ""
                base = base_spans(text)
                every = sorted(base + field.value.added(text, base), key=lambda s: (s[0], s[2]))
                counts.append([sum(k == kind for _, _, k in base) for kind in range(len(KINDS))])
                hashes.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
            yield pa.record_batch([b.column("row"), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))],
                                   pa.array(hashes, pa.string()), pa.array(spans, pa.string())], names=["row", *[f.name for f in ADDED]])
    return kernel


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Field:
    """Fit on at most ``sample`` texts of at most ``chars`` characters that look as if they held a span, in hash order."""
    rows = docs.select(F.col(text).alias("text")).filter(F.length("text").between(1, chars)).filter(
        F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.|\+[0-9][ (0-9]|[0-9]\.[0-9]+\.[0-9]|[0-9]{4}[ -]?[0-9]{4}"))
    # written first: the tasks' own samples meet in a task, and the driver gets one sample however many they are
    told = cut_lineage(rows.withColumn("turn", F.xxhash64("text")).orderBy("turn", "text").limit(sample), "sample").collect()
    return fit([r["text"] for r in sorted(told, key=lambda r: (r["turn"], r["text"].encode()))])


def find_spans(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with the counts of base spans by kind, their digest and all spans."""
    return keep_columns(docs, _find(docs.sparkSession.sparkContext.broadcast(field), text), ADDED)
