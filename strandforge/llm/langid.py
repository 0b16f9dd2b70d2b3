"""Language by cross-parsing entropy.

Of each language a suffix automaton is built over a bounded sample of labelled text. A text is parsed against it from left to right into
the longest pieces that occur in the sample; few, long phrases mean that the text is well explained. The language with the fewest phrases,
each weighted by the logarithm of the sample's length (so that languages with less text are not favoured), wins.

An automaton is a dense table state x symbol, so thousands of pieces of text ("lanes") are parsed in lockstep by numpy. Texts are cut into
lanes of ``LANE`` symbols, whole texts to their end; a phrase ends with its lane. Symbols are the lower-cased letters of the samples, one symbol
for any run of blanks, digits and marks, and one for letters that no sample holds.

Training text is a bounded sample: per language whole documents in hash order of their ids, up to ``CHARS`` symbols. Tables are broadcast; their
size is at most 2 * CHARS states * symbols * 4 bytes per language.

Defined cases: a null or empty text, or one without letters, is ``und`` with score 0; equal phrase counts go to the smaller language name; without
labelled text everything is ``und``; rows that repeat a doc_id are judged each by its own text; documents with a null id may be learned from.
"""

from __future__ import annotations

import regex

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import keep_columns, struct_field

#: Symbols per language that are learned from, documents per language that are fetched for them, and the longest document among these.
CHARS, DOCS, DOC_CHARS = 24_000, 64, 20_000
LANE = 256
LANES = 8192
#: Most letters with a symbol of their own; rarer ones share one.
LETTERS = 96
UNKNOWN = "und"

_OTHER = regex.compile(r"\P{L}+")


def fold(text: str | None) -> str:
    """Lower-cased letters with one blank for all that lies between them."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``symbols``: a row per state, 0 (the root) where there is none."""
    most = 2 * len(symbols) + 2
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.zeros((min(len(go), most), width), np.int32)
    for state, edges in enumerate(go):
        for c, to in edges.items():
            table[state, c] = to
    return table


class Model:
    """Languages in order, symbol of each character code, transition tables and the weight of a phrase."""

    def __init__(self, samples: dict[str, list[str]], chars: int = CHARS):
        folded = {lang: "  ".join(map(fold, texts))[:chars] for lang, texts in samples.items()}
        folded = {lang: text for lang, text in folded.items() if text.strip()}
        self.languages = sorted(folded)
        counts: dict[str, int] = {}
        for text in folded.values():
            for c in set(text):
                counts[c] = counts.get(c, 0) + text.count(c)
        counts.pop(" ", None)
        own = sorted(sorted(counts), key=lambda c: -counts[c])[:LETTERS]
        # symbol 0 pads lanes, 1 is the blank, 2 any other letter
        self.codes = np.array(sorted(map(ord, own)), np.uint32)
        self.width = len(self.codes) + 3
        self.tables, self.weights = [], []
        for lang in self.languages:
            symbols = self.symbols(folded[lang])
            table = automaton(symbols[symbols != 2], self.width)
            self.tables.append(table.reshape(-1))
            self.weights.append(np.log2(len(symbols) + 1))

    def symbols(self, folded: str) -> np.ndarray:
        codes = np.frombuffer(folded.encode("utf-32-le", "replace"), np.uint32)
        at = np.searchsorted(self.codes, codes)
        known = self.codes[np.minimum(at, len(self.codes) - 1)] == codes if len(self.codes) else np.zeros(len(codes), bool)
        return np.where(known, at + 3, np.where(codes == 32, 1, 2)).astype(np.int32)

    def phrases(self, lanes: np.ndarray) -> np.ndarray:
        """Phrases of every lane (a column of ``lanes``) by language; symbol 0 ends a lane."""
        length, count = lanes.shape
        out = np.zeros((len(self.languages), count), np.int64)
        used = (lanes > 0).sum(axis=1)  # columns are sorted by length, longest first
        for k, table in enumerate(self.tables):
            state, total = np.zeros(count, np.int32), np.zeros(count, np.int64)
            for t in range(length):
                n = used[t]
                if not n:
                    break
                c = lanes[t, :n]
                to = table[state[:n] * self.width + c]
                miss = (to == 0) | (state[:n] == 0)
                total[:n] += miss
                state[:n] = np.where(miss, table[c], to)
            out[k] = total
        return out

    def costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Weighted phrases per symbol of each text by language, and the number of its symbols."""
        flat = [self.symbols(fold(t)) for t in texts]
        sizes = np.array([len(x) for x in flat], np.int64)
        total = np.zeros((len(self.languages), len(texts)))
        pieces = [(x[s:s + LANE], i) for i, x in enumerate(flat) for s in range(0, len(x), LANE)]
        for at in range(0, len(pieces), LANES):
            part = sorted(pieces[at:at + LANES], key=lambda p: -len(p[0]))
            lanes = np.zeros((LANE, len(part)), np.int32)
            for j, (x, _) in enumerate(part):
                lanes[:len(x), j] = x
            owner = np.array([i for _, i in part])
            found = self.phrases(lanes)
            for k, weight in enumerate(self.weights):
                total[k] += np.bincount(owner, found[k] * weight, len(texts))
        return total / np.maximum(sizes, 1), sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score: by how far the runner-up needs more, from 0 (a tie) to nearly 1; 1 if only one language is known."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        costs, sizes = self.costs(texts)
        best = costs.argmin(axis=0)
        least = costs.min(axis=0)
        second = np.partition(costs, 1, axis=0)[1] if len(costs) > 1 else np.full(len(texts), np.inf)
        score = np.where(sizes > 0, 1 - least / np.maximum(second, 1e-12), 0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, sizes)], np.clip(np.round(score, 9), 0, 1)


def _predict(model, text_name: str, at_once: int = 512):
    def kernel(batches):
        for b in batches:
            texts = struct_field(b.column("row"), text_name)
            langs, scores = [], []
            for at in range(0, len(texts), at_once):
                some, score = model.value.predict(texts.slice(at, at_once).to_pylist())
                langs += some
                scores.append(score)
            yield pa.record_batch([b.column("row"), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                  names=["row", "lang_pred", "score"])
    return kernel


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", chars: int = CHARS, docs_each: int = DOCS,
          doc_chars: int = DOC_CHARS) -> Model:
    """Fit on at most ``docs_each`` documents of ``doc_chars`` characters per language; a language is any value of ``lang``."""
    rows = docs.select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("turn"), F.col(text).alias("text"))
    rows = rows.filter("lang IS NOT NULL").filter(F.length("text").between(1, doc_chars))
    some = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "text"))).filter(F.col("place") <= docs_each)
    samples: dict[str, list[str]] = {}
    for r in some.orderBy("lang", "place").collect():  # bounded per language by the parameters
        samples.setdefault(r["lang"], []).append(r["text"])
    return Model(samples, chars)


def predict_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_columns(docs, _predict(shared, text), [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
