"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A word's input is its own vector (zero for words outside the vocabulary) beside the mean of its characters' trigram vectors. Two gated
recurrent passes run over a window of words, attention pools their states, and a linear unit gives the window's logit. Every text is
scored in all of its overlapping windows, to its end; its score is that of its worst window, and training works the same way: the gradient goes
through the window that is worst at the time.

Training rows are a bounded sample of labelled rows (``positives``, ``negatives``, each of at most ``chars`` characters), drawn by the hash of
their ids. The fitted weights, some MB of bounded size, are broadcast. Words of a task are looked up in a bounded cache of projected inputs.

Defined cases: a null text or one without words scores as the bias alone; a label that is null or not 0 or 1 is no label; rows that repeat
a doc_id are scored each by its own text; without labels of both kinds every score is the share of label 1 (0 without any label).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import keep_columns, struct_field

WINDOW, STRIDE = 32, 24
#: Labelled rows that are fitted on, and the longest text among them.
POSITIVES, NEGATIVES, CHARS = 1500, 3000, 20_000
HIDDEN, WIDTH, ATTENTION, TRIGRAMS = 8, 12, 8, 1 << 13
EPOCHS, BATCH, RATE, LEAST_DOCS = 10, 128, 0.02, 3
THRESHOLD = 0.7
#: Words whose inputs a task keeps projected; the cache starts anew when it is full.
CACHE_WORDS = 200_000
BLOCK = 4096
SEED = 7

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def trigrams(word: str) -> list[int]:
    marked = f"<{word}>"
    return [xxhash.xxh32_intdigest(marked[i:i + 3]) % TRIGRAMS for i in range(len(marked) - 2)]


def window_starts(n: int) -> list[int]:
    """Starts of the overlapping windows of n words; the last one ends at the last word."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Model:
    """Weights by name, and the vocabulary of words that have a vector of their own (row 0: none)."""

    def __init__(self, vocabulary: dict[str, int], weights: dict[str, np.ndarray], prior: float | None = None):
        self.vocabulary, self.weights, self.prior = vocabulary, weights, prior

    @classmethod
    def fresh(cls, vocabulary: dict[str, int]) -> Model:
        rng, h, d = np.random.default_rng(SEED), HIDDEN, 2 * WIDTH
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        weights = {"words": 0.1 * rng.normal(size=(len(vocabulary) + 1, WIDTH)).astype(np.float32),
                   "chars": 0.1 * rng.normal(size=(TRIGRAMS, WIDTH)).astype(np.float32),
                   "att": draw(2 * h, ATTENTION), "att_v": draw(ATTENTION, 1)[:, 0], "out": draw(2 * h, 1)[:, 0], "bias": np.float32([-1.0])}
        weights["words"][0] = 0
        for way in "fb":
            weights |= {f"in_{way}": draw(d, 3 * h), f"off_{way}": np.zeros(3 * h, np.float32), f"state_{way}": draw(h, 3 * h)}
        return cls(vocabulary, weights)

    def inputs(self, words: list[str]) -> np.ndarray:
        """Word and character vector of each word."""
        out = np.empty((len(words), 2 * WIDTH), np.float32)
        for at in range(0, len(words), BLOCK):
            some = words[at:at + BLOCK]
            grams = [trigrams(w) for w in some]
            sizes = np.array([len(g) for g in grams])
            flat = np.fromiter((g for one in grams for g in one), np.int64, int(sizes.sum()))
            out[at:at + BLOCK, :WIDTH] = self.weights["words"][[self.vocabulary.get(w, 0) for w in some]]
            out[at:at + BLOCK, WIDTH:] = np.add.reduceat(self.weights["chars"][flat], np.cumsum(sizes) - sizes) / sizes[:, None]
        return out

    def project(self, x: np.ndarray) -> np.ndarray:
        """What a word adds to the gates of both directions."""
        w = self.weights
        return np.concatenate([x @ w["in_f"] + w["off_f"], x @ w["in_b"] + w["off_b"]], axis=1)

    def run(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows of equal length, given as rows of ``gates``; with ``keep`` also what the backward pass needs."""
        w, h = self.weights, HIDDEN
        count, length = ids.shape
        states = np.empty((length, count, 2 * h), np.float32)
        saved = []
        for k, way in enumerate("fb"):
            u, state = w[f"state_{way}"], np.zeros((count, h), np.float32)
            mine = gates[:, 3 * h * k:3 * h * (k + 1)]
            for t in range(length) if way == "f" else reversed(range(length)):
                a = mine[ids[:, t]]
                s = state @ u
                zr = _sigmoid(a[:, :2 * h] + s[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(a[:, 2 * h:] + r * s[:, 2 * h:])
                if keep:
                    saved.append((way, t, state, zr, new, s[:, 2 * h:]))
                state = new + z * (state - new)
                states[t, :, h * k:h * (k + 1)] = state
        hidden = np.tanh(states @ w["att"])
        weight = np.exp(hidden @ w["att_v"])
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        logits = pooled @ w["out"] + w["bias"][0]
        return (logits, (states, hidden, weight, pooled, saved)) if keep else logits

    def gradients(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, importance: np.ndarray):
        """Gradient of the weighted log loss by every weight but the vectors, and by the inputs ``x``."""
        w, h = self.weights, HIDDEN
        logits, (states, hidden, weight, pooled, saved) = self.run(self.project(x), ids, keep=True)
        d_logit = ((_sigmoid(logits) - labels) * importance / importance.sum()).astype(np.float32)
        grad = {"out": pooled.T @ d_logit, "bias": np.float32([d_logit.sum()])}
        d_pooled = d_logit[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnk,nk->tn", states, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["att_v"] = np.einsum("tna,tn->a", hidden, d_energy)
        d_hidden = d_energy[:, :, None] * w["att_v"] * (1 - hidden ** 2)
        grad["att"] = np.einsum("tnk,tna->ka", states, d_hidden)
        d_states += d_hidden @ w["att"].T
        d_gates = np.zeros((len(x), 6 * h), np.float32)
        for k, way in enumerate("fb"):
            u, d_u = w[f"state_{way}"], np.zeros_like(w[f"state_{way}"])
            d_next = np.zeros((len(ids), h), np.float32)
            for own, t, state, zr, new, s_new in reversed(saved):
                if own != way:
                    continue
                d = d_states[t, :, h * k:h * (k + 1)] + d_next
                z, r = zr[:, :h], zr[:, h:]
                d_new = d * (1 - z) * (1 - new ** 2)
                d_zr = np.concatenate([d * (state - new), d_new * s_new], axis=1) * zr * (1 - zr)
                d_s = np.concatenate([d_zr, d_new * r], axis=1)
                d_u += state.T @ d_s
                d_next = d * z + d_s @ u.T
                np.add.at(d_gates[:, 3 * h * k:3 * h * (k + 1)], ids[:, t], np.concatenate([d_zr, d_new], axis=1))
            part = d_gates[:, 3 * h * k:3 * h * (k + 1)]
            grad |= {f"state_{way}": d_u, f"in_{way}": x.T @ part, f"off_{way}": part.sum(axis=0)}
        return grad, d_gates[:, :3 * h] @ w["in_f"].T + d_gates[:, 3 * h:] @ w["in_b"].T


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.one, self.two, self.step = rate, {}, {}, 0

    def update(self, weights: dict[str, np.ndarray], grads: dict, rows: dict) -> None:
        self.step += 1
        for name, grad in grads.items():
            at = rows.get(name, slice(None))
            one = self.one.setdefault(name, np.zeros_like(weights[name]))
            two = self.two.setdefault(name, np.zeros_like(weights[name]))
            one[at] = 0.9 * one[at] + 0.1 * grad
            two[at] = 0.99 * two[at] + 0.01 * grad ** 2
            weights[name][at] -= self.rate * (one[at] / (1 - 0.9 ** self.step)) / (np.sqrt(two[at] / (1 - 0.99 ** self.step)) + 1e-6)


def _worst(model: Model, gates: np.ndarray, windows: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Of each text the window of the highest logit."""
    flat = [(d, w) for d, one in enumerate(windows) for w in one]
    logits = np.empty(len(flat), np.float32)
    by_length: dict[int, list[int]] = {}
    for i, (_, w) in enumerate(flat):
        by_length.setdefault(len(w), []).append(i)
    for places in by_length.values():
        for at in range(0, len(places), BLOCK):
            part = places[at:at + BLOCK]
            logits[part] = model.run(gates, np.stack([flat[i][1] for i in part]))
    best: dict[int, int] = {}
    for i, (d, _) in enumerate(flat):
        if d not in best or logits[i] > logits[best[d]]:
            best[d] = i
    return [flat[best[d]][1] for d in range(len(windows))]


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Model:
    """A model of labelled texts; deterministic."""
    met: dict[str, int] = {}
    rows, held = [], []
    for text, y in zip(texts, labels):
        words = words_of(text)  # only the numbers of a text's words are kept
        if words:
            ids = np.fromiter((met.setdefault(w, len(met)) for w in words), np.int32, len(words))
            held += [0] * (len(met) - len(held))
            for i in set(ids.tolist()):
                held[i] += 1
            rows.append((ids, y))
    positive = sum(y for _, y in rows)
    if not 0 < positive < len(rows):
        return Model({}, {}, positive / len(rows) if rows else 0.0)
    every = sorted(met)
    own = {w: i + 1 for i, w in enumerate(w for w in every if held[met[w]] >= LEAST_DOCS)}
    model, adam, rng = Model.fresh(own), _Adam(RATE), np.random.default_rng(SEED)
    row_of = np.array([own.get(w, 0) for w in every])
    place = np.empty(len(met), np.int32)
    place[[met[w] for w in every]] = np.arange(len(every))
    windows = [[ids[s:s + WINDOW] for s in window_starts(len(ids))] for ids in (place[one] for one, _ in rows)]
    truth = np.array([y for _, y in rows], np.float32)
    rows = len(rows)
    del met, held, place
    importance = np.where(truth > 0, (rows - positive) / positive, 1).astype(np.float32)
    for epoch in range(epochs):
        if epoch:
            picked = _worst(model, model.project(model.inputs(every)), windows)
        else:
            picked = [one[rng.integers(len(one))] for one in windows]
        adam.rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(picked))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            for length in {len(picked[i]) for i in part}:
                same = [i for i in part if len(picked[i]) == length]
                used, ids = np.unique(np.stack([picked[i] for i in same]), return_inverse=True)
                ids = ids.reshape(len(same), length)
                grad, d_x = model.gradients(model.inputs([every[i] for i in used]), ids, truth[same], importance[same])
                share = len(same) / len(part)
                known, at_word = np.unique(row_of[used], return_inverse=True)
                d_words = np.zeros((len(known), WIDTH), np.float32)
                np.add.at(d_words, at_word, d_x[:, :WIDTH])
                grams = [trigrams(every[i]) for i in used]
                flat = np.concatenate(grams)
                sizes = np.array([len(g) for g in grams])
                seen, at_gram = np.unique(flat, return_inverse=True)
                d_chars = np.zeros((len(seen), WIDTH), np.float32)
                np.add.at(d_chars, at_gram, np.repeat(d_x[:, WIDTH:] / sizes[:, None], sizes, axis=0))
                grad |= {"words": d_words + 1e-5 * model.weights["words"][known], "chars": d_chars}
                adam.update(model.weights, {k: g * share for k, g in grad.items()}, {"words": known, "chars": seen})
                model.weights["words"][0] = 0
    return model


class _Inputs(dict):
    """Place of a word's projected input in ``gates``, by the word."""

    def __init__(self, model: Model):
        self.model, self.new = model, []
        self.gates = np.zeros((0, 6 * HIDDEN), np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def settle(self) -> np.ndarray:
        if self.new:
            self.gates = np.concatenate([self.gates, self.model.project(self.model.inputs(self.new))])
            self.new = []
        return self.gates


def score_texts(model: Model, texts: list[str | None], inputs: _Inputs | None = None) -> np.ndarray:
    """Highest window score of each text."""
    if model.prior is not None:
        return np.full(len(texts), model.prior)
    inputs = _Inputs(model) if inputs is None else inputs
    if len(inputs) > CACHE_WORDS:
        inputs.clear()
        inputs.gates = inputs.gates[:0]
    logits = np.full(len(texts), -np.inf, np.float32)
    full, owners, short = [], [], {}
    for i, text in enumerate(texts):
        words = words_of(text)
        ids = np.fromiter(map(inputs.__getitem__, words), np.int32, len(words))
        if len(ids) >= WINDOW:
            starts = np.array(window_starts(len(ids)))
            full.append(np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[starts])
            owners.append(np.full(len(starts), i))
        elif len(ids):
            short.setdefault(len(ids), []).append((i, ids))
        else:
            logits[i] = model.weights["bias"][0]
    gates = inputs.settle()
    if full:
        every, owner = np.concatenate(full), np.concatenate(owners)
        for at in range(0, len(every), BLOCK):
            np.maximum.at(logits, owner[at:at + BLOCK], model.run(gates, every[at:at + BLOCK]))
    for some in short.values():
        logits[[i for i, _ in some]] = model.run(gates, np.stack([ids for _, ids in some]))
    return _sigmoid(logits.astype(np.float64))


def _score(model, text_name: str, at_once: int = 512):
    def kernel(batches):
        inputs = _Inputs(model.value)
        for b in batches:
            texts = struct_field(b.column("row"), text_name)
            parts = [score_texts(model.value, texts.slice(at, at_once).to_pylist(), inputs) for at in range(0, len(texts), at_once)]
            scores = np.round(np.concatenate(parts), 6) if parts else np.zeros(0)
            yield pa.record_batch([b.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])
    return kernel


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, chars: int = CHARS,
          doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on at most ``positives`` + ``negatives`` labelled rows that are not held out, of at most ``chars`` characters."""
    marks = (labels.select(F.col("doc_id").alias("doc"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
             .groupBy("doc").agg(F.max("y").alias("y")).filter(~held_out(F.col("doc"), 3, 1)))
    turn = F.xxhash64("doc")
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).filter(F.length("text") <= chars)
    texts, truth = [], []
    for y, most in ((1, positives), (0, negatives)):
        ids = marks.filter(F.col("y") == y).select("doc").orderBy(turn, "doc").limit(2 * most)
        some = rows.join(F.broadcast(ids), "doc").orderBy(turn, "doc", "text").limit(most).collect()  # the bound is a parameter
        texts += [r["text"] for r in some]
        truth += [y] * len(some)
    return fit(texts, truth)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score: 0 to 1, that of the worst window of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_columns(docs, _score(shared, text), [T.StructField("score", T.DoubleType())])


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without those whose score reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))
    inner = docs.select(F.struct("*").alias("row"))
    out = inner.mapInArrow(_score(shared, options.get("text", "text")), T.StructType([inner.schema["row"], T.StructField("score", T.DoubleType())]))
    return out.filter(F.col("score") < threshold).select("row.*")
