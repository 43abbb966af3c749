"""Toxicity by a convolutional text classifier in numpy.

A word is the sum of hashed embeddings of itself and of its first letters, so inflected forms
share what they have in common. Filters over one, two and three neighbouring words are
max-pooled over the whole text; a logistic layer on top gives the score. Training takes a
bounded sample of labelled rows; scoring runs in Arrow batches where the texts are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import column
from tidemark.llm.words import Index

# Labelled documents that are fitted, at most.
MAX_LABELLED = 4_000
BUCKETS = 1 << 16
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5)
EPOCHS = 4
BATCH = 32
CACHED = 200_000
CHUNK = 1 << 17
DECISION = 0.3

_WORD = re.compile(r"[^\W\d_]+")

# Frequent words by which the language of a text is guessed for calibration.
COMMON = {
    "en": "the of and to in is was that with for this are by on it".split(),
    "de": "der die und zu ein mit den das nicht von auf ist sich im für".split(),
    "es": "el los las por para con del una como que y se al lo".split(),
    "fr": "le les des et est dans du pour qui au une par sur pas avec".split(),
}
LANGUAGES = (*COMMON, "other")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def buckets(word: str) -> list[int]:
    """Hash buckets of the word and of its first letters."""
    parts = [word, *("^" + word[:n] for n in PREFIXES)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def guess(words: list[str]) -> int:
    """Index in LANGUAGES of the language whose frequent words the text has most of."""
    counts = dict.fromkeys(COMMON, 0)
    for language, common in _COMMON_SETS.items():
        counts[language] = sum(map(common.__contains__, words))
    best = max(counts, key=counts.get)
    return LANGUAGES.index(best if counts[best] else "other")


_COMMON_SETS = {k: set(v) for k, v in COMMON.items()}


@dataclass
class Model:
    """Embeddings, filters per width, their biases, output weights; thresholds by language."""

    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def start(cls, seed: int = 3) -> Model:
        rng = np.random.default_rng(seed)
        filters = [rng.normal(0, 0.3 / np.sqrt(k), (k, SIZE, FILTERS)).astype(np.float32) for k in WIDTHS]
        for f in filters:
            f[:, 0, :] = np.abs(f[:, 0, :]) / len(f)  # dimension 0 starts as evidence for toxicity
        return cls(
            rng.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32), filters,
            np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros(len(WIDTHS) * FILTERS + 1, np.float32),
            np.full(len(LANGUAGES), DECISION, np.float32),
        )


def _pad() -> int:
    return max(WIDTHS)


class Texts:
    """Words of texts one after the other, each text followed by empty words, so that no
    filter sees two texts at once."""

    def __init__(self, texts: list[np.ndarray]):
        self.ids = np.concatenate([np.concatenate([t, np.full(_pad(), -1, np.int64)]) for t in texts])
        sizes = np.array([len(t) + _pad() for t in texts])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes


def train(texts: list[str | None], labels: np.ndarray, seed: int = 3) -> Model:
    """Fit by Adam on the logistic loss; toxic texts weigh more, as they are few."""
    model = Model.start(seed)
    labels = np.asarray(labels, np.float32)
    if not len(texts):
        return model
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    model.weights[-1] = np.log(prior / (1 - prior))
    if labels.min() == labels.max():
        return model
    vocabulary: dict[str, int] = {}
    split = [words_of(t) for t in texts]
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], np.int64) for ws in split]
    parts = np.array([buckets(w) for w in vocabulary], np.int64).reshape(-1, 1 + len(PREFIXES))
    languages = np.array([guess(ws) for ws in split])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(docs))
    held = order[: len(docs) // 5]
    fitted = order[len(docs) // 5 :]
    _start_evidence(model, [docs[i] for i in fitted], labels[fitted], parts)
    model.weights[:-1] = 0.3
    weight = np.where(labels > 0, min(4.0, (1 - prior) / prior), 1.0).astype(np.float32)
    state = _Adam(model)
    for epoch in range(EPOCHS):
        rng.shuffle(fitted)
        for i in range(0, len(fitted), BATCH):
            chosen = fitted[i : i + BATCH]
            _step(model, state, Texts([docs[j] for j in chosen]), labels[chosen], weight[chosen], parts, 0.01 / (1 + epoch))
    vectors = model.embeddings[parts].sum(1)
    scores = np.concatenate([
        _scores(model, *_pooled(model, Texts([docs[j] for j in held[i : i + 256]]), vectors)[:1]) for i in range(0, len(held), 256)
    ])
    _calibrate(model, scores, labels[held], languages[held])
    return model


def _start_evidence(model: Model, docs: list[np.ndarray], labels: np.ndarray, parts: np.ndarray) -> None:
    """Dimension 0 of a bucket starts as the log odds of the texts that have it, smoothed."""
    n = np.zeros((2, BUCKETS), np.float32)
    for d, y in zip(docs, labels):
        n[int(y), np.unique(parts[np.unique(d)])] += 1
    toxic, clean = max(1.0, float(labels.sum())), max(1.0, float(len(labels) - labels.sum()))
    smooth = 4.0
    odds = np.log((n[1] / toxic + smooth / len(docs)) / (n[0] / clean + smooth / len(docs)))
    model.embeddings[:, 0] += 0.5 * np.clip(odds, -3, 5)


def _convolved(model: Model, texts: Texts, vectors: np.ndarray):
    x = np.where(texts.ids[:, None] >= 0, vectors[texts.ids], np.float32(0))
    for w, f in enumerate(model.filters):
        n = len(x) - len(f) + 1
        h = sum(x[j : j + n] @ f[j] for j in range(len(f))) + model.biases[w]
        yield w, h


def _pooled(model: Model, texts: Texts, vectors: np.ndarray):
    pooled = np.zeros((len(texts.starts), len(WIDTHS), FILTERS), np.float32)
    where = np.zeros((len(texts.starts), len(WIDTHS), FILTERS), np.int64)
    for w, h in _convolved(model, texts, vectors):
        for t, (a, b) in enumerate(zip(texts.starts, texts.ends)):
            best = h[a : min(b, len(h))].argmax(0)
            where[t, w] = a + best
            pooled[t, w] = np.maximum(h[a + best, np.arange(FILTERS)], 0)
    return pooled, where


def _logits(model: Model, pooled: np.ndarray) -> np.ndarray:
    z = pooled.reshape(len(pooled), -1).astype(np.float64) @ model.weights[:-1] + model.weights[-1]
    return np.clip(z, -30, 30)


def _scores(model: Model, pooled: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-_logits(model, pooled)))


class _Adam:
    def __init__(self, model: Model):
        self.step = 0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.of(model).items()}

    @staticmethod
    def of(model: Model) -> dict[str, np.ndarray]:
        return {"e": model.embeddings, "b": model.biases, "w": model.weights} | {f"f{i}": f for i, f in enumerate(model.filters)}

    def apply(self, model: Model, gradients: dict[str, np.ndarray], rate: float, rows: np.ndarray) -> None:
        self.step += 1
        for k, g in gradients.items():
            m, v = self.moments[k]
            at = rows if k == "e" else slice(None)  # only the embeddings that were used
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.99 * v[at] + 0.01 * g * g
            self.of(model)[k][at] -= rate * m[at] / (1 - 0.9**self.step) / (np.sqrt(v[at] / (1 - 0.99**self.step)) + 1e-6)


def _step(model, state, texts, labels, weight, parts, rate) -> None:
    used, inverse = np.unique(texts.ids[texts.ids >= 0], return_inverse=True)
    local = np.full(len(texts.ids), -1, np.int64)
    local[texts.ids >= 0] = inverse
    texts.ids = local
    own = parts[used] if len(used) else parts[:1]
    vectors = model.embeddings[own].sum(1)
    pooled, where = _pooled(model, texts, vectors)
    p = _scores(model, pooled)
    dz = ((p - labels) * weight / len(labels)).astype(np.float32)
    flat = pooled.reshape(len(pooled), -1)
    grads = {"w": np.append(flat.T @ dz, dz.sum()).astype(np.float32) + 1e-4 * model.weights}
    dh = (dz[:, None] * model.weights[:-1]).reshape(pooled.shape) * (pooled > 0)
    grads["b"] = dh.sum(0)
    dvec = np.zeros_like(vectors)
    for w, f in enumerate(model.filters):
        df = np.zeros_like(f)
        for j in range(len(f)):
            at = texts.ids[np.minimum(where[:, w, :] + j, len(texts.ids) - 1)]
            x = np.where(at[..., None] >= 0, vectors[at], 0)
            df[j] = np.einsum("tf,tfd->df", dh[:, w, :], x)
            g = dh[:, w, :, None] * f[j].T[None]
            np.add.at(dvec, at[at >= 0], g[at >= 0])
        grads[f"f{w}"] = df + 1e-4 * f
    rows, back = np.unique(own, return_inverse=True)
    de = np.zeros((len(rows), SIZE), np.float32)
    np.add.at(de, back.reshape(own.shape), dvec[:, None, :])
    grads["e"] = de
    state.apply(model, grads, rate, rows)


def _calibrate(model: Model, scores: np.ndarray, labels: np.ndarray, languages: np.ndarray) -> None:
    """The threshold with the best F1 on the texts set aside, by guessed language; languages
    with fewer than ten toxic ones take that of all."""

    def best(s: np.ndarray, y: np.ndarray) -> float:
        order = np.argsort(-s)
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(s) + 1) + y.sum())
        at = int(f1.argmax())
        below = s[order[at + 1]] if at + 1 < len(s) else 0.0
        return float(np.clip((s[order[at]] + below) / 2, 0.02, 0.98))

    if labels.sum() < 1:
        return
    model.thresholds[:] = best(scores, labels)
    for i in range(len(LANGUAGES)):
        at = languages == i
        if labels[at].sum() >= 10 and (labels[at] == 0).sum() >= 10:
            model.thresholds[i] = best(scores[at], labels[at])


class Scorer:
    """Scores of texts; words seen before are looked up. Long texts go in chunks, so memory
    does not grow with them."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.concatenate([f[j] for f in model.filters for j in range(len(f))], axis=1)
        self.clear()

    def clear(self) -> None:
        self.index = Index()
        self.rows = np.zeros((1024, self.table.shape[1]), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new = self.index.taken()
        if new:
            n = len(self.index)
            if n > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(n, len(self.rows)), self.rows.shape[1]), np.float32)])
            parts = np.array([buckets(w) for w in new], np.int64)
            self.rows[n - len(new) : n] = self.model.embeddings[parts].sum(1) @ self.table
        return ids

    def score(self, text: str | None) -> float:
        words = words_of(text)
        language = guess(words)
        best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        for i in range(0, max(1, len(words)), CHUNK):
            if len(self.index) > CACHED:
                self.clear()
            ids = self._ids(words[i : i + CHUNK + _pad()])
            rows = np.concatenate([self.rows[ids], np.zeros((_pad(), self.rows.shape[1]), np.float32)])
            at = 0
            for w, k in enumerate(WIDTHS):
                n = len(rows) - k + 1
                h = rows[:n, at : at + FILTERS]
                for j in range(1, k):
                    h = h + rows[j : j + n, at + j * FILTERS : at + (j + 1) * FILTERS]
                at += k * FILTERS
                best[w] = np.maximum(best[w], h.max(0))
        pooled = np.maximum(best + self.model.biases, 0)
        logit = float(_logits(self.model, pooled[None])[0])
        # Shifted so that the threshold of the language becomes the common decision.
        t = float(self.model.thresholds[language])
        z = logit - np.log(t / (1 - t)) + np.log(DECISION / (1 - DECISION))
        return float(1 / (1 + np.exp(-z)))


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
        max_labelled: int = MAX_LABELLED) -> Model:
    """A model of at most ``max_labelled`` labelled rows, drawn by the hash of their id.

    Rows without a label or id are left out; an id labelled twice counts as toxic if any
    label says so. Without labels, or with one kind only, every text gets the same score.
    """
    known = labels.where(column(label).isNotNull() & column(id_column).isNotNull())
    known = known.groupBy(column(id_column).alias("id")).agg(F.max(column(label)).alias("label"))
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = df.select(column(id_column).alias("id"), column(text).alias("text"))
    rows = texts.join(F.broadcast(drawn), "id")
    found = rows.dropDuplicates(["id"]).orderBy("id").toPandas()
    return train(found["text"].tolist(), found["label"].to_numpy(np.float32))


def score_toxicity(text: Column, model: Model) -> Column:
    """Scores of whole texts, 0 to 1, DECISION at the threshold of the language; null and
    empty texts get what a text without evidence gets."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return of(text)
