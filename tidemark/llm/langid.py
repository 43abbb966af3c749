"""Language ID of words by a linear-chain conditional random field.

A word has features of its affixes, of the letter groups inside it, and of itself as an entry
of a hashed lexicon; each has a learned weight per language, and so has every transition from
one word's language to the next one's. Forward-backward gives the language of each word in
its context, also where a text switches; the languages of a text's words give its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import column
from tidemark.llm.words import Index

# Documents that are fitted, at most.
MAX_LABELLED = 3_000
BUCKETS = 1 << 17
SEGMENT = 64
EPOCHS = 3
BATCH = 64
CACHED = 200_000
CELLS = 1 << 19
TOGETHER = 1024
# Words, and segments of texts, that training looks at together.
TRAINED = 4096

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _bucket(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) % BUCKETS


class _Buckets(dict):
    """Buckets of letter groups; there are few different ones, so most are looked up."""

    def __missing__(self, part: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[part] = found = _bucket(part)
        return found


_BUCKETS = _Buckets()


def features(word: str) -> list[int]:
    """Hash buckets of the word, its first and last letters, and the groups of three inside, of
    the whole word however long it is."""
    n = len(word)
    known = _BUCKETS.__getitem__
    parts = ["^" + word[:1], "^" + word[:2], "^" + word[:3], "^" + word[:4]]
    parts += [word[-1:] + "$", word[-2:] + "$", word[-3:] + "$", word[-4:] + "$"]
    parts += [word[i : i + 3] for i in range(n - 2)]
    return [_bucket("=" + word), *map(known, parts)]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket, language
    transitions: np.ndarray  # from, to
    start: np.ndarray


def forward_backward(scores: np.ndarray, lengths: np.ndarray, model: Model, pairs: bool = False):
    """Marginals of texts (text, word, language), and if asked the expected transitions.

    All texts take a step together; those that have ended keep their state.
    """
    n, longest, k = scores.shape
    peak = scores.max(2, keepdims=True)
    emit = np.exp(scores - peak)
    move = np.exp(model.transitions)
    alpha = np.empty((longest, n, k), np.float32)
    live = np.arange(longest)[:, None] < lengths[None, :]
    a = np.exp(model.start)[None] * emit[:, 0]
    alpha[0] = a / a.sum(1, keepdims=True)
    for t in range(1, longest):
        a = (alpha[t - 1] @ move) * emit[:, t]
        a /= a.sum(1, keepdims=True)
        alpha[t] = np.where(live[t][:, None], a, alpha[t - 1])
    beta = np.full((n, k), 1.0 / k, np.float32)
    gamma = np.empty((n, longest, k), np.float32)
    moved = np.zeros((k, k), np.float64)
    gamma[:, -1] = alpha[-1] * beta
    for t in range(longest - 2, -1, -1):
        ahead = emit[:, t + 1] * beta
        on = live[t + 1][:, None]
        if pairs:
            joint = alpha[t][:, :, None] * move[None] * ahead[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            moved += (joint * on[:, :, None]).sum(0)
        b = ahead @ move.T
        b /= b.sum(1, keepdims=True)
        beta = np.where(on, b, beta)
        gamma[:, t] = alpha[t] * beta
    gamma /= gamma.sum(2, keepdims=True)
    return (gamma, moved) if pairs else gamma


def train(texts: list[str | None], langs: list[str], seed: int = 5) -> Model:
    """Fit from texts with one language each.

    First each word by itself takes the language of its text. As texts switch, words are then
    labelled anew by forward-backward, held to the language of the text where the words do
    not speak against it, and the whole field is fitted to those labels, transitions too.
    """
    languages = sorted(set(langs))
    k = len(languages)
    model = Model(languages, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if k < 2:
        return model
    vocabulary: dict[str, int] = {}
    segments, owner = [], []
    for t, g in zip(texts, langs):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)]
        for i in range(0, len(ids), SEGMENT):
            segments.append(np.array(ids[i : i + SEGMENT], np.int64))
            owner.append(languages.index(g))
    if not segments:
        return model
    flat = np.fromiter(chain.from_iterable(map(features, vocabulary)), np.int64)
    sizes = np.array([max(len(w) - 2, 0) + 9 for w in vocabulary])  # as many as features gives
    words = len(vocabulary)
    vocabulary.clear()
    _BUCKETS.clear()
    begins = np.cumsum(sizes) - sizes
    owner_of = np.array(owner)
    lengths = np.array([len(s) for s in segments])
    table = np.zeros((len(segments), SEGMENT), np.int64)
    for i, s in enumerate(segments):
        table[i, : len(s)] = s
    mask = np.arange(SEGMENT)[None] < lengths[:, None]

    # Words by themselves: how often each feature stands in texts of each language.
    counts = np.zeros((words, k), np.float64)
    np.add.at(counts, (table[mask], np.repeat(owner_of, lengths)), 1)
    prior = counts.sum(0) + 1.0
    by_feature = np.zeros((BUCKETS, k), np.float64)
    for i in range(0, words, TRAINED):
        some = slice(begins[i], begins[i] + sizes[i : i + TRAINED].sum())
        np.add.at(by_feature, flat[some], np.repeat(np.sqrt(counts[i : i + TRAINED]), sizes[i : i + TRAINED], axis=0))
    share = (by_feature + 0.5 * prior / prior.sum()) / (by_feature.sum(1, keepdims=True) + 0.5)
    model.weights[:] = 0.35 * (np.log(share) - np.log(prior / prior.sum()))
    rng = np.random.default_rng(seed)
    model.transitions[:] = np.log(np.where(np.eye(k), 0.95, 0.05 / (k - 1)))
    for epoch in range(EPOCHS):
        emissions = np.empty((words, k), np.float32)
        for i in range(0, words, TRAINED):
            some = slice(begins[i], begins[i] + sizes[i : i + TRAINED].sum())
            emissions[i : i + TRAINED] = _emissions(model, flat[some], begins[i : i + TRAINED] - begins[i])
        target = np.empty((len(segments), SEGMENT, k), np.float32)
        expected = np.zeros((k, k))
        for i in range(0, len(segments), TRAINED):
            s = emissions[table[i : i + TRAINED]]
            s = s + 0.5 * np.eye(k, dtype=np.float32)[owner_of[i : i + TRAINED]][:, None, :]
            gamma, moved = forward_backward(s, lengths[i : i + TRAINED], model, pairs=True)
            target[i : i + TRAINED] = gamma
            expected += moved
        rate = 0.1 / (1 + epoch)
        squares = np.full((BUCKETS, k), 1e-3, np.float32)
        order = rng.permutation(len(segments))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            used, inverse = np.unique(table[at][mask[at]], return_inverse=True)
            local = np.zeros((len(at), SEGMENT), np.int64)
            local[mask[at]] = inverse
            spans = [flat[begins[w] : begins[w] + sizes[w]] for w in used]
            rows = np.concatenate(spans)
            where = np.cumsum([0, *map(len, spans[:-1])])
            scores = np.add.reduceat(model.weights[rows], where, axis=0)[local]
            gamma = forward_backward(scores, lengths[at], model)
            error = (gamma - target[at])[mask[at]]
            by_word = np.zeros((len(used), k), np.float32)
            np.add.at(by_word, inverse, error)
            repeated = np.repeat(by_word, [len(s) for s in spans], axis=0)
            buckets, back = np.unique(rows, return_inverse=True)
            g = np.zeros((len(buckets), k), np.float32)
            np.add.at(g, back, repeated)
            squares[buckets] += g * g
            model.weights[buckets] -= rate * g / np.sqrt(squares[buckets])
        # Transitions that make the expected moves of the field those of the labels.
        moves = expected + 1.0
        model.transitions[:] = np.log(moves / moves.sum(1, keepdims=True))
        first = target[:, 0].sum(0) + 1.0
        model.start[:] = np.log(first / first.sum())
    return model


def _emissions(model: Model, flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(model.weights[flat], begins, axis=0)


class Tagger:
    """Marginals of the words of texts; words seen before are looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index = Index()
        self.rows = np.zeros((1024, len(self.model.languages)), np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self.index) > CACHED:
            self.clear()
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new = self.index.taken()
        if new:
            n = len(self.index)
            if n > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(n, len(self.rows)), self.rows.shape[1]), np.float32)])
            lists = [features(w) for w in new]
            flat = np.fromiter(chain.from_iterable(lists), np.int64)
            begins = np.cumsum([0, *map(len, lists[:-1])])
            self.rows[n - len(new) : n] = _emissions(self.model, flat, begins)
        return self.rows[ids]

    def marginals(self, texts: Iterable[list[str]]) -> list[np.ndarray]:
        """Per text the marginals of its words; texts of like length go together.

        Words become scores text by text, so only one text at a time is held as words.
        """
        scored = [self.scores(t) for t in texts]
        out: list[np.ndarray] = [np.zeros((0, len(self.model.languages)), np.float32)] * len(scored)
        order = sorted((i for i, s in enumerate(scored) if len(s)), key=lambda i: len(scored[i]))
        while order:
            longest = len(scored[order[-1]])
            take = max(1, CELLS // longest)
            group, order = order[-take:], order[:-take]
            lengths = np.array([len(scored[i]) for i in group])
            scores = np.zeros((len(group), longest, len(self.model.languages)), np.float32)
            for r, i in enumerate(group):
                scores[r, : lengths[r]] = scored[i]
            gamma = forward_backward(scores, lengths, self.model)
            for r, i in enumerate(group):
                out[i] = gamma[r, : lengths[r]].copy()
        return out


def spans(marginals: np.ndarray, languages: list[str]) -> list[tuple[str, int, int]]:
    """Runs of words of one language: (language, first word, number of words)."""
    if not len(marginals):
        return []
    best = marginals.argmax(1)
    edges = np.flatnonzero(np.diff(best, prepend=-1))
    return [(languages[best[a]], int(a), int(b - a)) for a, b in zip(edges, [*edges[1:], len(best)])]


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", max_labelled: int = MAX_LABELLED) -> Model:
    """A model of at most ``max_labelled`` rows with a language, drawn by the hash of text and
    id. Without any, every text is of unknown language."""
    rows = df.where(column(lang).isNotNull() & column(text).isNotNull()).select(
        column(text).alias("text"), column(lang).alias("lang"), F.xxhash64(column(id_column), column(text)).alias("drawn")
    )
    # Whole texts are fetched only for the rows that are drawn.
    edge = rows.select("drawn").orderBy("drawn").limit(max_labelled).agg(F.max("drawn")).first()[0]
    if edge is None:
        return train([], [])
    found = rows.where(F.col("drawn") <= edge).orderBy("drawn").limit(max_labelled).toPandas()
    return train(found["text"].tolist(), found["lang"].tolist())


UNKNOWN = "und"


def identify(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out`` (an input column of that name is replaced):
    ``lang``, ``score`` (share of the text's words, by their marginals), ``spans`` (array of
    language, first word, number of words; words are runs of letters).

    Null texts and texts without a letter are ``und`` with score 0 and no spans; so is every
    text if the model knows no language. Repeated rows are judged alike.
    """
    schema = "lang string, score double, spans array<struct<lang:string,first:int,words:int>>"

    @F.pandas_udf(schema)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        for texts in batches:
            found = []
            for i in range(0, len(texts), TOGETHER):
                some = texts.iloc[i : i + TOGETHER]
                for m in tagger.marginals(words_of(t) if model.languages else [] for t in some):
                    if not len(m):
                        found.append((UNKNOWN, 0.0, []))
                        continue
                    share = m.mean(0, dtype=np.float64)
                    best = int(share.argmax())
                    runs = [{"lang": g, "first": a, "words": n} for g, a, n in spans(m, model.languages)]
                    found.append((model.languages[best], float(min(1.0, share[best])), runs))
            yield pd.DataFrame(found, columns=["lang", "score", "spans"])

    return df.withColumn(out, of(column(text)))
