"""Held-out accuracy and odd cases of the two trained classifiers."""

import tracemalloc
import zlib

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity

SF = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_language_held_out(documents):
    known = [d for d in documents if d.lang and crc(d.doc_id) % 3 != 1]
    model = langid.train([d.text for d in known], [d.lang for d in known])
    rest = [d for d in documents if d.lang and crc(d.doc_id) % 3 == 1]
    tagger = langid.Tagger(model)
    found = tagger.marginals([langid.words_of(d.text) for d in rest])
    right = sum(model.languages[m.mean(0).argmax()] == d.lang for d, m in zip(rest, found) if len(m))
    assert right >= 0.97 * len(rest)
    # A text that switches: the words of each half get their own language.
    en = langid.words_of(next(d.text for d in rest if d.lang == "en"))[:40]
    de = langid.words_of(next(d.text for d in rest if d.lang == "de"))[:40]
    runs = langid.spans(tagger.marginals([en + de])[0], model.languages)
    assert sum(n for g, _, n in runs if g == "en") >= 30 and sum(n for g, _, n in runs if g == "de") >= 30
    assert sum(n for _, _, n in runs) == len(en) + len(de)


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.zeros((1, 3), np.float32), rng.normal(size=(3, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))
    scores = rng.normal(size=(2, 4, 3)).astype(np.float32)
    lengths = np.array([4, 2])
    got, moved = langid.forward_backward(scores, lengths, model, pairs=True)
    moves = np.zeros((3, 3))
    for t, n in enumerate(lengths):
        want, total = np.zeros((n, 3)), 0.0
        mine = np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            w = np.exp(model.start[path[0]] + sum(scores[t, i, p] for i, p in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, p in enumerate(path):
                want[i, p] += w
            for a, b in zip(path, path[1:]):
                mine[a, b] += w
        assert np.allclose(got[t, :n], want / total, atol=1e-5)
        moves += mine / total
    assert np.allclose(moved, moves, atol=1e-5)


def test_language_odd_texts(spark):
    df = odd.documents(spark, odd.TEXTS).withColumn("language", F.lit("x"))
    train = odd.documents(spark, ["the cat and the dog", "der hund und die katze"] * 5).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    out = {r.doc_id: r.language for r in langid.identify(df, langid.fit(train)).collect()}
    assert all((out[i].lang, out[i].score) == ("und", 0.0) for i in (0, 1, 2, 3, 10, 11))
    assert out[6].lang == "en" and 0 < out[6].score <= 1 and out[7] == out[8]
    blank = langid.fit(train.withColumn("lang", F.lit(None).cast("string")))
    assert {r.language.lang for r in langid.identify(df, blank).collect()} == {"und"}
    assert langid.identify(odd.empty(spark), langid.fit(odd.empty(spark))).count() == 0
    one = langid.fit(train.withColumn("lang", F.lit("en")))
    assert {r.language.lang for r in langid.identify(df, one).collect()} == {"und", "en"}


def test_language_features_cover_whole_words():
    """In scripts without spaces a clause is one word: nothing of it is passed over."""
    head = "ab" * 40
    assert langid.features(head + "xyz") != langid.features(head + "uvw")
    assert set(langid.features(head + "xyz")) >= {langid._bucket("xyz$"), langid._bucket("xyz"), langid._bucket("^abab")}
    assert len(langid.features("q" * 10_000)) == 9 + 9_998


def test_toxicity_held_out():
    """Toxic stems in new inflections, by language; clean texts stay below the decision."""
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("abcdefghijklm"), rng.integers(2, 8))) for _ in range(1500)]

    def text(y):
        words = [*rng.choice(plain, 80), *rng.choice(toxicity.COMMON["en"], 20)]
        for _ in range(3 * y):
            words[rng.integers(len(words))] = "qwzx" + "".join(rng.choice(list("abcd"), 3))
        return " ".join(words)

    labels = (rng.random(900) < 0.15).astype(int)
    texts = [text(y) for y in labels]
    model = toxicity.train(texts[:600], labels[:600])
    scorer = toxicity.Scorer(model)
    got = np.array([scorer.score(t) for t in texts[600:]]) >= toxicity.DECISION
    assert (got == labels[600:].astype(bool)).mean() > 0.97


def test_toxicity_odd_texts(spark):
    df = odd.documents(spark, odd.TEXTS + [odd.LONG * 3])
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        model = toxicity.fit(df, known)
        got = {r.doc_id: r.s for r in df.select("doc_id", toxicity.score_toxicity(F.col("text"), model).alias("s")).collect()}
        assert len(got) == len(odd.TEXTS) + 1 and all(0 <= s <= 1 for s in got.values())
        assert got[0] == got[1] == got[2] and got[7] == got[8]
        assert abs(got[6] - got[12]) < 1e-6  # the same words over and over


def test_training_holds_few_words_at_once():
    """The driver's memory beside the model stays near that of the features, and nothing of the
    words is kept after."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(w) for w in letters[rng.integers(0, 26, (20_000, 14))]]
    assert {len(langid.features(w)) for w in words} == {max(14 - 2, 0) + 9}
    assert [len(langid.features("a" * n)) for n in (1, 2, 3, 70)] == [9, 9, 10, 77]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    tracemalloc.start()
    try:
        langid.train(texts, [f"l{i % 8}" for i in range(len(texts))])
        most = tracemalloc.get_traced_memory()[1]
        print("most", most)
    finally:
        tracemalloc.stop()
    assert most < 60e6 and not langid._BUCKETS
