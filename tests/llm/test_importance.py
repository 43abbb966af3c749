import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import odd

from tidemark.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def brute(rows, target, percent=10, buckets=I.BUCKETS, longest=1, least_words=20):
    of = lambda text: [zlib.crc32(f.encode()) % buckets for f in features(text, longest)[0]]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(of(text))
    for text in target:
        t.update(of(text))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets))))
    out = []
    for doc, text in rows:
        h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, of(text)))
        out.append([doc, len(of(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), features(text)[1]])
    may = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(may[: percent * len(may) // 100])}
    return sorted(tuple(r[:4]) + (rank.get(id(r)),) for r in out)


def result(df, target, **options):
    return sorted(map(tuple, I.resample(df, target, **options).collect()))


def corpus(n):
    rng = random.Random(n)
    pool = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "🙂", "MIXED"]
    return [(i, " ".join(rng.choices(pool, k=rng.choice([0, 5, 19, 20, 21, 60])))) for i in range(n)]


def test_against_brute_force(spark):
    rows = corpus(400)
    target = ["w1 w2 w3 w1 w1", None, "", "MIXED ünï w59"]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n string, id int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert result(df, goal) == brute(rows, target)
    assert result(df, goal, percent=100, longest=2, buckets=97) == brute(rows, target, 100, 97, 2)
    assert result(df, goal, percent=0) == brute(rows, target, 0)


def test_odd_texts_ids_and_tables(spark):
    df = odd.documents(spark, odd.TEXTS)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    none = spark.createDataFrame([], "text string")
    assert result(df, none, percent=50) == brute(rows, [], 50)
    assert result(odd.empty(spark), none) == []
    twice = df.unionByName(df).withColumn("doc_id", I.F.when(I.F.col("doc_id") > 3, I.F.col("doc_id")))
    ranks = [r["rank"] for r in I.resample(twice, none, percent=100).collect() if r["rank"]]
    assert sorted(ranks) == list(range(1, len(ranks) + 1)) and len(ranks) == 2 * sum(features(t)[1] >= 20 for _, t in rows)


def test_planes_give_the_exact_sum():
    rng = np.random.default_rng(1)
    for width, top in ((1, 3), (64, 1), (100, 10**6), (1000, 40)):
        values = rng.integers(-top, top + 1, width)
        documents = []
        for n in (0, 1, width, 50 * width):
            at, counts = np.unique(rng.integers(0, width, n), return_counts=True)
            documents.append((at, counts))
        assert I.GainPlanes(values).weights(documents).tolist() == [int((values[a] * c).sum()) for a, c in documents]
    assert I.GainPlanes(np.zeros(5, np.int64)).weights([(np.array([1]), np.array([7]))]).tolist() == [0]
    assert I.GainPlanes(np.array([-8, 7])).weights([]).tolist() == []
