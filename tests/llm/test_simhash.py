import random
from itertools import combinations

import numpy as np
import odd
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import simhash
from tidemark.llm.components import components, joined_components
from tidemark.llm.queries import QUERIES


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, radius):
    """id -> smallest id that links reach."""
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_query_against_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: fingerprint(t) for i, t in texts.items()}
    want = groups(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_near_dedup"](spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("radius", [2, 4])
def test_links_of_a_dense_cloud(spark, radius):
    """Chains and crowds: many fingerprints a few bits from each other."""
    rng = random.Random(radius)
    values = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(60):
            values.add(at)
            for _ in range(rng.choice([1, 2, 5])):
                at ^= 1 << rng.randrange(64)
    fps = {np.uint64(v).astype(np.int64).item(): v for v in values}
    want = groups(fps, radius)
    df = spark.createDataFrame([(i,) for i in fps], "fp long")
    found = components(simhash.links(df, radius))
    label = {r.node: r.label for r in found.collect()}
    same = {}
    for i, g in want.items():
        same.setdefault(g, set()).add(label.get(i, i))
    assert all(len(x) == 1 for x in same.values()) and len({next(iter(x)) for x in same.values()}) == len(same)


def test_odd_radius():
    with pytest.raises(ValueError):
        simhash.links(None, 3)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_that_come_later_join_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    whole = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    labels = components(spark.createDataFrame(edges[:150], "a long, b long"))
    later = [(a, b) for a, b in edges[150:] if a != b]
    got = joined_components(labels, spark.createDataFrame(later, "a long, b long"))
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.label for r in got.collect() if r.node not in alone} == {k: v for k, v in whole.items() if k not in alone}
    nothing = joined_components(labels, spark.createDataFrame([], "a long, b long"))
    assert sorted(nothing.collect()) == sorted(labels.collect())


def test_odd_texts(spark):
    df = odd.documents(spark, odd.TEXTS)
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    assert len(got) == len(odd.TEXTS)
    assert got[0].fp == got[2].fp == 0 and got[3].component == 0 and got[8].component == 7
    assert all(got[i].fp & (1 << 64) - 1 == fingerprint(t) for i, t in enumerate(odd.TEXTS))
    assert simhash.near_duplicates(odd.empty(spark)).count() == 0


def jaccard(a, b, n=5):
    a, b = ({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in ((a or "").lower().split(), (b or "").lower().split()))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_copies(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    texts = []
    for _ in range(40):
        base = rng.choices(vocabulary, k=rng.randint(60, 400))
        texts.append(" ".join(base))
        for _ in range(3):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    texts += [None, "", "short one", "short two"]
    df = odd.documents(spark, texts).withColumn("text", F.col("text"))
    kept = sorted(r.doc_id for r in simhash.drop_near_copies(df).collect())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if jaccard(texts[a], texts[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert kept == [i for i in range(len(texts)) if find(i) == i]


def test_near_copies_repeats_and_columns(spark):
    df = odd.documents(spark, odd.TEXTS)
    twice = df.unionByName(df).unionByName(df.withColumn("doc_id", F.lit(None).cast("long")))
    out = simhash.drop_near_copies(twice)
    assert out.columns == df.columns
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted({r.doc_id for r in simhash.drop_near_copies(df).collect()})
    assert simhash.drop_near_copies(odd.empty(spark)).count() == 0


def kept_by_brute_force(texts):
    """Positions of the first of each group that chains of pairs at 0.8 or more connect."""
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if jaccard(texts[a], texts[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [i for i in range(len(texts)) if find(i) == i]


def test_near_copies_with_another_tail_or_block(spark):
    """Many words differ, yet four fifths of the shingles are the same."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(5000)]
    texts = []
    for n in (30, 100, 100, 300, 1000) * 4:
        base = rng.choices(vocabulary, k=n)
        texts.append(" ".join(base))
        k = max(2, n // 11)
        texts.append(" ".join([*base[:-k], *rng.choices(vocabulary, k=k)]))
        at = rng.randrange(n - k)
        texts.append(" ".join([*base[:at], *rng.choices(vocabulary, k=max(1, k - 5)), *base[at + max(1, k - 5) :]]))
    want = kept_by_brute_force(texts)
    assert len(want) < len(texts) - 25
    assert sorted(r.doc_id for r in simhash.drop_near_copies(odd.documents(spark, texts)).collect()) == want


def test_near_copies_in_a_crowd_over_one_vocabulary(spark):
    """Texts with the same word set: copies far from each other are found, likeness of 0.6 to
    0.8 between neighbours links none."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    rows = [[*words, *rng.choices(words, k=88)] for _ in range(30)]
    texts = [" ".join(r) for r in rows]
    texts += [" ".join([*r[:-2], "w0", "w1"]) for r in rows]  # 30 rows after what it is a copy of
    page = [*words, *rng.choices(words, k=88)]
    others = {i: iter([w for w in words if w != page[i]]) for i in range(5, 100, 10)}
    for at in list(combinations(others, 2))[:30]:  # two words of their own: alike by 0.65 to 0.75
        texts.append(" ".join(next(others[i]) if i in at else w for i, w in enumerate(page)))
    want = kept_by_brute_force(texts)
    assert all(i not in want for i in range(30, 60)) and sum(i >= 60 for i in want) == 30
    assert sorted(r.doc_id for r in simhash.drop_near_copies(odd.documents(spark, texts)).collect()) == want


def test_near_copies_come_by_their_fingerprints(spark, monkeypatch):
    """With nothing but the fingerprints, texts that differ in one of many words still meet."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:399] + ["other"]), " ".join(f"v{i}" for i in range(400)), "", " "]
    df = odd.documents(spark, texts, extra=False)
    empty = "token long, k1 long, n int, rest int, m long"
    monkeypatch.setattr(simhash, "_meetings", lambda *_: spark.createDataFrame([], empty))
    assert {r.doc_id for r in simhash.drop_near_copies(df).collect()} == {0, 2, 3}


def test_sketches_never_tell_alike_sets_apart(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    texts = ["", "one", "one two"]
    for n in (6, 40, 63, 65, 130, 700):
        base = rng.choices(words, k=n)
        for k in range(0, n, max(1, n // 12)):
            texts.append(" ".join([*base[: n - k], *rng.choices(words, k=rng.choice([k, k + 3]))]))
    rows = odd.documents(spark, texts, extra=False).select("doc_id", simhash.sketches(F.col("text")).alias("x")).select("doc_id", "x.*")
    other = rows.select(*[F.col(c).alias(f"other_{c}") for c in rows.columns])
    allowed = {(r.doc_id, r.other_doc_id) for r in rows.crossJoin(other).where(simhash._sketches_allow(0.8, "other_")).collect()}
    pairs = [(a, b) for a in range(len(texts)) for b in range(len(texts))]
    alike = {(a, b) for a, b in pairs if jaccard(texts[a], texts[b]) >= 0.8}
    assert alike <= allowed and len(allowed) < 2 * len(alike)


def test_only_pairs_that_sketches_allow_are_compared_by_their_sets(spark, monkeypatch):
    """A crowd whose members are alike by 0.6 to 0.75: all pairs of it meet, none is stored."""
    rng = random.Random(12)
    page = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(48):
        own = list(page)
        for at in rng.sample(range(4, 96), 3):
            own[at] = f"v{i}"
        texts.append(" ".join(own))
    want = kept_by_brute_force(texts)
    stored, call = [], simhash.Scratch.__call__

    def counted(self, df):
        out = call(self, df)
        if out.columns[:2] == ["a", "b"]:
            stored.append(out.count())
        return out

    monkeypatch.setattr(simhash.Scratch, "__call__", counted)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(odd.documents(spark, texts)).collect()) == want
    assert len(want) > 40 and max(stored) < 400, stored


def test_links_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """Copies of one page, each edited in a few places: most pairs are alike or nearly so, few of
    them are compared by their sets."""
    rng = random.Random(13)
    page = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        own = list(page)
        for _ in range(rng.choice([1, 2, 2, 3, 3, 4])):
            own[rng.randrange(len(own))] = f"v{rng.randrange(100000)}"
        texts.append(" ".join(own))
    want = kept_by_brute_force(texts)
    links, call = [], simhash._alike

    def counted(*args):
        out = call(*args)
        links.append(out.count())
        return out

    monkeypatch.setattr(simhash, "_alike", counted)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(odd.documents(spark, texts, extra=False)).collect()) == want
    assert sum(links) < 4 * len(texts), links
