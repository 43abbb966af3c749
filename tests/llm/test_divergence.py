import random
import re
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest

from tidemark.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least_docs, top=D.TOP):
    """(text, lang, source) rows -> set of result rows."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(lower(text))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        total = lambda c: sum(c[t] for t in kept)
        p = lambda c, t: 1 + D.SCALE * (c[t] + 5) // (total(c) + 5 * len(kept))
        own, whole = counts[lang, source], sum((counts[g] for g in groups if g[0] == lang), Counter())
        pairs = [(sum(abs(p(own, t) - p(counts[lang, s], t)) for t in kept), s) for g, s in groups if g == lang and s != source]
        terms = [(p(own, t) - p(whole, t), t) for t in kept if own[t] and p(own, t) > p(whole, t)]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def result(df, **options):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in D.source_divergence(df, **options).collect())


def words(rng):
    """Words of every packed length, with upper case, other scripts and one beyond 16 bytes."""
    some = ["a", "Ab", "abc", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "x" * 300, "ñandú", "日本語", "🙂", "É", "é"]
    return [rng.choice(some) for _ in range(rng.randrange(0, 30))]


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        source = "hot" if rng.random() < 0.4 else rng.choice(["s1", "s2", None, ""])
        rows.append((rng.choice([" ", "_", "@", "1", "\n"]).join(words(rng)) or None, rng.choice(["en", "de", None]), source))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, term int, n string")
    assert result(df, least_docs=10) == brute(rows, 10)
    assert result(df, least_docs=10, top=2) == brute(rows, 10, 2)
    assert result(df, least_docs=10_000) == brute(rows, 10_000)  # no term is kept


def test_odd_texts(spark):
    df = odd.documents(spark, odd.TEXTS)
    rows = [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert result(df, least_docs=1) == brute(rows, 1)
    assert result(odd.empty(spark)) == []


@pytest.mark.parametrize("slice_bytes", [1, 50, 1 << 20])
def test_counts_do_not_depend_on_slices(slice_bytes, monkeypatch):
    monkeypatch.setattr(D, "SLICE_BYTES", slice_bytes)
    rng = random.Random(slice_bytes)
    texts = [" ".join(words(rng)) for _ in range(40)] + ["", "tail"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    n, docs = Counter(), Counter()
    for first, last in D._slices(offsets):
        part = offsets[first : last + 1]
        found = D.count_terms(data[part[0] : part[-1]], part - part[0], np.arange(first, last) % 2)
        for g, s, l, k, d in zip(*[x.tolist() for x in found[:5]]):
            key = g, bytes(found[5][s : s + l])
            n[key] += k
            docs[key] += d
    want, spread = Counter(), Counter()
    for i, t in enumerate(texts):
        terms = [w.encode() for w in TERM.findall(lower(t))]
        want.update((i % 2, w) for w in terms)
        spread.update({(i % 2, w) for w in terms})
    assert n == want and docs == spread


def test_radix_order_is_the_stable_order():
    rng = np.random.default_rng(3)
    high, low = rng.integers(0, 5, 1000).astype(np.uint16), rng.integers(0, 1 << 16, 1000).astype(np.uint16)
    assert (D.radix_order([high, low]) == np.lexsort((np.arange(1000), low, high))).all()


def test_shares_beyond_64_bits(spark):
    n, total, kept = 9 * 10**15, 10**17, 10**6
    row = spark.range(1).select(D.share(*[D.F.lit(x).cast("bigint") for x in (n, total, kept)]).alias("p")).first()
    assert row["p"] == 1 + D.SCALE * (n + 5) // (total + 5 * kept)
