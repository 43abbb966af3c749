import re

import odd

from tidemark.llm import quality


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    covered = None
    if twice is not None:
        covered = len({i + k for i, w in enumerate(windows) if w in twice for k in range(5)})
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), covered


def test_against_brute_force(spark):
    texts = [*odd.TEXTS, "a b c d e a b c d e", "a a a a a a a", "one\none\n \n\ntwo\none", "x # y * $ % & | < > z",
             "b c d e f g h b c d e f", "a b c d", "a b c d e", "w " * 50 + "end"]
    df = odd.documents(spark, texts)
    rows = quality.rule_ledger(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        m = r.ledger
        want = brute(texts[r.doc_id])
        got = (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words)
        assert got[:4] == want[:4], r.doc_id
        if want[4] is not None:
            assert got[4] == want[4], r.doc_id


def test_policies_and_ablations(spark):
    good = "this is a plain text with more than ten words in it and nothing wrong at all"
    texts = ["few words", good, "w " * 50, " ".join("# $ % & * < > | # $ % &".split()) + " " + good[:20], None, good]
    ledger = quality.rule_ledger(odd.documents(spark, texts))
    kept = {r.doc_id: r.k for r in ledger.select("doc_id", quality.passes(ledger["ledger.failed"]).alias("k")).collect()}
    assert kept == {0: False, 1: True, 2: False, 3: False, 4: False, 5: True}
    failed = [r.failed for r in ledger.select("ledger.failed").collect()]
    for r in quality.ablations(ledger, ledger["ledger.failed"]).collect():
        mask, bit = quality.POLICIES[r.policy], quality.BIT[r.rule]
        assert r.n_documents == 6
        assert r.n_dropped == sum(f & mask != 0 for f in failed)
        assert r.n_failed == sum(f & bit != 0 for f in failed)
        assert r.n_only_this == sum(f & mask == bit for f in failed)


def test_empty_table(spark):
    ledger = quality.rule_ledger(odd.empty(spark))
    assert ledger.count() == 0
    assert {r.n_documents for r in quality.ablations(ledger, ledger["ledger.failed"]).collect()} == {0}
