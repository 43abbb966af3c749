import re

import odd
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import decontamination as D
from tidemark.llm.queries import QUERIES

ITEM = "A train leaves Boston at 60 km per hour with Alice on board, and Alice counts 12 bridges before noon."


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def find(spark, texts, *items):
    return {(r.doc_id, r.item_id): r for r in D.find_leaks(odd.documents(spark, texts), bench(spark, *items)).collect()}


def test_tokens_and_template_line_up(spark):
    texts = [ITEM, "Paid $5.20 or 7 kg (3%) to Mr Smith. Then, Jane left", "5km 6 km2 ½ x²", "日本語 テスト 12", "ÉTÉ d'Été à Paris", None, ""]
    df = odd.documents(spark, texts).select(D.tokens(F.col("text")).alias("a"), D.template(F.col("text")).alias("b"))
    for r in df.collect():
        assert len(r.a) == len(r.b)
    a = df.collect()[0]
    assert [x for x, y in zip(a.a, a.b) if y == D.NAME] == ["Boston", "Alice", "Alice"]
    assert [x for x, y in zip(a.a, a.b) if y == D.NUMBER] == ["60", "12"]
    assert [x for x, y in zip(a.a, a.b) if y == D.UNIT] == ["km"]


def test_long_runs_of_names_and_numbers(spark):
    """They are one token each; a matcher that calls itself per repeat overflows the stack."""
    texts = ["by " + " ".join(["Anna Lee"] * 20_000), "sum " + ",".join(["12"] * 40_000)]
    df = odd.documents(spark, texts, extra=False).select("doc_id", D.template(F.col("text")).alias("t"))
    assert {r.doc_id: r.t for r in df.collect()} == {0: ["by", D.NAME], 1: ["sum", D.NUMBER]}


def test_reparameterised_questions(spark):
    got = find(spark, [
        f"Some text before. {ITEM} And after.",
        ITEM.replace("Alice", "Carol").replace("60", "75").replace("12", "9"),
        ITEM.replace("Alice counts", "Carol counts"),  # one name stands for two
        "Nothing of the kind is in here, only words that no question has ever used before.",
        None, "", odd.LONG, ITEM + " " + ITEM.replace("Boston", "Denver"),
    ], ITEM, "", None)
    assert set(got) == {(0, 0), (1, 0), (7, 0)}
    assert got[0, 0].share == 1.0 and not got[0, 0].changed and got[0, 0].start == 3
    assert got[1, 0].changed and got[1, 0].n_slots == 5


QUESTION = "How many litres flow from the old well if the pump runs slowly until every basin is full again"


def test_losses_of_single_alignments(spark):
    """Inserted words, longer names, short items, numbers and scripts without spaces."""
    around = "Words of another kind stand before. {}, and others follow it here."
    words = QUESTION.split()
    inserted = " ".join(words[:5] + ["x"] + words[5:10] + ["y", "z"] + words[10:15] + ["w"] + words[15:])
    dropped = " ".join(words[:6] + words[7:])
    cases = [
        (QUESTION, around.format(QUESTION)),
        (QUESTION, around.format(inserted)),
        (QUESTION, around.format(dropped)),
        (ITEM, around.format(ITEM.replace("Alice", "Carol Jane Smith"))),
        ("which river crosses seven old bridges", around.format("which river crosses seven old bridges")),
        ("who wrote Hamlet", around.format("who wrote Hamlet")),
        ("5 apples cost 3 dollars and 7 pears cost 4 dollars", around.format("5 apples cost 3 dollars and 7 pears cost 4 dollars")),
        ("5 apples cost 3 dollars and 7 pears cost 4 dollars", around.format("6 apples cost 2 dollars and 9 pears cost 8 dollars")),
        ("1 2 4 8 16 32 64 128 256", around.format("1 2 4 8 16 32 64 128 256")),
        ("水的沸点是多少摄氏度", "今天天气很好我们去公园水的沸点是多少摄氏度然后再回家"),
        ("น้ำเดือดที่กี่องศา", "วันนี้อากาศดีน้ำเดือดที่กี่องศาแล้วกลับบ้าน"),
    ]
    texts = [c[1] for c in cases]
    got = find(spark, texts, *[c[0] for c in cases])
    for i, (item, text) in enumerate(cases):
        assert (i, i) in got, (item, text)
    same = {(i, j) for i in range(len(cases)) for j in range(len(cases)) if cases[i][0] == cases[j][0]}
    assert {k for k in got if k not in same} == set()
    assert got[7, 7].changed and got[3, 3].changed and not got[1, 1].changed


def test_what_is_no_leak(spark):
    got = find(spark, [
        "who wrote Macbeth and who wrote the other plays",  # part of a short item
        "1 2 4 9 16 33 64 129 256",  # numbers of another kind
        " ".join(QUESTION.split()[:9]),  # too little of a long item
        "yes it is",
    ], "who wrote Hamlet", "1 2 4 8 16 32 64 128 256", QUESTION, "yes")
    assert got == {}
    assert set(find(spark, ["yes", "Yes!", "yes it is"], "yes")) == {(0, 0), (1, 0)}


def test_against_brute_force_with_edits(spark):
    """Random items with words inserted and dropped, every covered token counted one by one."""
    import math
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [[word() for _ in range(rng.choice((4, 6, 9, 20, 40)))] for _ in range(12)]
    docs = []
    for k in range(60):
        body = list(items[k % 12])
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(body))
            if rng.random() < 0.5:
                body.insert(at, word())
            elif len(body) > 3:
                del body[at]
        docs.append([word() for _ in range(rng.randrange(20))] + body + [word() for _ in range(6)])
    want = set()
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n, w = len(item), min(len(item), 5)
            hits = [(a - b, b) for b in range(n - w + 1) for a in range(len(doc) - w + 1) if doc[a : a + w] == item[b : b + w]]
            need = min(n, math.ceil(7 + 0.3 * (n - 7)))
            chains, last = [], None
            for start, b in sorted(hits):
                if last is None or start - last > 5:
                    chains.append(set())
                chains[-1].update(range(b, b + w))
                last = start
            if any(len(c) >= need for c in chains):
                want.add((d, i))
    got = find(spark, [" ".join(d) for d in docs], *[" ".join(i) for i in items])
    assert set(got) == want and len(want) > 20


def test_repeats_nulls_and_empty(spark):
    df = odd.documents(spark, [ITEM, None, "x"])
    both = df.unionByName(df).unionByName(df.withColumn("doc_id", F.lit(None).cast("long")))
    rows = D.find_leaks(both, bench(spark, ITEM, ITEM)).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in rows) == [("0", 0), ("0", 1), ("None", 0), ("None", 1)]
    assert D.find_leaks(odd.empty(spark), bench(spark, ITEM)).count() == 0
    assert D.find_leaks(df, bench(spark, ITEM).limit(0)).count() == 0


def test_query_against_brute_force(spark):
    """Every document that holds most of an item word by word, and no other."""
    import re

    words = lambda t: re.findall(r"\w+", (t or "").lower())
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = set()
    for i, ws in items.items():
        windows = [tuple(ws[k : k + 8]) for k in range(max(1, len(ws) - 7))]
        for d, dw in docs.items():
            have = {tuple(dw[k : k + 8]) for k in range(max(1, len(dw) - 7))}
            if sum(w in have for w in windows) >= 0.5 * len(windows):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_template_decontamination"](spark, SF).collect()}
    assert got == want and want


def test_windows_leave_the_tokens_behind(spark):
    """What is made of each window must not hold all tokens of its text: a long text would be
    copied as many times as it has tokens."""
    df = odd.documents(spark, [ITEM, "x"])
    plan = D.find_leaks(df, bench(spark, ITEM, "who wrote Hamlet"))._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate explode" in line and "slotted" in line]
    left = [re.search(r"\), \[([\d, ]*)\], true, \[", line).group(1).split(",") for line in made]
    assert len(left) == 1 and len(left[0]) == 5  # all but the key
