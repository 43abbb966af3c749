from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).withColumnRenamed("extra", "position")
    return sorted((tuple(r[c] for c in ("conv_id", "position", "turn", "role", "text", "quote_levels", "reply_to", "anchor"))
                   for r in chat.link_quotes(df).collect()), key=lambda r: (str(r[0]), r[1]))


def brute(rows):
    """Turn -> (reply_to, anchor) per conversation, by looking through all earlier messages."""
    import re

    norm = lambda s: re.sub(r"\s+", " ", s.lower()).strip()
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        own, reply = {}, {}
        for _, turn, _, text in mine:
            lines, parts = [], []
            for line in (text or "").split("\n"):
                mark = re.match(r"\s*((?:>\s?)+)", line)
                level = mark[1].count(">") if mark else 0
                body = line[mark.end() :] if mark else line
                lines.append((level, body))
                if norm(body):
                    if parts and parts[-1][0] == level:
                        parts[-1][1].append(body)
                    else:
                        parts.append((level, [body]))
            text0 = "\n".join(b for lv, b in lines if lv == 0).strip()
            own[turn] = {norm(text0), *(norm(x) for x in text0.split("\n")), *(norm(x) for x in re.split(r"\n\s*\n", text0))} if text0 else set()
            best = None
            for i, (level, body) in enumerate([p for p in parts if p[0]]):
                for unit in {norm("\n".join(body)), *map(norm, body)}:
                    first = min((t for t in own if unit in own[t]), default=None)
                    if first is not None and first < turn:
                        best = min(best or (level, i, -len(unit), first), (level, i, -len(unit), first))
            reply[turn] = best[3] if best else None
        for turn in reply:
            anchor = turn
            while reply[anchor] is not None:
                anchor = reply[anchor]
            out[conv, turn] = (reply[turn], anchor)
    return out


ROWS = [
    (1, 0, "user", "How do I sort a list?\nIt has many items."),
    (1, 1, "assistant", "Use sorted().\n\nIt returns a new list."),
    (1, 2, "user", "Unrelated question, please."),
    (1, 3, "user", "> Use sorted().\n\nAnd in place?"),
    (1, 4, "assistant", ">> Use  SORTED().\n> And in place?\nlist.sort() does that."),
    (1, 5, "user", "> nobody ever said this\nThanks"),
    (1, 6, "user", "> How do I sort a list?\n> It has many items.\nMe too"),
    (2, 0, "user", "> Use sorted().\nother conversation"),
    (3, 0, "user", None), (3, 1, "user", ""), (3, 2, "user", ">"), (3, 3, "user", "> > \n>"),
]


def test_links_and_order(spark):
    got = run(spark, ROWS)
    want = brute(ROWS)
    assert {(r[0], r[2]): (r[6], r[7]) for r in got} == want
    assert [r[2] for r in got if r[0] == 1] == [0, 6, 1, 3, 4, 2, 5]
    assert [r[1] for r in got if r[0] == 1] == list(range(7))
    texts = {r[2]: r[4] for r in got if r[0] == 1}
    assert texts[4] == "list.sort() does that." and texts[3] == "And in place?"
    assert {r[2]: r[5] for r in got if r[0] == 1}[4] == 2


def test_long_chain_and_hot_conversation(spark):
    """Each message quotes the one before: one chain, whose anchor is its beginning."""
    rows = [(9, 0, "user", "message 0")]
    rows += [(9, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(1, 150)]
    rows += [(9, 200 + i, "user", "> message 0\nsame reply") for i in range(50)]
    got = run(spark, rows)
    assert [r[1] for r in got] == list(range(200))
    assert {r[7] for r in got} == {0} and [r[2] for r in got] == sorted(r[1] for r in rows)
    assert {(r[0], r[2]): (r[6], r[7]) for r in got} == brute(rows)


def test_repeats_nulls_and_empty(spark):
    rows = [(1, 0, "user", "hello there"), (1, 0, "user", "hello there"), (None, 0, "user", "> hello there"), (1, None, "user", "no turn"),
            (1, 1, "user", "> hello there\nhi")]
    got = run(spark, rows)
    assert len(got) == 5 and sorted(r[1] for r in got if r[0] == 1) == [0, 1, 2, 3]
    assert [r[6] for r in got if r[2] == 1] == [0]
    assert run(spark, ROWS[:0]) == []
