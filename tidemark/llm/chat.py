"""Quotation linking: conversations in reply order, without what they quote.

A message is its own lines and passages of quoted lines, each at a level of nesting. The
normalised text of a quoted passage is hashed and joined to the messages of the conversation
that hold the same passage as their own text. A message replies to the one it quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, stored

MARKS = r"^\s*((?:>\s?)+)"


def lines_of(text: Column) -> Column:
    """Array of (level, text): how many quote marks a line begins with, and what follows."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1),
        lambda x: F.struct(
            (F.length(F.regexp_extract(x, MARKS, 1)) - F.length(F.translate(F.regexp_extract(x, MARKS, 1), ">", ""))).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("text"),
        ),
    )


def normalised(text: Column) -> Column:
    """Lower case, every run of white space one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(lines: Column) -> Column:
    """Array of (level, text): neighbouring lines of one level joined, blank ones dropped.

    Lines are folded into a text with one mark per level, which then is cut where the level
    changes: no step copies what was gathered before.
    """
    solid = F.filter(lines, lambda x: normalised(x["text"]) != "")
    marked = F.transform(
        solid,
        lambda x, i: F.concat(
            F.when((i > 0) & (F.get(solid, i - 1)["level"] == x["level"]), F.lit("\n")).otherwise(
                F.concat(F.lit("\u0001"), x["level"].cast("string"), F.lit("\u0002"))
            ),
            F.translate(x["text"], "\u0001\u0002", ""),
        ),
    )
    cuts = F.filter(F.split(F.array_join(marked, ""), "\u0001"), lambda x: x != "")
    return F.transform(
        cuts,
        lambda x: F.struct(
            F.substring_index(x, "\u0002", 1).cast("int").alias("level"),
            F.substring_index(x, "\u0002", -1).alias("text"),
        ),
    )


def _units(text: Column) -> Column:
    """Hashes by which a passage is known: of the whole and of each of its lines, with their length."""
    parts = F.concat(F.array(text), F.split(text, "\n"))
    return F.array_distinct(
        F.transform(parts, lambda x: F.struct(F.length(normalised(x)).alias("size"), F.xxhash64(normalised(x)).alias("hash")))
    )


def link_quotes(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Messages in reply order: ``conv_id``, ``turn``, ``role``, ``text`` without quotes,
    ``quote_levels`` (deepest level), ``reply_to`` (turn of the message it quotes, null if
    none), ``anchor`` (turn of the first message of that chain of replies) and ``position``
    (from 0 within the conversation: every message follows the chain it replies to).

    A quoted passage belongs to the earliest message of the conversation, before the quoting
    one, that has it as its own text: the whole passage, else its longest line that is found.
    Of several quoted passages the one at the outermost level and earliest in the message
    counts. A message without quotes, or whose quotes are nowhere found, is its own anchor.
    Null texts are empty; a null turn comes first and is never replied to; a null
    conversation is one of its own. Repeated rows stay and stand side by side. Other columns
    are not looked at, and an empty table gives no rows.
    """
    rows = df.select(
        column(conversation).alias("conv"), column(turn).cast("long").alias("turn"), column(role).alias("role"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    split = rows.withColumn("lines", lines_of(F.col("text")))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n")
    message = split.select(
        "conv", "turn", "role", F.regexp_replace(own, r"^\s+|\s+$", "").alias("own"), F.array_max(F.transform("lines", lambda x: x["level"])).alias("levels"),
        F.when(F.exists("lines", lambda x: x["level"] > 0), passages(F.col("lines"))).alias("parts"),
    )
    quoting = stored(message.where(F.col("levels") > 0).select("conv", "turn", "parts"), "quotes")
    quoted = quoting.select("conv", "turn", F.posexplode(F.filter("parts", lambda x: x["level"] > 0)).alias("part", "p"))
    asked = quoted.select("conv", "turn", "part", F.col("p.level").alias("level"), F.explode(_units(F.col("p.text"))).alias("u"))
    # The earliest message with a passage; messages are looked at only where some are quoted.
    sought = asked.select("conv", F.col("u.hash").alias("hash")).distinct()
    own_units = message.where(F.col("own") != "").select(
        "conv", "turn", F.explode(F.array_distinct(F.concat(*[
            F.transform(_units(F.col("own")), lambda u: u["hash"]),
            F.transform(F.split(F.col("own"), r"\n\s*\n"), lambda x: F.xxhash64(normalised(x))),
        ]))).alias("hash"),
    )
    original = (
        own_units.groupBy("conv", "hash").agg(F.min("turn").alias("original"))
        .join(sought, ["conv", "hash"], "left_semi")
    )
    original = stored(original, "quotes")
    found = asked.select("conv", "turn", "part", "level", F.col("u.size").alias("size"), F.col("u.hash").alias("hash")).join(
        original, ["conv", "hash"]
    ).where(F.col("original") < F.col("turn"))
    order = F.struct(F.col("level"), F.col("part"), (-F.col("size")).alias("size"))
    links = stored(found.groupBy("conv", "turn").agg(F.min_by("original", order).alias("reply_to")), "quotes")
    anchors = _anchors(links)
    return _ordered(message, links, anchors).select(
        F.col("conv").alias(conversation), F.col("turn").alias(turn), F.col("role").alias(role),
        F.col("own").alias(text), F.col("levels").alias("quote_levels"), "reply_to", "anchor", "position",
    )


def _anchors(links: DataFrame) -> DataFrame:
    """For every replying message the first message of its chain, by pointer jumping: each
    round doubles how far a pointer reaches, so rounds grow with the logarithm of a chain."""
    pointers = stored(links.select("conv", "turn", F.col("reply_to").alias("to")), "quotes")
    total = None
    while True:
        now = pointers.agg(F.sum(F.col("to").cast("decimal(38,0)"))).first()[0]
        if now is None or now == total:
            return pointers.withColumnRenamed("to", "anchor")
        total = now
        further = pointers.select("conv", F.col("turn").alias("to"), F.col("to").alias("next"))
        pointers = stored(
            pointers.join(further, ["conv", "to"], "left").select("conv", "turn", F.coalesce("next", "to").alias("to")), "quotes"
        )


def _ordered(message: DataFrame, links: DataFrame, anchors: DataFrame) -> DataFrame:
    """Messages with their place in the conversation, however long it is.

    Rows are dealt out by range of the whole order, so a long conversation spans several
    tasks; each counts its rows per conversation and starts where the earlier ones end.
    """
    known = links.join(anchors, ["conv", "turn"]).select(
        F.col("conv").alias("__conv"), F.col("turn").alias("__turn"), "reply_to", "anchor"
    )
    same = F.col("conv").eqNullSafe(F.col("__conv")) & F.col("turn").eqNullSafe(F.col("__turn"))
    placed = message.drop("parts").join(known, same & (F.col("levels") > 0), "left").drop("__conv", "__turn")
    placed = placed.withColumn("anchor", F.coalesce("anchor", "turn"))
    order = ["conv", "anchor", "turn", "role", "own"]
    dealt = stored(
        placed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "conversations"
    )
    sizes = dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("conv").alias("__conv"), F.col("part").alias("__part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order[1:])) - 1
    numbered = dealt.withColumn("number", number)
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part"))
    return numbered.join(offsets, same).withColumn("position", F.col("before") + F.col("number"))
