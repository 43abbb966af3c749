"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders. Windows of the resulting templates are
hashed and joined, so a question is found again with other numbers or other names in it.
What stands in the placeholders must then be consistent: along one alignment, or a chain of
alignments that are a few tokens apart, the same slot value of the benchmark always meets the
same value of the document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, stored
from tidemark.llm.url_filter import MAX_BLOCKS, URLS_PER_BLOCK, bloom_filter, may_contain

WINDOW = 5
# Tokens of an item that must be found: these, and this share of the others.
FIRST, SHARE = 7, 0.3
# Tokens by which neighbouring alignments of a chain may be apart: as many may be inserted or
# left out at one place.
DRIFT = 5
# Items of fewer tokens are no evidence inside a longer text.
SHORTEST = 3

NUMBER, NAME, UNIT, END = "\ue000", "\ue001", "\ue002", "\ue003"
# Blocks of scripts that are written without spaces (Thai, Lao, Burmese, Khmer,
# Japanese syllables, Chinese characters).
SPACELESS = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\x{20000}-\x{323af}]"
# Units of measurement.
UNITS = (
    "mm cm m km g kg mg t ml l s ms min h mph inch inches ft feet yd yard yards mile miles "
    "oz lb lbs gram grams kilogram kilograms meter meters metre metres liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()


def _marked(text: Column) -> Column:
    """``text`` with each number, run of names and unit between its placeholder and END, and
    the letters of scripts without spaces set apart."""
    given = F.coalesce(text, F.lit(""))
    marks = NUMBER + NAME + UNIT + END
    apart = F.regexp_replace(F.translate(given, marks, "    "), rf"({SPACELESS}\p{{M}}*)", "$1 ")
    # Few texts need that, and to tell is cheaper than to do it.
    whole = F.when(given.rlike(rf"[{marks}{SPACELESS[1:]}"), apart).otherwise(given)
    # Groups repeat possessively (*+): otherwise Java's matcher calls itself once for each
    # repeat, and a long run of names or numbers overflows the stack, which ends the executor.
    numbered = F.regexp_replace(whole, r"\p{N}+(?:[.,]\p{N}+)*+", f"{NUMBER}$0{END}")
    # Each pattern begins with what is rare, so that most characters are passed over at once.
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    united = F.regexp_replace(numbered, rf"{END}( ?)({units})(?![\p{{L}}\p{{M}}{NUMBER}])", f"{END}$1{UNIT}$2{END}")
    signed = F.regexp_replace(united, "[%$€£°]", f"{UNIT}$0{END}")
    word = r"\p{Ll}[\p{L}\p{M}]*"
    name = rf"\p{{Lu}}(?<=[\p{{Ll}}{END},;] \p{{Lu}}){word}(?: \p{{Lu}}{word})*+"
    return F.regexp_replace(signed, name, f"{NAME}$0{END}")


def _split(marked: Column) -> Column:
    return F.regexp_extract_all(marked, F.lit(rf"[{NUMBER}{NAME}{UNIT}][^{END}]*{END}|[\p{{L}}\p{{M}}]+"), 0)


def _is_slot(token: Column) -> Column:
    return (token >= NUMBER) & (token < END)


def _template(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.when(_is_slot(x), F.left(x, F.lit(1))).otherwise(x))


def tokens(text: Column) -> Column:
    """Words, numbers, runs of names and currency or percent signs as they stand in the text.
    A letter of a script without spaces is a word."""
    return F.transform(_split(_marked(text)), lambda x: F.translate(x, NUMBER + NAME + UNIT + END, ""))


def template(text: Column) -> Column:
    """The same tokens, lower-cased, with placeholders for numbers, runs of names and units.

    A name is a capitalised word after a lower-case letter, number, unit or comma and one
    space, so the first word of a sentence is none; names with one space between them are one.
    A unit stands right behind a number. Characters of the placeholders in the text itself count as
    letters of no word.
    """
    return _template(_split(F.lower(_marked(text))))


def _coded(df: DataFrame) -> DataFrame:
    """``df`` with hashes of its ``parts``: ``values`` as they stand, ``codes`` as the template
    has them, ``words`` with nulls for placeholders. Each token is hashed once, windows are
    made of the hashes. Texts that are not ``slotted`` have no placeholders."""
    hashed = df.withColumn("values", F.transform("parts", lambda x: F.xxhash64(x)))
    codes = F.transform("parts", lambda x, i: F.when(_is_slot(x), F.xxhash64(F.left(x, F.lit(1)))).otherwise(F.get("values", i)))
    words = F.transform("parts", lambda x, i: F.when(~_is_slot(x), F.get("values", i)))
    return hashed.withColumns({k: F.when(F.col("slotted"), v).otherwise(F.col("values")) for k, v in (("codes", codes), ("words", words))})


def _run(codes: str, at: Column, size: int) -> list[Column]:
    return [F.get(codes, at + k) for k in range(size)]


def _slots_of(at: Column, window: int) -> Column:
    """``_slots`` of a text as ``_coded``: most windows hold no placeholder."""
    full = reduce(lambda x, y: x & y, [w.isNotNull() for w in _run("words", at, window)])
    return F.when(~F.col("slotted") | full, F.array().cast("array<string>")).otherwise(_slots(at, window))


def _no_windows() -> Column:
    return F.array().cast("array<struct<at:int,hash:bigint,slots:array<string>>>")


def _windows(size: int) -> Column:
    """(at, hash, slots) of each window of a text as ``_coded``; shorter texts are one window.
    Those with fewer than two different words are hashed with what stands in their
    placeholders."""
    n = F.size("parts")
    places = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))

    def plain(i: Column) -> Column:
        return F.struct(i.alias("at"), F.xxhash64(*_run("codes", i, size)).alias("hash"), F.array().cast("array<string>").alias("slots"))

    def checked(i: Column) -> Column:
        words = _run("words", i, size)
        poor = F.coalesce(F.least(*words) == F.greatest(*words), F.lit(True))
        chosen = F.when(poor, F.xxhash64(*_run("values", i, size))).otherwise(F.xxhash64(*_run("codes", i, size)))
        return F.struct(i.alias("at"), chosen.alias("hash"), _slots_of(i, size).alias("slots"))

    hashed = F.when(F.col("slotted"), F.transform(places, checked)).otherwise(F.transform(places, plain))
    return F.when(n > 0, hashed).otherwise(_no_windows())


def _exact(size: int, window: int) -> Column:
    """(at, hash, slots) of each run of ``size`` tokens with the values of its placeholders."""
    runs = F.transform(F.sequence(F.lit(0), F.size("parts") - size), lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.lit(size), *_run("values", i, size)).alias("hash"), _slots_of(i, window).alias("slots")))
    return F.when(F.size("parts") >= size, runs).otherwise(_no_windows())


def find_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    keys: tuple[str, ...] = ("doc_id",), window: int = WINDOW, share: float = SHARE, drift: int = DRIFT,
) -> DataFrame:
    """One row per (``keys``, item) that a document holds: ``n_windows`` different windows of
    the item in the best place, ``share`` of the item's tokens that they cover, ``start``
    (token where the item would begin in the document), ``n_slots`` different pairs of
    placeholder values compared and ``changed``, whether any of them differ.

    A window has five tokens; one with fewer than two different literal words must have the
    item's values in its placeholders, any other only its template. Windows are added up
    along one alignment, and along a chain of alignments each at most ``drift`` tokens from
    the one before, so words may be inserted or left out. Either is a leak if it covers seven
    tokens of the item and ``share`` of its others (all tokens of an item with up to seven)
    and if its slots are consistent. The best place covers most; ties go to one alignment
    before a chain, then to the smallest start.

    Items of three and four tokens are found inside a text with their own values only, and
    those of one and two only where a text is nothing but them. Documents and items with null
    or empty text give nothing; rows that repeat a key are one document. Null keys count as a
    key of their own. All columns but those named are ignored.
    """
    items = benchmark.select(column(item_id).alias("item"), _split(F.lower(_marked(column(item_text)))).alias("parts"))
    items = items.withColumn("n", F.size("parts")).where("n > 0").withColumn("slotted", F.exists("parts", _is_slot))
    items = stored(_coded(items), "benchmark")
    short = [r.n for r in items.where(F.col("n").between(SHORTEST, window - 1)).select("n").distinct().collect()]
    # What a short item has less than a window is null, which hashes pass over.
    whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64("n", *_run("values", F.lit(0), window)).alias("hash"),
                             _slots(F.lit(0), window).alias("slots")))
    within = F.when(F.col("n").between(SHORTEST, window - 1), F.concat(_windows(window), whole)).otherwise(_windows(window))
    items = stored(
        items.select("item", "n", F.explode_outer(within).alias("w"))
        .select("item", "n", F.col("w.at").alias("item_at"), "w.hash", F.col("w.slots").alias("item_slots")),
        "benchmark",
    )
    blocks = max(1, min(MAX_BLOCKS, -(-items.count() // URLS_PER_BLOCK)))
    bloom = bloom_filter(items, "hash", blocks)
    names = [f"k{i}" for i in range(len(keys))]
    documents = df.select(
        *[column(k).alias(n) for n, k in zip(names, keys)], F.lower(_marked(column(text))).alias("marked")
    ).select(*names, _split(F.col("marked")).alias("parts"), F.col("marked").contains(END).alias("slotted"))
    documents = _coded(documents)
    wanted = F.concat(_windows(window), *[_exact(n, window) for n in sorted(short)]) if short else _windows(window)
    # Tokens of the text stay behind: each window would get a copy of them all. The outer form:
    # for the plain one Spark adds a filter on the array below, and computes the tokens once
    # more for every window to evaluate it.
    every = documents.select(*names, F.explode_outer(wanted).alias("w")).select(*names, "w.*").where("hash is not null")
    maybe = may_contain(every, "hash", bloom, blocks, "maybe").where("maybe").drop("maybe")
    met = maybe.join(items, "hash").withColumn("start", F.col("at") - F.col("item_at"))
    # Rows of one alignment, each window once.
    once = met.groupBy(*names, "item", "start", "item_at").agg(
        F.first("n").alias("n"), F.first("slots").alias("slots"), F.first("item_slots").alias("item_slots")
    )
    width, need = F.least(F.col("n"), F.lit(window)), F.least(F.col("n"), F.ceil(FIRST + share * (F.col("n") - FIRST)))
    pair = Window.partitionBy(*names, "item")
    enough = once.withColumn("met", F.count(F.lit(1)).over(pair)).where(F.col("met") * width >= need)
    before = F.lag("start").over(pair.orderBy("start"))
    cut = enough.withColumn("cut", F.coalesce((F.col("start") - before > drift).cast("int"), F.lit(0)))
    chain = F.sum("cut").over(pair.orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    place = F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("start").cast("long").alias("nr")),
        F.struct(F.lit(1).alias("kind"), F.col("chain").alias("nr")),
    ))
    placed = cut.withColumn("chain", chain).withColumn("place", place).select("*", "place.kind", "place.nr")
    group = [*names, "item", "kind", "nr"]
    # Windows in the item's order: each adds what the one before does not cover.
    further = F.col("item_at") - F.lag("item_at").over(Window.partitionBy(*group).orderBy("item_at"))
    placed = placed.withColumn("new", F.coalesce(F.least(width, further), width))
    pairs = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots"))))
    found = placed.groupBy(*group).agg(
        F.sum("new").alias("covered"), F.sum((F.col("new") > 0).cast("long")).alias("n_windows"),
        F.first("n").alias("n"), F.min("start").alias("start"), pairs.alias("pairs"),
    ).where(F.col("covered") >= need)
    values = F.array_distinct(F.transform("pairs", lambda p: p["item_slots"]))
    leaks = found.where(F.size(values) == F.size("pairs"))
    best = F.struct(
        "covered", (-F.col("kind")).alias("kind"), (-F.col("start")).alias("start"), "n_windows",
        (F.col("covered") / F.col("n")).alias("share"), F.size("pairs").alias("n_slots"),
        F.exists("pairs", lambda p: p["item_slots"] != p["slots"]).alias("changed"),
    )
    return leaks.groupBy(*names, "item").agg(F.max(best).alias("b")).select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("item").alias("item_id"),
        F.col("b.n_windows").alias("n_windows"), F.col("b.share").alias("share"), (-F.col("b.start")).cast("long").alias("start"),
        F.col("b.n_slots").alias("n_slots"), F.col("b.changed").alias("changed"),
    )


def _slots(at: Column, window: int) -> Column:
    """What stands in the placeholders of the window at ``at``, lower-cased."""
    return F.filter(F.slice("parts", at + 1, window), _is_slot)
