"""Source divergence audit: where the words of a source depart from those of its language.

Terms are counted inside the tasks before anything is shuffled. A slice of whole texts is one
byte buffer; its terms are told apart by tables over bytes and packed by length. Terms of up
to 8 bytes are one big-endian ``uint64``, those of up to 16 two. Few bytes mean few digits: a
radix sort takes 16 bits at a time, and only as many passes as the longest of a length bucket
needs. Longer terms go to buckets of one length each, sorted as bytes. Sorted terms are counted
by runs. No term holds a zero byte, so the padding tells terms of different length apart.

What reaches a shuffle is one row per task, group and term. Shares are exact whole numbers, and
divergences are summed over blocks of terms, so that no source, however hot, meets another in
one task for all its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, stored

LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
# Bytes of text and number of texts that are sorted together; a longer text is a slice of its own.
SLICE_BYTES = 16 << 20
SLICE_TEXTS = 1 << 16
# Blocks of terms per language at least, and rows per block.
LEAST_BLOCKS = 64
BLOCK_ROWS = 50_000
# Terms whose shares are compared at once in a block.
TOGETHER = 512

_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_TERM = (_BYTES >= 128) | ((_LOWER >= 97) & (_LOWER <= 122))
# Keeps the first 0 to 8 bytes of a big-endian word.
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * i)) for i in range(1, 9)], np.uint64)


def term_places(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and text numbers of all terms of lower-cased texts that lie one after
    the other; text *i* is ``text[offsets[i] : offsets[i + 1]]``."""
    inside = _IN_TERM[text]
    if not inside.any():
        return (np.zeros(0, np.int64),) * 3
    edges = np.zeros(len(text) + 1, bool)
    edges[0] = edges[-1] = True
    edges[1:-1] = inside[1:] != inside[:-1]
    edges[offsets] = True  # no term goes on in the next text
    places = np.flatnonzero(edges)
    begins = inside[places[:-1]]
    starts = places[:-1][begins]
    lengths = (places[1:] - places[:-1])[begins]
    return starts, lengths, np.searchsorted(offsets, starts, side="right") - 1


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys`` (unsigned, the most telling first), 16 bits a pass."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        # numpy sorts 16-bit numbers by radix when the sort has to be stable.
        order = order[np.argsort(key[order], kind="stable")]
    return order


def _digits(word: np.ndarray, used: int) -> list[np.ndarray]:
    """The first ``used`` bytes of big-endian words as 16-bit digits, the highest first."""
    return [((word >> np.uint64(48 - 16 * i)) & np.uint64(0xFFFF)).astype(np.uint16) for i in range((used + 1) // 2)]


def _runs(changes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted terms: first of each run, its length and how many texts it spans."""
    starts = np.flatnonzero(changes)
    other_text = changes.copy()
    other_text[1:] |= texts[1:] != texts[:-1]
    return starts, np.diff(starts, append=len(changes)), np.add.reduceat(other_text.astype(np.int64), starts)


def count_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray):
    """Counts of the terms of some texts: arrays of group, start and length of the term in the
    lower-cased bytes, occurrences and texts; and those bytes. ``groups`` has a number below
    65536 for each text."""
    text = _LOWER[data]
    starts, lengths, texts = term_places(text, offsets)
    group = groups[texts].astype(np.uint16)
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    # The eight bytes from every place on, as one number, without a copy.
    words = np.ndarray((len(text) + 9,), ">u8", padded, strides=(1,))
    found = []

    def keep(at: np.ndarray, order: np.ndarray, differs: np.ndarray) -> None:
        at = at[order]
        changes = np.concatenate([[True], differs | (group[at][1:] != group[at][:-1])])
        first, n, spans = _runs(changes, texts[at])
        found.append((group[at[first]], starts[at[first]], lengths[at[first]], n, spans))

    def other(values: np.ndarray) -> np.ndarray:
        return values[1:] != values[:-1]

    for least, most in ((1, 2), (3, 4), (5, 6), (7, 8)):
        at = np.flatnonzero((lengths >= least) & (lengths <= most))
        if len(at):
            word = words[starts[at]].astype(np.uint64) & _FIRST[lengths[at]]
            order = radix_order([group[at], *_digits(word, most)])
            keep(at, order, other(word[order]))
    at = np.flatnonzero((lengths > 8) & (lengths <= 16))
    if len(at):
        high = words[starts[at]].astype(np.uint64)
        low = words[starts[at] + 8].astype(np.uint64) & _FIRST[lengths[at] - 8]
        order = radix_order([group[at], *_digits(high, 8), *_digits(low, 8)])
        keep(at, order, other(high[order]) | other(low[order]))
    at = np.flatnonzero(lengths > 16)
    by_length = at[np.argsort(lengths[at], kind="stable")]
    for at in np.split(by_length, np.flatnonzero(np.diff(lengths[by_length])) + 1):
        if len(at):
            n = int(lengths[at[0]])
            term = text[starts[at][:, None] + np.arange(n)].view(f"S{n}").ravel()
            order = np.argsort(term, kind="stable")
            order = order[np.argsort(group[at][order], kind="stable")]
            keep(at, order, other(term[order]))
    if not found:
        return (*(np.zeros(0, np.int64),) * 5, text)
    return (*map(np.concatenate, zip(*found)), text)


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole texts that are counted together."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), first + SLICE_TEXTS, len(offsets) - 1)
        yield first, last
        first = last


def _gathered(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Pieces of a byte buffer as an array of binary values."""
    ends = np.cumsum(lengths)
    moved = np.repeat(starts - (ends - lengths), lengths)
    values = text[np.arange(len(moved)) + moved]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, sources = batch["lang"].dictionary_encode(), batch["source"].dictionary_encode()
        both = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        groups, codes = np.unique(both, return_inverse=True)
        texts = batch["text"].cast(pa.large_binary())
        _, offset_buffer, data_buffer = texts.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)

        def rows(code, terms, n, docs):
            of_lang, of_source = np.divmod(groups[code], len(sources.dictionary))
            of = [langs.dictionary.take(pa.array(of_lang)), sources.dictionary.take(pa.array(of_source))]
            counted = [pa.array(x.astype(np.int64)) for x in (n, docs)]
            return pa.RecordBatch.from_arrays([*of, terms, *counted], names=["lang", "source", "term", "n", "docs"])

        # Every group is named once, with or without terms.
        named = np.arange(len(groups))
        yield rows(named, pa.nulls(len(groups), pa.binary()), np.zeros(len(groups)), np.zeros(len(groups)))
        for first, last in _slices(offsets):
            part = offsets[first : last + 1]
            local, of = np.unique(codes[first:last], return_inverse=True)
            group, start, length, n, docs, text = count_terms(data[part[0] : part[-1]], part - part[0], of)
            for i in range(0, len(group), 1 << 18):
                some = slice(i, i + (1 << 18))
                terms = _gathered(text, start[some], length[some]).cast(pa.binary())
                yield rows(local[group[some]], terms, n[some], docs[some])


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences, ``docs`` rows that have the term; and
    a row without a term for each (lang, source). Nulls count as ''."""
    given = df.select(*[F.coalesce(column(c).cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))])
    counted = given.mapInArrow(_count_batches, "lang string, source string, term binary, n bigint, docs bigint")
    summed = counted.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
    return summed.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column, smoothing: int = SMOOTHING) -> Column:
    """1 + floor(SCALE * (n + smoothing) / (total + smoothing * kept)), exactly."""
    whole = (n + F.lit(smoothing)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", whole, (total + F.lit(smoothing) * kept).cast("decimal(20,0)")) + F.lit(1).cast("bigint")


def _block_distances(smoothing: int):
    """Of one block of terms of a language: for each two sources the sum of the differences of
    their shares. ``term`` is null in the rows that name the sources, their totals in ``n``."""

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        named = rows["term"].isna()
        sources = rows[named].sort_values("source")
        names, below = sources["source"].to_numpy(), [int(t) + smoothing * int(v) for t, v in zip(sources["n"], sources["kept"])]
        counted = rows[~named]
        codes, terms = pd.factorize(counted["term"])
        at = np.searchsorted(names, counted["source"].to_numpy())
        total = np.zeros((len(names), len(names)), np.int64)
        base = np.array([1 + SCALE * smoothing // b if b else 1 for b in below], np.int64)
        p = np.array([1 + SCALE * (int(n) + smoothing) // below[a] for n, a in zip(counted["n"], at)], np.int64)
        order = np.argsort(codes, kind="stable")
        codes, at, p = codes[order], at[order], p[order]
        for first in range(0, len(terms), TOGETHER):
            a, b = np.searchsorted(codes, [first, first + TOGETHER])
            shares = np.repeat(base[:, None], min(TOGETHER, len(terms) - first), 1)
            shares[at[a:b], codes[a:b] - first] = p[a:b]
            for i in range(len(names)):
                total[i] += np.abs(shares - shares[i]).sum(1)
        i, j = np.nonzero(~np.eye(len(names), dtype=bool))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "source": names[i], "item": names[j], "value": total[i, j]})

    return of


def source_divergence(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top: int = TOP,
) -> DataFrame:
    """One row per finding: ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: the distance of the source to each other source of its language, summed over
    the terms that at least ``least_docs`` rows of the language have. Part ``term``: the
    ``top`` of these terms that the source uses more than its language does. Ranks go by
    falling value, ties by item.

    Null texts, languages and sources count as ''; repeated rows count each. A source without
    terms is compared like any other; in a language that keeps no term all distances are 0. A
    language with one source has no pairs. An empty table gives no rows. Other columns, however
    named, are not looked at. Terms of any length are counted whole.
    """
    counts = stored(term_counts(df, text, lang, source), "divergence")
    terms = counts.where("term is not null")
    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = stored(kept.where(F.col("docs") >= least_docs).drop("docs"), "divergence")
    used = stored(terms.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence")

    # One row per language, and one per source.
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    rows = used.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    languages = stored(languages.join(rows, "lang"), "divergence")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    zero = F.lit(0).cast("bigint")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total", "rows")]), "divergence")

    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = share(F.col("n"), F.col("total"), F.col("kept"), smoothing)
    general = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), smoothing)
    more = used.join(groups.drop("rows"), ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - general).alias("value")
    ).where(F.col("value") > 0)
    more = more.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= top)

    blocks = F.greatest(F.lit(LEAST_BLOCKS), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("int")
    dealt = used.join(languages.select("lang", blocks.alias("blocks"), "kept"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "n", "kept"
    )
    named = groups.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "lang", "block", "source", F.lit(None).cast("string").alias("term"), F.col("total").alias("n"), "kept"
    )
    partial = dealt.unionByName(named).groupBy("lang", "block").applyInPandas(
        _block_distances(smoothing), "lang string, source string, item string, value bigint"
    )
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_item).alias("rank"))
    return pairs.unionByName(more)


def oracle_sql(least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top: int = TOP) -> str:
    """SQL that gives the same rows from a table ``documents``."""

    def p(n: str, total: str) -> str:
        return f"1 + ({SCALE}::hugeint * ({n} + {smoothing})) // ({total} + {smoothing} * kept)"

    return rf"""
    with texts as (
        select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
    words as (
        select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from texts),
    kept_terms as (
        select lang, term, count(*) as lang_n from words group by lang, term having count(distinct row) >= {least_docs}),
    counts as (
        select lang, source, term, count(*) as n from words semi join kept_terms using (lang, term) group by all),
    languages as (select lang, count(*) as kept, sum(lang_n) as lang_total from kept_terms group by lang),
    sources as (
        select lang, source, coalesce(sum(n), 0) as total
        from (select distinct lang, source from texts) left join counts using (lang, source) group by all),
    dense as (
        select lang, source, term, coalesce(n, 0) as n, {p('coalesce(n, 0)', 'total')} as p, {p('lang_n', 'lang_total')} as q
        from sources join kept_terms using (lang) join languages using (lang) left join counts using (lang, source, term)),
    distances as (
        select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
        from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    found as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
        from sources a join sources b on a.lang = b.lang and a.source <> b.source
            left join distances d on d.lang = a.lang and d.source = a.source and d.item = b.source
        union all
        select lang, source, 'term', term, p - q from dense where n > 0 and p > q)
    select lang, source, part, item, value::bigint as value,
        row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from found qualify part = 'pair' or rank <= {top}
    """
