"""SimHash near-duplicates found by balls that meet half way.

Two fingerprints at most ``radius`` bits apart have a common variant at most ``radius / 2``
bits from either. So every fingerprint sends all its variants of that radius, fingerprints
are brought together by variant, and whoever meets is linked. All who meet at one variant
are within the radius of each other, so a chain through them is enough: a group of *n* sends
*n - 1* links, never all pairs.

A ball of radius 2 over 64 bits has 2,081 variants. Most fingerprints have no neighbour at
all, and that shows earlier and more cheaply: one half of the bits differs in at most half
the radius, so the small balls over both halves (33 variants each) meet first. Only
fingerprints that find a neighbour there send the whole ball.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import Scratch, column, stored
from tidemark.llm.components import components, joined_components, still_apart
from tidemark.llm.url_filter import MAX_BLOCKS, URLS_PER_BLOCK, bloom_filter, listed_marks, may_contain

SEED = 42
RADIUS = 4
CHUNK = 1 << 16
# What bytes add to the eight bits they hold, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = np.arange(8, dtype=np.uint16) * 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of words, repeats included, in pieces of bounded size.

    Words are separated by ASCII white space, A-Z is lower-cased. Fewer words than a shingle
    has are one shingle; no words give nothing.
    """
    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return
    digest = xxhash.xxh64_intdigest
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    n = len(spaces) + 2 - shingle
    if n <= 1:
        yield np.array([digest(data, SEED)], np.uint64)
        return
    starts = np.concatenate([[0], spaces[: n - 1] + 1])
    ends = np.concatenate([spaces[shingle - 1 :], [len(data)]])
    for i in range(0, n, CHUNK):
        pairs = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist())
        yield np.array([digest(data[a:b], SEED) for a, b in pairs], np.uint64)


def bit_majority(hashes: Iterator[np.ndarray], views: int = 1) -> np.ndarray:
    """Fingerprints of 64 bits, one per view; a bit is set if more than half the hashes set it.

    View 0 takes the hashes as they are, further views mix them anew.
    """
    counts, n = np.zeros((views, 64), np.int64), 0
    for h in hashes:
        n += len(h)
        for v in range(views):
            if v:
                h = h * _ODD + np.uint64(v)
                h ^= h >> np.uint64(29)
            octets = h.astype(">u8").view(np.uint8).reshape(-1, 8) + _PLACES
            counts[v] += (np.bincount(octets.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return np.packbits(counts * 2 > n, axis=1).view(">u8").ravel().astype(np.int64) if n else np.zeros(views, np.int64)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The SimHash of the whole text as a long; null and wordless texts have 0."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([int(bit_majority(shingle_hashes(t, shingle))[0]) for t in texts], dtype="int64")

    return of(text)


def ball(bits: int, radius: int) -> list[int]:
    """All masks with at most ``radius`` of ``bits`` bits set, as signed longs."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(df: DataFrame, value: Column, bits: int, radius: int, *keep: str) -> DataFrame:
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball(bits, radius)])
    return df.select(*keep, value.alias("__value"), F.explode(masks).alias("__mask")).select(
        *keep, F.col("__value").bitwiseXOR(F.col("__mask")).alias("variant")
    )


# Rows of one half word that are compared with each other; whoever has more around is taken
# to have a neighbour, which costs variants but loses none.
COMPARED = 64


def _meeting(radius: int):
    """Fingerprints of rows sorted by (variant, fp) that have another within the radius."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        variant = fp = np.zeros(0, np.int64)
        for batch in batches:
            variant = np.concatenate([variant[-COMPARED:], batch["variant"].to_numpy(np.int64)])
            fp = np.concatenate([fp[-COMPARED:], batch["fp"].to_numpy(np.int64)])
            near = np.zeros(len(fp), bool)
            for lag in range(1, COMPARED + 1):
                same = np.flatnonzero(variant[lag:] == variant[:-lag])
                if not len(same):
                    break
                if lag < COMPARED:
                    apart = np.bitwise_count((fp[same] ^ fp[same + lag]).view(np.uint64))
                    same = same[(apart <= radius) & (apart > 0)]
                near[same] = near[same + lag] = True
            yield pd.DataFrame({"fp": np.unique(fp[near])})

    return scan


def with_neighbours(fps: DataFrame, radius: int) -> DataFrame:
    """Those of the distinct ``fp`` that may have another within the radius; none that has
    one is missing."""
    within = radius // 2
    halves = F.explode(F.array(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)),
        F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32)),
    ))
    emitted = _variants(fps.select("fp", halves.alias("half")), F.col("half"), 32, -(-within // 2), "fp")
    sorted_rows = emitted.repartition("variant").sortWithinPartitions("variant", "fp")
    return sorted_rows.mapInPandas(_meeting(radius), "fp bigint").distinct()


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fp`` at most ``radius`` (even) bits apart: not
    all pairs, but enough to connect all that are."""
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even: balls of half the radius have to meet")
    emitted = _variants(with_neighbours(fps, radius), F.col("fp"), 64, radius // 2, "fp")
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    met = emitted.select("fp", before.alias("other"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
    return met.where(F.col("other").isNotNull() & close).select(
        F.col("other").alias("a"), F.col("fp").alias("b")
    ).distinct()


# Near copies. In any order of all shingles, two sets that are at least SIMILARITY alike have
# one in common among the first of each: of n shingles the first n - ceil(SIMILARITY * n) + 1.
# So texts meet by these, and no pair is missed. With frequent shingles last few texts meet
# that are not alike; which order it is changes no result.
SHINGLE = 5
SIMILARITY = 0.8
# Shingles known to be frequent, at most; and how many are looked at together.
FREQUENT = 200_000
COUNTED = 1 << 21
# Groups that are compared each with each at once.
FEW = 9
# Tokens of a text that tell whether two have met before.
HEAD = 64
# Groups of more rows are dealt out over salts, so many rows each.
SALTED = 512
# Bits of a sketch for each shingle, at least; longs of it that go along with rows that meet.
SKETCH = 2
CARRIED = 8
# Pairs of a node that are compared before its others.
CLOSEST = 4
# Hashes of words that a task remembers.
KNOWN_WORDS = 50_000
_TINY = 1e-9  # what rounding may do to a share


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


_WORDS = _WordHashes()


def _distinct_shingles(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingles of the whole text as sorted hashes: those of the words, mixed in
    order. Texts with fewer words are one shingle; those without words have one of their own,
    so that they are copies of each other."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    each = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    length = min(shingle, len(each))
    mixed = np.full(max(1, len(each) - shingle + 1), length, np.uint64)
    for i in range(length):
        mixed ^= each[i : i + len(mixed)]
        mixed *= _ODD
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def shingle_sets(text: Column, shingle: int = SHINGLE) -> Column:
    """The distinct shingles of the whole text, as hashes of 64 bits."""

    @F.pandas_udf("array<bigint>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_distinct_shingles(t, shingle) for t in texts])

    return of(text)


def _parities(tokens: np.ndarray) -> np.ndarray:
    bits = 64
    while bits < SKETCH * len(tokens):
        bits *= 2
    counts = np.bincount(tokens & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def sketches(text: Column, shingle: int = SHINGLE) -> Column:
    """``n``, the number of distinct shingles, and ``bits``: how many of them fall to each of a
    power of two of places, odd or even. Sets that differ in *d* shingles differ in at most *d*
    places, so sketches tell texts apart at a thirtieth of the size, and never alike ones."""

    @F.pandas_udf("struct<n:int,bits:array<bigint>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [_distinct_shingles(t, shingle) for t in texts]
        return pd.DataFrame({"n": [len(x) for x in sets], "bits": [_parities(x) for x in sets]})

    return of(text)


def _folded(bits: Column, words: Column) -> Column:
    """The sketch of the same set in ``words`` longs, a power of two and at most its own."""

    def place(i: Column) -> Column:
        same = F.sequence(i, F.size(bits) - 1, words)
        return F.aggregate(same, F.lit(0).cast("bigint"), lambda x, j: x.bitwiseXOR(F.get(bits, j)))

    return F.when(F.size(bits) <= words, bits).otherwise(F.transform(F.sequence(F.lit(0), words - 1), place))


def _places_apart(other: str) -> Column:
    """Of two texts with ``bits``: the places in which their sketches differ."""
    bits = F.col(f"{other}bits")
    words = F.least(F.size("bits"), F.size(bits))
    differ = F.zip_with(_folded(F.col("bits"), words), _folded(bits, words), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda x, y: x + y)


def _sketches_allow(similarity: float, other: str) -> Column:
    """Of two texts with ``n`` and ``bits``: their sizes and sketches leave room for the similarity."""
    n = F.col(f"{other}n")
    sizes = F.least(F.col("n"), n) >= similarity * F.greatest(F.col("n"), n) - _TINY
    return sizes & (_places_apart(other) <= (F.col("n") + n) * ((1 - similarity) / (1 + similarity)) + _TINY)


def frequent_shingles(texts: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """The shingles that most texts have, at most FREQUENT, the most frequent last.

    Only those that come twice among COUNTED shingles of a task are counted, so the counts
    are lower bounds: they serve to order shingles.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def repeated(held: list[np.ndarray]) -> pd.DataFrame:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"token": tokens[n > 1], "n": n[n > 1]})

        held, size = [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(_distinct_shingles(text, shingle))
                size += len(held[-1])
                if size >= COUNTED:
                    yield repeated(held)
                    held, size = [], 0
        if held:
            yield repeated(held)

    n = texts.select("text").mapInPandas(counted, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    most = n.where("n > 8").orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    return np.array([r["token"] for r in reversed(most)], np.int64)


def _meetings(texts: DataFrame, similarity: float, shingle: int = SHINGLE) -> DataFrame:
    """Rows ``token``, ``k1``, ``n``, ``rest``, ``m``: the first shingles of each text (``k1``
    is its hash) that ``m`` > 1 rows have among their first; ``n`` shingles in all, ``rest``
    from this one on. A task looks at equal texts once."""
    frequent = frequent_shingles(texts, shingle)
    by_token = np.argsort(frequent)
    known = frequent[by_token]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, text in zip(batch["k1"].tolist(), batch["text"]):
                if key in seen:
                    continue
                seen.add(key)
                tokens = _distinct_shingles(text, shingle)
                n = len(tokens)
                rank = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    rank = np.where(known[at] == tokens, by_token[at] + 1, 0)
                k = n - int(np.ceil(similarity * n - _TINY)) + 1
                order = np.lexsort((tokens, rank))[:k]
                rows.append((tokens[order], np.full(len(order), key), np.full(len(order), n), n - np.arange(len(order))))
                size += len(order)
                if size >= CHUNK:
                    yield pd.DataFrame(dict(zip(("token", "k1", "n", "rest"), map(np.concatenate, zip(*rows)))))
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(dict(zip(("token", "k1", "n", "rest"), map(np.concatenate, zip(*rows)))))

    every = texts.select("k1", "text").mapInPandas(first, "token bigint, k1 bigint, n int, rest int")
    # Equal texts of several tasks: one exchange by token serves both steps.
    once = every.repartition("token").groupBy("token", "k1").agg(F.first("n").alias("n"), F.first("rest").alias("rest"))
    return once.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("m > 1")


def _may_be_alike(similarity: float, other: str = "other_") -> Column:
    """Of rows with the columns of two nodes that meet at their first common shingle: sizes
    and what comes after it leave room for the similarity."""
    n, rest = F.col(f"{other}n"), F.col(f"{other}rest")
    sizes = F.least(F.col("n"), n) >= similarity * F.greatest(F.col("n"), n) - _TINY
    return sizes & (F.least(F.col("rest"), rest) >= similarity / (1 + similarity) * (F.col("n") + n) - _TINY)


def _with_heads(met: DataFrame) -> DataFrame:
    """``met`` with ``before``: of the first HEAD tokens of the node those before the row's."""
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("rest"), "token"))
    heads = met.select("node", "token", "rest").withColumn("place", place).where(F.col("place") <= HEAD)
    heads = heads.groupBy("node").agg(F.collect_list(F.struct("rest", "token")).alias("head"))
    earlier = F.filter("head", lambda x: x["rest"] > F.col("rest"))
    return met.join(heads, "node").withColumn("before", F.transform(earlier, lambda x: x["token"])).drop("head")


def _pairs(met: DataFrame, similarity: float, *apart: str, once: bool = False) -> DataFrame:
    """All distinct pairs ``a`` < ``b`` that meet and may be alike; with ``apart`` only those
    that differ in that column.

    With ``bits`` in ``met`` their sketches have to allow it, too. Two copies meet at many tokens. With ``once`` (``met`` has ``before``) the join leaves a
    pair out where both are known to have met at an earlier token.
    """
    apart = (*apart, "before") if once else apart
    sketched = [c for c in met.columns if c == "bits"]
    salts = F.ceil(F.col("m") / SALTED).cast("int")
    left = met.withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
    right = met.select(
        "token", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        *[F.col(c).alias(f"other_{c}") for c in ("node", "n", "rest", *apart, *sketched)],
    )
    both = left.join(right, ["token", "salt"]).where(_may_be_alike(similarity) & (F.col("node") < F.col("other_node")))
    for c in apart:
        new = ~F.arrays_overlap(c, f"other_{c}") if c == "before" else F.col(c) != F.col(f"other_{c}")
        both = both.where(new)
    if sketched:
        both = both.where(_sketches_allow(similarity, "other_"))
    return both.select(F.col("node").alias("a"), F.col("other_node").alias("b")).distinct()


def _rows_at(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``at`` and ``text`` of the rows at the stored places ``at`` of ``wanted``, and of few
    others: a Bloom filter tells, so texts need not be shuffled."""
    blocks = max(1, min(MAX_BLOCKS, -(-wanted.count() // URLS_PER_BLOCK)))
    return may_contain(rows.select("at", "text"), "at", bloom_filter(wanted, "at", blocks), blocks, "maybe").where("maybe")


def _sketched(rows: DataFrame, first: DataFrame, nodes: DataFrame, keep: Scratch) -> DataFrame:
    """``node``, ``n`` and ``bits`` of the distinct ``nodes``."""
    work = Scratch(rows.sparkSession, "copies")
    wanted = work(first.join(nodes, "node", "left_semi").select("node", "at"))
    each = _rows_at(rows, wanted).select("at", sketches(F.col("text")).alias("sketch"))
    found = keep(each.join(wanted, "at").select("node", "sketch.n", "sketch.bits"))
    work.delete()
    return found


def _close(pairs: DataFrame, sketched: DataFrame, similarity: float, work: Scratch) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose sketches allow the similarity, with ``far``, the
    share of their shingles that sketches tell apart."""
    left = pairs.join(sketched.withColumnRenamed("node", "a"), "a")
    right = sketched.select(F.col("node").alias("b"), F.col("n").alias("other_n"), F.col("bits").alias("other_bits"))
    both = left.join(right, "b").where(_sketches_allow(similarity, "other_"))
    return work(both.select("a", "b", (_places_apart("other_") / (F.col("n") + F.col("other_n"))).alias("far")))


def _closest(close: DataFrame) -> DataFrame:
    """Of the pairs the CLOSEST ones of each node."""
    sides = close.select("a", "b", "far").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "far"))
    place = F.row_number().over(Window.partitionBy("a").orderBy("far", "b"))
    few = sides.withColumn("place", place).where(F.col("place") <= CLOSEST)
    return few.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _alike(rows: DataFrame, first: DataFrame, close: DataFrame, similarity: float, keep: Scratch) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose exact shingle sets are as similar as that."""
    work = Scratch(rows.sparkSession, "copies")
    sides = work(close.select("a", "b", F.explode(F.array("a", "b")).alias("node")))
    wanted = work(sides.join(first.select("node", "at"), "node").drop("node"))
    sets = _rows_at(rows, wanted).select("at", shingle_sets(F.col("text")).alias("s"))
    both = wanted.join(sets, "at").groupBy("a", "b").agg(F.collect_list("s").alias("s"))
    both = both.select("a", "b", F.get("s", F.lit(0)).alias("sa"), F.get("s", F.lit(1)).alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    either_has = F.size("sa") + F.size("sb") - common
    links = keep(both.where(common >= F.lit(similarity) * either_has).select("a", "b"))
    work.delete()
    return links


def _connected(
    rows: DataFrame, first: DataFrame, close: DataFrame, similarity: float, labels: DataFrame | None = None
) -> DataFrame:
    """``labels`` (node, label) with the pairs of ``close`` counted in that are alike.

    The closest pairs of each node are compared first, then every other pair that these leave
    apart: in a group of copies most are connected by then, so the sets that are shuffled and
    the links that are searched grow with its members, not with its pairs.
    """
    work = Scratch(rows.sparkSession, "copies")
    closest = work(_closest(close))
    links = _alike(rows, first, closest, similarity, work)
    labels = components(links, "copies") if labels is None else joined_components(labels, links, "copies")
    others = work(still_apart(close.join(closest, ["a", "b"], "left_anti"), labels))
    if not others.isEmpty():
        labels = joined_components(labels, _alike(rows, first, others, similarity, work), "copies")
    work.delete()
    return labels


def fingerprint_pairs(first: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a`` < ``b`` of nodes by the fingerprints ``fp`` of ``first``: each node with the
    first one of its fingerprint, and the first ones of fingerprints that link."""
    work = Scratch(first.sparkSession, "simhash")
    owners = work(first.groupBy("fp").agg(F.min("node").alias("owner")))
    linked = work(links(owners.select("fp"), radius))
    equal = first.join(owners, "fp").where("node <> owner").select(F.col("owner").alias("a"), F.col("node").alias("b"))
    met = linked.join(owners.select(F.col("fp").alias("a"), F.col("owner").alias("one")), "a").join(
        owners.select(F.col("fp").alias("b"), F.col("owner").alias("other")), "b"
    ).select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b"))
    pairs = stored(equal.unionByName(met), "simhash")
    work.delete()
    return pairs


def near_copy_labels(rows: DataFrame, first: DataFrame, similarity: float) -> DataFrame:
    """(node, label) of each ``node`` of ``first`` that chains of nodes whose shingle sets are at
    least ``similarity`` alike connect with others; the label is the smallest of them.

    Texts whose fingerprints link are compared first. What fingerprints miss is found by
    first shingles: up to FEW that meet are compared each with each. In larger crowds everyone
    is first compared with the two before it; then all pairs that this has not connected are
    compared.
    """
    work = Scratch(rows.sparkSession, "copies")
    by_fingerprint = fingerprint_pairs(first)
    # Texts of one hash are one while they meet; from here on each is a node.
    met = work(_meetings(rows, similarity).join(first.select("k1", "node"), "k1").drop("k1"))
    crowds = met.where(F.col("m") > FEW)
    in_order = Window.partitionBy("token").orderBy("n", "node")
    lagged = crowds.select("node", "n", "rest", *[F.lag(F.struct("node", "n", "rest"), k).over(in_order).alias(f"o{k}") for k in (1, 2)])
    nearest = lagged.select("node", "n", "rest", F.explode(F.array("o1", "o2")).alias("o")).where(F.col("o").isNotNull() & _may_be_alike(similarity, "o."))
    nearest = nearest.select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b"))
    nearest = nearest.unionByName(_pairs(met.where(F.col("m") <= FEW), similarity)).unionByName(by_fingerprint)
    nearest = work(nearest.distinct())
    nodes = nearest.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowds.select("node"))
    sketched = _sketched(rows, first, nodes.distinct(), work)
    labels = _connected(rows, first, _close(nearest, sketched, similarity, work), similarity)
    labelled = crowds.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_token = Window.partitionBy("token")
    apart = labelled.withColumn("several", F.min("label").over(of_token) < F.max("label").over(of_token)).where("several")
    carried = sketched.select("node", _folded(F.col("bits"), F.least(F.size("bits"), F.lit(CARRIED))).alias("bits"))
    apart = work(_with_heads(work(apart.drop("several"))).join(carried, "node"))
    close = _close(_pairs(apart, similarity, "label", once=True), sketched, similarity, work)
    labels = _connected(rows, first, close, similarity, labels)
    work.delete()
    return labels


def known_by_place(df: DataFrame) -> bool:
    """Whether Spark can tell the file and place of a row of ``df``."""
    try:
        return bool(df.select("_metadata.file_path", "_metadata.row_index").columns)
    except AnalysisException:
        return False


def drop_near_copies(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, from_files: bool = False
) -> DataFrame:
    """``df`` with one row of each group of exact and near copies: the one with the smallest
    id (nulls last; of repeated ids any one row). All columns stay as they are.

    Texts whose SimHash fingerprints link are near copies if their exact shingle sets are as
    similar as ``similarity``; so are all others of that similarity, however far apart their
    fingerprints. Groups are all texts that chains of near copies connect. Null texts count as empty, and
    empty texts are copies of each other. Texts too short for a shingle are compared whole.
    Equal texts are known by 128 bits of hashes.

    ``from_files`` says that ``df`` is a table as it is read from files; its rows are then
    known by file and place, otherwise ``df`` is stored to number them.
    """
    keep = Scratch(df.sparkSession, "copies")
    if from_files:
        numbered = df.withColumn("__at", F.struct("_metadata.file_path", "_metadata.row_index"))
    else:
        number = F.struct(F.lit("").alias("file_path"), F.monotonically_increasing_id().alias("row_index"))
        numbered = stored(df.withColumn("__at", number), "copies")
    whole = F.coalesce(column(text), F.lit(""))
    rows = numbered.select(
        F.col("__at").alias("at"), column(id_column).alias("id"), whole.alias("text"),
        F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2"),
    )
    printed = rows.withColumn("fp", fingerprint(F.col("text"))).drop("text")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "at")
    first = printed.groupBy("k1", "k2").agg(F.min(order).alias("order"), F.any_value("fp").alias("fp"))
    first = first.select("k1", "fp", "order", F.col("order.at").alias("at"))
    first = keep(first.withColumn("node", F.monotonically_increasing_id()))
    labels = near_copy_labels(rows, first, similarity)
    best = first.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(F.min("order").alias("order"))
    kept = keep(best.select(F.col("order.at").alias("at")))
    gone = stored(rows.select("at").join(kept, "at", "left_anti"), "copies")
    keep.delete()
    return listed_marks(numbered, "__at", gone, "at", "__gone").where("not __gone").drop("__gone", "__at")


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """One row per row of ``df``: the id, ``fp`` and ``component``, the smallest id that
    links reach, the own included.

    Null and wordless texts have fingerprint 0 and are linked like any other; so are
    repeated rows. A null id counts as none: a component of such rows only has a null id.
    An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(df.select(column(id_column).alias("id"), fingerprint(column(text), shingle).alias("fp")), "simhash")
    fps = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash")
    labels = components(links(fps.select("fp"), radius), "simhash")
    linked = labels.withColumnRenamed("node", "fp").join(fps, "fp")
    smallest = stored(linked.groupBy("label").agg(F.min("first").alias("component")), "simhash")
    reached = labels.withColumnRenamed("node", "fp").join(smallest, "label").select("fp", "component")
    owner = stored(
        fps.join(reached, "fp", "left").select("fp", F.coalesce("component", "first").alias("component")), "simhash"
    )
    return rows.join(owner, "fp").select(F.col("id").alias(id_column), "fp", "component")
