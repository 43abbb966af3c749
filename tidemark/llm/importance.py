"""Importance resampling towards a target distribution, by bit-sliced sums.

Features are hashed into buckets. What a bucket is worth is the logarithm of its share in the
target over its share in the corpus, a whole number. A document weighs the sum over its
features. The sum is taken in slices of bits: plane *i* of a document has a bit for every
bucket whose count has bit *i*; plane *j* of the gains has one for every bucket whose gain has
bit *j*, in two's complement, so the highest plane counts negatively. A plane of either kind
and-ed, its bits counted, stands for that many times 2^(i+j). The result is exact.

Corpus counts leave each task as one number per bucket it has seen. Ranks come from rows
dealt by range of their whole order, so no task sorts all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, stored

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Documents whose planes are made together, and features hashed at a time.
TOGETHER = 256
CHUNK = 1 << 18

# A-Z lower-cased; what is no ASCII letter, digit or byte of another character is a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split(b" ") if text else []


def feature_buckets(words: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``longest`` words, repeats included, in bounded pieces."""
    for n in range(1, longest + 1):
        for i in range(0, len(words) - n + 1, CHUNK):
            some = words[i : min(i + CHUNK, len(words) - n + 1)] if n == 1 else [
                b" ".join(words[k : k + n]) for k in range(i, min(i + CHUNK, len(words) - n + 1))
            ]
            yield np.fromiter(map(zlib.crc32, some), np.uint32, len(some)).astype(np.int64) % buckets


def document_counts(text: str | None, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The buckets of a text, how often each comes, and the number of words."""
    words = [w for w in words_of(text) if w]
    total = np.zeros(buckets, np.int64)
    for found in feature_buckets(words, buckets, longest):
        total += np.bincount(found, minlength=buckets)
    at = np.flatnonzero(total)
    return at, total[at], len(words)


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket`` and ``n``, the features of all texts in it. Each task adds up its own first."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch["text"]:
                for found in feature_buckets([w for w in words_of(value) if w], buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": total[at]})

    counted = df.select(column(text).alias("text")).mapInPandas(of, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) (S + B)) / ((s + 1) (T + B)))) of each of the B buckets."""
    n = len(corpus)
    more, less = float(int(corpus.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def bit_planes(at: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> np.ndarray:
    """One row of 64-bit words per document with the bits ``at`` set in ``rows``."""
    bits = np.zeros((n_rows, -(-width // 64) * 64), bool)
    bits[rows, at] = True
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class GainPlanes:
    """Gains of all buckets as planes in two's complement."""

    def __init__(self, values: np.ndarray):
        self.width = len(values)
        top = max((int(abs(v)).bit_length() for v in (values.min(initial=0), values.max(initial=0))), default=0)
        self.planes = []
        for j in range(top + 1):
            at = np.flatnonzero((values >> j) & 1)
            plane = bit_planes(at, np.zeros(len(at), np.int64), 1, self.width)[0]
            self.planes.append((plane, -(1 << j) if j == top else 1 << j))

    def weights(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The sum of gains over the features of each document, from its buckets and counts."""
        total = np.zeros(len(documents), np.int64)
        rows = np.repeat(np.arange(len(documents)), [len(at) for at, _ in documents])
        if not len(rows):
            return total
        at, counts = (np.concatenate(x) for x in zip(*documents))
        for i in range(int(counts.max()).bit_length()):
            has = np.flatnonzero((counts >> i) & 1)
            if not len(has):
                continue
            mine, inside = np.unique(rows[has], return_inverse=True)
            plane = bit_planes(at[has], inside, len(mine), self.width)
            for gain, worth in self.planes:
                total[mine] += np.bitwise_count(plane & gain).sum(1, dtype=np.int64) * (worth << i)
        return total


def feature_weights(df: DataFrame, values: np.ndarray, text: str, longest: int, out: str) -> DataFrame:
    """``df`` with a struct ``out``: ``n_words``, ``n_features``, ``weight``."""

    @F.pandas_udf("n_words bigint, n_features bigint, weight bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        planes = GainPlanes(values)
        for texts in batches:
            parts = []
            for i in range(0, len(texts), TOGETHER):
                found = [document_counts(t, len(values), longest) for t in texts.iloc[i : i + TOGETHER]]
                parts.append(pd.DataFrame({
                    "n_words": [n for _, _, n in found], "n_features": [int(c.sum()) for _, c, _ in found],
                    "weight": planes.weights([(at, c) for at, c, _ in found]),
                }))
            yield pd.concat(parts) if parts else pd.DataFrame({"n_words": [], "n_features": [], "weight": []}, dtype="int64")

    return df.withColumn(out, of(column(text)))


def noise(id_column: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from sha256 of ``seed:id``; a null id counts as ''."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u))).cast("bigint")


def resample(
    df: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``df``: the id, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred (rounded down) are
    drawn: those of the highest score, which is the weight plus noise that the id decides. Ties
    go to the smaller id, nulls last; repeated rows are drawn each for itself, in any order.
    The others have no rank.

    Null and wordless texts have no features and weight 0. An empty target or corpus counts as
    one of no features. An empty table gives no rows. Other columns are not looked at.
    """
    counted = stored(
        bucket_counts(df, text, buckets, longest).withColumn("side", F.lit("corpus")).unionByName(
            bucket_counts(target, target_text, buckets, longest).withColumn("side", F.lit("target"))), "importance")
    sides = {side: np.zeros(buckets, np.int64) for side in ("corpus", "target")}
    for r in counted.collect():  # two rows per bucket at most
        sides[r["side"]][r["bucket"]] = r["n"]
    values = gains(sides["corpus"], sides["target"])

    given = df.select(column(id_column).alias("id"), column(text).alias("text"))
    weighed = feature_weights(given, values, "text", longest, "f").select("id", "f.*")
    score = (F.col("weight") + noise(F.col("id"), seed)).alias("score")
    weighed = stored(weighed.select("id", (F.col("n_words") >= least_words).alias("may"), "n_features", "weight", score), "importance")
    drawn = weighed.where("may").count() * percent // 100

    order = [F.desc("may"), F.desc("score"), F.col("id").asc_nulls_last()]
    # The id that Spark gives a sorted row: number of its range, then its place there.
    dealt = weighed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    dealt = stored(dealt, "importance")
    part = F.shiftright("__at", 33)
    sizes = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    ranked = dealt.withColumn("__part", part).join(F.broadcast(before), "__part")  # one row per range
    rank = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranked.select(
        F.col("id").alias(id_column), "n_features", "weight", "score", F.when(F.col("may") & (rank <= drawn), rank).alias("rank")
    )


def oracle_sql(percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> str:
    """SQL that gives the same rows from ``documents`` and ``benchmark``, for single words.

    The engine has no crc32: it is folded over the bytes of each distinct word, by the
    remainders of the 256 bytes.
    """
    remainders = [0] * 256
    for b in range(256):
        r = b
        for _ in range(8):
            r = r >> 1 ^ (0xEDB88320 if r & 1 else 0)
        remainders[b] = r
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
    with texts as (select row_number() over () as row, doc_id, {words} as words from documents),
    found as (select row, unnest(words) as word from texts),
    wanted as (select unnest({words}) as word from benchmark),
    vocabulary as (select word, hex(encode(word)) as bytes from (select word from found union select word from wanted)),
    hashed as (
        select word, xor(list_reduce(
            list_prepend(4294967295::ubigint, list_transform(range(0, length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1 : 2 * i + 2])::ubigint)),
            lambda c, b: xor(c >> 8, ({remainders}::ubigint[])[xor(c & 255, b)::int + 1])), 4294967295::ubigint) % {buckets} as bucket
        from vocabulary),
    s as (select bucket, count(*) as s from found join hashed using (word) group by bucket),
    t as (select bucket, count(*) as t from wanted join hashed using (word) group by bucket),
    sums as (select (select coalesce(sum(s), 0)::double from s) as s_all, (select coalesce(sum(t), 0)::double from t) as t_all),
    gain as (
        select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (s_all + {buckets}) / ((s::double + 1) * (t_all + {buckets}))))::bigint as gain
        from s left join t using (bucket), sums),
    summed as (select row, sum(gain)::bigint as weight from found join hashed using (word) join gain using (bucket) group by row),
    scored as (
        select doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
        from texts left join summed using (row)),
    ranked as (
        select *, n_features >= {least_words} as may,
            row_number() over (partition by n_features >= {least_words} order by score desc, doc_id) as place,
            count(*) filter (n_features >= {least_words}) over () * {percent} // 100 as drawn
        from scored)
    select doc_id, n_features, weight, score, case when may and place <= drawn then place end as rank from ranked
    """
