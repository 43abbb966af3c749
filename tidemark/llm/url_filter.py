"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed URLs are compared in canonical form. A Bloom filter of them, in blocks of 256 bits,
is sent to every executor and lets URLs pass that cannot be listed; only possible hits are
shuffled and joined exactly. The filter has a largest size. Beyond it there are more false
hits to join, never a wrong verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import UPPER, LOWER, column, stored

# Blocks of the filter at most: 2^18 rows of eight ints, some 20 MB where it is broadcast.
MAX_BLOCKS = 1 << 18
URLS_PER_BLOCK = 16
LANES = 8


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.translate(_after_scheme(url, r"^([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' if there is no ``://``."""
    return _after_scheme(url, r"^[^/?#]*([^?#]*)")


def _after_scheme(url: Column, pattern: str) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    return F.when(has, F.regexp_extract(after, pattern, 1)).otherwise(F.lit(""))


# Query parameters that only say where a visit came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|mc_[^=]*)(=|$)"


def canonical(url: Column) -> Column:
    """One form for addresses of the same page: no scheme, user, port, ``www.`` or ``m.``, no
    fragment, no tracking parameters, the others sorted, no final slash or ``.html``.
    Null if there is no ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^[^@]*@|:\d*$", ""), r"^((www|m)\.)+", "")
    path = F.regexp_replace(path_of(url), r"(/|/index\.html?|\.html?)$", "")
    asked = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(F.contains(url, F.lit("://")), F.concat(host, path, tail))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls if none fits. Of equally long ones the
    first in alphabetical order counts."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(str(r)), str(r))):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name = F.when(fits, F.lit(str(r))) if name is None else name.when(fits, F.lit(str(r)))
        verdict = F.when(fits, F.lit(r.verdict)) if verdict is None else verdict.when(fits, F.lit(r.verdict))
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit in each of the eight lanes of a block."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(LANES)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows (block, lane0 .. lane7); keys are combined in the map tasks."""
    return keys.groupBy(_block(column(key), blocks).alias("__block")).agg(
        *[F.bit_or(b).alias(f"__lane{i}") for i, b in enumerate(_bits(column(key)))]
    )


def may_contain(df: DataFrame, key: str, bloom: DataFrame, blocks: int, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false only for keys that are surely not in the filter.

    The filter is broadcast: it has ``blocks`` rows of 40 bytes at most.
    """
    joined = df.withColumn("__block", _block(column(key), blocks)).join(F.broadcast(bloom), "__block", "left")
    inside = F.lit(True)
    for i, b in enumerate(_bits(column(key))):
        inside = inside & (F.col(f"__lane{i}").bitwiseAND(b) == b)
    return joined.withColumn(out, F.coalesce(inside, F.lit(False))).drop("__block", *[f"__lane{i}" for i in range(LANES)])


def listed_marks(df: DataFrame, key: str, listed: DataFrame, listed_key: str, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: whether ``key`` is exactly one of the listed ones.

    ``df`` is read twice; a null key is not listed. Repeated listed keys are dropped in the
    map tasks and per half of them, so that the join shuffles both sides itself and adaptive
    execution can split a key that many rows share.
    """
    half = F.pmod(F.spark_partition_id(), F.lit(2)).alias("__half")
    wanted = stored(
        listed.select(column(listed_key).alias("__listed"), half).where(F.col("__listed").isNotNull()).distinct().drop("__half"),
        "listed",
    )
    blocks = max(1, min(MAX_BLOCKS, -(-wanted.count() // URLS_PER_BLOCK)))
    marked = may_contain(df, key, bloom_filter(wanted, "__listed", blocks), blocks, "__maybe")
    maybe = marked.where("__maybe").drop("__maybe")
    hit = maybe.join(wanted, column(key) == F.col("__listed"), "left_semi")
    missed = maybe.join(wanted, column(key) == F.col("__listed"), "left_anti")
    return (
        marked.where("not __maybe").drop("__maybe").withColumn(out, F.lit(False))
        .unionByName(missed.withColumn(out, F.lit(False)))
        .unionByName(hit.withColumn(out, F.lit(True)))
    )


def filter_urls(
    df: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url", listed_url: str = "url"
) -> DataFrame:
    """All columns of ``df`` and ``filter``, a struct of ``host``, ``path``, ``canonical``,
    ``rule`` and ``verdict`` (an input column of that name is replaced).

    The longest fitting rule decides (its host and all subdomains, paths that start with its
    path); else a URL is blocked if its canonical form is listed. Null URLs and those without
    ``://`` have empty host and path and no canonical form: no rule fits an empty host, and
    they are allowed. Repeated rows are judged each for itself; an empty list blocks nothing.
    """
    host, path = host_of(column(url)), path_of(column(url))
    parsed = df.withColumn("__canonical", canonical(column(url)))
    wanted = listed.select(canonical(column(listed_url)).alias("__url"))
    marked = listed_marks(parsed, "__canonical", wanted, "__url", "__is_listed")
    name, verdict = rule_for(host, path, rules)
    method = F.when(F.col("__is_listed"), F.lit("block")).otherwise(F.lit("allow"))
    result = F.struct(
        host.alias("host"), path.alias("path"), F.col("__canonical").alias("canonical"),
        name.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
    )
    return marked.withColumn("filter", result).drop("__canonical", "__is_listed")
