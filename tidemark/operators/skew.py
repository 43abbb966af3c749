"""Finding keys that hold a large share of all rows, and joining them apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import besides, name, names
from tidemark.session import stored

# Rows that one task can sort well. A key with more is hot, however large the table is.
HOT_ROWS = 5_000_000

ROWS = "__rows"


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the key columns of the left side only.

    Spark plans ``<=>`` as a hash or sort-merge join like ``=``.
    """
    renamed = right.select(
        *[name(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *names(besides(right.columns, keys)),
    )
    condition = reduce(
        Column.__and__, [name(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__k{i}" for i in range(len(keys))])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Keys of ``df`` with more than ``hot_rows`` rows, with their number of ``__rows``; None
    when there are none.

    Runs one job that reads the key columns only, counts in the map tasks before it shuffles
    and stores what it finds: at most one row per ``hot_rows`` rows of ``df``. Spark knows the
    size of that table and chooses by it how to join. ``hot_rows=None`` takes it for granted
    that no key is hot.
    """
    if hot_rows is None:
        return None
    counts = df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias(ROWS))
    hot = stored(counts.where(F.col(ROWS) > hot_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def rows_of(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the hot keys."""
    return match(df, hot.select(*names(keys)), keys, "left_semi")


def rows_besides(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of all other keys."""
    return match(df, hot.select(*names(keys)), keys, "left_anti")


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (but for maps, which have none)."""
    return F.xxhash64(*[name(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``df``, nearly distinct, for the right side of a semi- or anti-join.

    Repeats are dropped in the map tasks and again per half of the map tasks. A full
    distinct would leave the rows partitioned by key; the join would then not shuffle them
    again, and adaptive execution only splits skewed partitions of joins that shuffle both
    sides.
    """
    half = F.pmod(F.spark_partition_id(), F.lit(2)).alias("__half")
    return df.select(*names(keys), half).distinct().select(*names(keys))
