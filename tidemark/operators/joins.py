"""Key joins: semi, anti, null-safe, and left joins whose right side may be skewed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import name, names
from tidemark.operators import skew
from tidemark.operators.skew import HOT_ROWS


def key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on same-named keys that keeps one copy of each key column.

    ``null_safe`` lets a null key part match a null key part.
    """
    return skew.match(left, right, keys, how) if null_safe else left.join(right, list(keys), how)


def inner_join_keys(
    df: DataFrame, affected: DataFrame, keys: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """Rows whose key is among ``affected``; never multiplies rows of ``df``.

    Adaptive execution splits a skewed ``df`` as long as nothing after this join counts on
    its partitioning. Where a join on the same keys follows, pass the ``hot`` keys of
    ``df``: their rows are then picked without a shuffle.
    """
    if hot is None:
        return key_join(df, skew.distinct_keys(affected, keys), keys, "left_semi")
    ordinary = key_join(skew.rows_besides(df, hot, keys), affected.select(*names(keys)).distinct(), keys, "left_semi")
    # At most one row per hot key.
    listed = F.broadcast(skew.rows_of(affected.select(*names(keys)), hot, keys).distinct())
    return ordinary.unionByName(key_join(skew.rows_of(df, hot, keys), listed, keys, "left_semi"))


semi_join_in = inner_join_keys


def anti_join(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    distinct: bool = True,
) -> DataFrame:
    """Rows whose key is not in ``other``. A null key never matches unless ``null_safe``.

    ``distinct=False`` skips dropping repeated keys of an ``other`` known to have none.
    """
    excluded = skew.distinct_keys(other, keys) if distinct else other.select(*names(keys))
    return key_join(df, excluded, keys, "left_anti", null_safe)


not_exists = anti_join


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """SQL ``NOT IN``: empty when ``other`` holds a null, and null values of ``df`` only
    pass when ``other`` is empty.

    Spark's own plan for ``NOT IN`` broadcasts the whole list. Here the list is only
    counted, and the exclusion is an ordinary anti-join.
    """
    values = other.select(name(other_column or column).alias(column))
    facts = values.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(name(column).isNull()).alias("nulls")
    )
    has_null = facts.select(F.col("nulls") > 0).scalar()
    is_empty = facts.select(F.col("n") == 0).scalar()
    kept = anti_join(df, values, [column])
    return kept.where(is_empty | (~has_null & name(column).isNotNull()))


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain left join; right for a ``right`` whose keys are about evenly spread."""
    return left.join(right, list(keys), "left")


def left_join_many(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join to a ``right`` in which one key may hold a large share of the rows.

    Adaptive execution cannot split a skewed right side of a left join. So hot keys are
    looked for first (or passed as ``hot``). Without any this is the plain join. With some,
    their right rows are dealt out over salts by a hash of the row, as many as ``hot_rows``
    goes into the key's rows, and each of their left rows meets every salt. A hot key has
    right rows for sure, so an inner join is enough there.
    """
    if hot is None:
        hot = skew.hot_keys(right, keys, hot_rows)
    if hot is None:
        return left_join(left, right, keys)
    known = hot.dropna(subset=list(keys))  # a null key matches nothing
    ordinary = left_join(skew.rows_besides(left, known, keys), skew.rows_besides(right, known, keys), keys)
    salts = known.select(
        *names(keys), F.ceil(F.col(skew.ROWS) / F.lit(float(hot_rows or HOT_ROWS))).cast("long").alias("__salts")
    )
    dealt = right.withColumn("__row", skew.row_hash(right))
    heavy = (
        skew.match(dealt, salts, keys)
        .withColumn("__salt", F.pmod(F.col("__row"), F.col("__salts"))).drop("__row", "__salts")
    )
    every = (
        skew.match(left, salts, keys)
        .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1))).drop("__salts")
    )
    met = every.join(heavy, [*keys, "__salt"], "inner").drop("__salt")
    return ordinary.unionByName(met.select(*names(ordinary.columns)))


def left_join_chain(base: DataFrame, *sides: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Left joins one after the other, each with its own keys."""
    return reduce(lambda acc, side: left_join_many(acc, side[0], side[1]), sides, base)


def inner_join_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of log rows to the dimension they point to."""
    return df.join(lookup, list(keys), "inner")


def left_join_counts(
    planned: DataFrame,
    done: DataFrame,
    key: str,
    done_key: str,
    planned_column: str = "nr_of_runs",
    out: str = "nr_runs_to_go",
) -> DataFrame:
    """Planned rows with runs left: planned number minus rows in ``done``."""
    counts = done.groupBy(name(done_key).alias(key)).agg(F.count(F.lit(1)).alias("__runs"))
    runs = F.coalesce(F.col("__runs"), F.lit(0))
    return (
        planned.join(counts, [key], "left")
        .where(runs < name(planned_column))
        .withColumn(out, name(planned_column) - runs)
        .drop("__runs")
    )


def insert_select_where_new(existing: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not in ``existing`` yet: the rows to append."""
    return anti_join(candidates, existing, keys, null_safe=True)


def grid(df: DataFrame, dimensions: dict[str, Sequence[object]]) -> DataFrame:
    """Each row of ``df`` once per combination of the listed values (a map-side explode)."""
    for column, values in dimensions.items():
        df = df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def exclude_listed(df: DataFrame, value: str, listing: str) -> DataFrame:
    """Drop rows whose ``value`` is in their own array column ``listing``."""
    return df.where(~F.array_contains(name(listing), name(value)))
