"""Latest rows, slowly changing dimensions and validity joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import besides, name, names, row_checksum
from tidemark.operators.ordered import KeyedOrder
from tidemark.operators.skew import HOT_ROWS
from tidemark.session import stored

# Fixed value: end of validity of a current row.
OPEN_END = "9999-12-31"
HISTORY_COLUMNS = ("valid_from", "valid_to", "is_current")


def descending(columns: Sequence[str]) -> list[Column]:
    return [name(c).desc() for c in columns]


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the largest by ``order_by``, ties by ``tie_break``.

    ``tie_break`` defaults to all other sortable columns, so the pick does not depend on
    how the rows are laid out. Spark turns the filter on rank 1 into a limit per map task
    before the shuffle; a hot key thus sends one row per task.
    """
    if tie_break is None:
        sortable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        tie_break = besides(sortable, [*keys, *order_by])
    w = Window.partitionBy(*names(keys)).orderBy(*descending([*order_by, *tie_break]))
    return (
        df.withColumn("__rank", F.row_number().over(w))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


top1_per_key = dedup_latest


def row_number_per_header(
    lines: DataFrame,
    header_keys: Sequence[str],
    order_by: Sequence[str],
    out: str = "row_num",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rank of each line in its document, newest first; ``order_by`` must be a total order."""
    rank = KeyedOrder(lines, header_keys, order_by, hot_rows, descending=True)
    return rank.plain(rank.number(rank.sliced(lines), out))


def lag_checksum(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    checked: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``row_checksum`` and ``previous_checksum`` of the row before it."""
    marked = df.withColumn("row_checksum", row_checksum(checked))
    time = KeyedOrder(marked, keys, [order_by, "row_checksum"], hot_rows)
    return time.plain(time.previous(time.sliced(marked), "row_checksum", "previous_checksum"))


def scd2_history(
    df: DataFrame,
    keys: Sequence[str],
    valid_from_column: str,
    exclude_from_check: Sequence[str] = (),
    first_valid_from: str | None = None,
    null_token: str = "",
    escape: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Type-2 history of an append-only change table.

    Rows equal to the row before them are dropped. The others get ``valid_from``,
    ``valid_to`` (one millisecond before the next kept row, or the open end) and
    ``is_current``. ``first_valid_from`` replaces the start of the first version of a key.
    Zone-less timestamps stay zone-less.
    """
    checked = besides(df.columns, [valid_from_column, *exclude_from_check])
    marked = df.withColumn("__checksum", row_checksum(checked, null_token, escape))
    time = KeyedOrder(marked, keys, [valid_from_column, "__checksum"], hot_rows)
    compared = time.previous(time.sliced(marked), "__checksum", "__previous")
    kept = compared.where(F.col("__checksum") != F.coalesce(F.col("__previous"), F.lit("")))
    ended = time.next(kept, valid_from_column, "__next")

    kind = df.schema[valid_from_column].dataType.typeName()
    moment = "timestamp_ntz" if kind == "timestamp_ntz" else "timestamp"
    start = name(valid_from_column).cast(moment)
    if first_valid_from is not None:
        first = F.lit(first_valid_from).cast("date").cast(moment)
        start = F.when(F.col("__previous").isNull(), first).otherwise(start)
    end = F.try_subtract(F.col("__next").cast(moment), F.expr("INTERVAL '0.001' SECOND"))
    return (
        ended.withColumn("valid_from", start)
        .withColumn("valid_to", F.coalesce(end, F.lit(OPEN_END).cast(moment)))
        .withColumn("is_current", F.col("__next").isNull())
        .select(*names(besides(df.columns, HISTORY_COLUMNS)), *HISTORY_COLUMNS)
    )


def current_only(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def with_version_end(
    versions: DataFrame,
    keys: Sequence[str],
    valid_from: str,
    out: str = "valid_to",
    open_end: str = OPEN_END,
    tie_break: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``lead(valid_from)`` with an open end for the last version of a key."""
    kind = versions.schema[valid_from].dataType
    time = KeyedOrder(versions, keys, [valid_from, *tie_break], hot_rows)
    ended = time.next(time.sliced(versions), valid_from, out)
    return time.plain(ended.withColumn(out, F.coalesce(name(out), F.lit(open_end).cast(kind))))


def range_join_validity(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    hot_rows: int | None = HOT_ROWS,
    overlapping: bool = False,
) -> DataFrame:
    """Facts with the version of their key that is valid at ``at`` (from <= at < to).

    The validity intervals of a key must not overlap, as histories guarantee; see
    :func:`overlapping_versions`. With ``valid_to=None`` a version is valid until the next one
    starts. Facts and versions are merged into one ordered stream per key and the latest
    version is carried forward. That costs one sort and no comparison of all facts with all
    versions of a key, however many of either there are.

    With ``overlapping`` a fact comes once for each version that is valid at its time.
    """
    if overlapping:
        if valid_to is None:
            raise ValueError("versions that overlap need a valid_to")
        return _range_join_slices(facts, versions, keys, at, valid_from, valid_to, hot_rows)
    carried = besides(versions.columns, keys)
    left = facts.where(name(at).isNotNull()).select(
        *names(keys),
        name(at).alias("__at"),
        F.lit(1).alias("__side"),
        F.struct(*[name(c) for c in facts.columns]).alias("__fact"),
    )
    started = name(valid_from) < name(valid_to) if valid_to else name(valid_from).isNotNull()
    right = versions.where(started).select(
        *names(keys),
        name(valid_from).alias("__at"),
        F.lit(0).alias("__side"),
        F.struct(*names(carried)).alias("__version"),
    )
    for k in keys:
        left, right = left.where(name(k).isNotNull()), right.where(name(k).isNotNull())
    merged = left.unionByName(right, allowMissingColumns=True)
    time = KeyedOrder(merged, keys, ["__at", "__side"], hot_rows)
    latest = time.latest(time.sliced(merged), "__version", "__valid")
    ended = F.col("__at") < F.col(f"__valid.`{valid_to}`") if valid_to else F.col("__valid").isNotNull()
    return (
        latest.where(F.col("__side") == 1)
        .where(ended)
        .select(
            *[F.col(f"__fact.`{c}`").alias(c) for c in facts.columns],
            *[F.col(f"__valid.`{c}`").alias(c) for c in carried],
        )
    )


def overlapping_versions(
    versions: DataFrame,
    keys: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Versions that are still valid when the next one of their key starts, with its start
    in ``next_from``. No rows: no two versions of a key overlap."""
    known = versions.where(name(valid_from) < name(valid_to))
    time = KeyedOrder(known, keys, [valid_from, valid_to], hot_rows)
    followed = time.plain(time.next(time.sliced(known), valid_from, "next_from"))
    return followed.where(F.col("next_from") < name(valid_to))


# Facts of a key that are compared with the versions of a slice of time.
SLICE_FACTS = 512


def _range_join_slices(facts, versions, keys, at, valid_from, valid_to, hot_rows) -> DataFrame:
    """Every fact with every version valid at its time.

    The time of each key is cut into slices of SLICE_FACTS facts. A version goes to the
    slices from its start to its end, found by two ordered passes over starts and ends of
    slices and versions; so it is compared in vain with the facts of its first and its last
    slice at most. Key and slice are what both sides are joined by, so a hot key is spread
    over as many tasks as it has slices.
    """
    has_key = reduce(Column.__and__, [name(k).isNotNull() for k in keys])
    carried = besides(versions.columns, keys)
    known = facts.where(has_key & name(at).isNotNull()).select(
        *names(keys), name(at).alias("__at"), F.struct(*[name(c) for c in facts.columns]).alias("__fact")
    )
    time = KeyedOrder(known, keys, ["__at"], hot_rows)
    numbered = time.plain(time.number(time.sliced(known), "__nr"))
    numbered = stored(numbered.withColumn("__slice_nr", F.floor((F.col("__nr") - 1) / SLICE_FACTS)).drop("__nr"), "facts")
    # A slice begins with its first fact; facts of one moment may be in two slices.
    begins = numbered.groupBy(*names(keys), "__slice_nr").agg(F.min("__at").alias("valid_from"), F.max("__at").alias("__last"))
    begins = stored(begins, "slices")
    ranges = versions.where(has_key & (name(valid_from) < name(valid_to))).select(
        *names(keys), name(valid_from).alias("__from"), name(valid_to).alias("__to"), F.struct(*names(carried)).alias("__version")
    )
    # First slice that ends at the start of the version or later: the one after the last
    # slice that ends before it. Last slice: the last that begins before the version ends.
    ended = begins.select(*names(keys), F.col("__slice_nr").alias("__ended"), F.col("__last").alias("__edge"))
    begun = begins.select(*names(keys), F.col("__slice_nr").alias("__begun"), F.col("valid_from").alias("__edge"))
    placed = _last_before(ranges, ended, keys, "__from", "__ended", hot_rows)
    placed = _last_before(placed, begun, keys, "__to", "__begun", hot_rows).where(F.col("__begun").isNotNull())
    first = F.coalesce(F.col("__ended") + 1, F.lit(0).cast("bigint"))
    spread = placed.where(first <= F.col("__begun")).select(
        *names(keys), "__from", "__to", "__version", F.explode(F.sequence(first, F.col("__begun"))).alias("__slice_nr")
    )
    met = numbered.join(spread, [*keys, "__slice_nr"]).where((F.col("__at") >= F.col("__from")) & (F.col("__at") < F.col("__to")))
    return met.select(
        *[F.col(f"__fact.`{c}`").alias(c) for c in facts.columns], *[F.col(f"__version.`{c}`").alias(c) for c in carried]
    )


def _last_before(rows: DataFrame, edges: DataFrame, keys, at: str, value: str, hot_rows) -> DataFrame:
    """``rows`` with the ``value`` of the latest edge of their key strictly before ``at``."""
    left = rows.select(*names(keys), name(at).alias("__t"), F.lit(0).alias("__side"), F.struct(*[name(c) for c in rows.columns]).alias("__row"))
    right = edges.select(*names(keys), F.col("__edge").alias("__t"), F.lit(1).alias("__side"), name(value).alias("__value"))
    merged = left.unionByName(right, allowMissingColumns=True)
    # At one moment rows come first: an edge counts from the next moment on.
    time = KeyedOrder(merged, keys, ["__t", "__side", "__value"], hot_rows)
    latest = time.latest(time.sliced(merged), "__value", "__latest")
    return latest.where(F.col("__side") == 0).select("__row.*", F.col("__latest").alias(value))
