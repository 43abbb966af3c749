"""Change feeds and incremental reads."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import besides, key_bucket, name, names, row_checksum
from tidemark.operators.history import dedup_latest
from tidemark.operators.joins import key_join
from tidemark.session import stored

log = logging.getLogger(__name__)

# Names of the change-feed columns and change types.
CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
FEED_COLUMNS = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)
INSERT, PREIMAGE, POSTIMAGE, DELETE = "insert", "update_preimage", "update_postimage", "delete"

# Operations after which older changes can no longer be read.
DESTRUCTIVE_PATTERN = "%CREATE%TABLE%"
DESTRUCTIVE_OPERATIONS = ("REPLACE TABLE AS SELECT", "DROP COLUMNS", "RENAME COLUMN")
FEED_ENABLED_PATTERN = '%delta.enableChangeDataFeed":"true%'

UNKNOWN_VERSION = -1


def change_feed(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    version: int | Column,
    committed_at: datetime | Column,
    buckets: int | None = None,
) -> DataFrame:
    """Change rows that lead from one snapshot to the next.

    Both snapshots have one row per key. They meet in one full outer join; an update comes
    out as a pre-image and a post-image row.

    With ``buckets`` both are read once more before: keys are hashed into so many buckets,
    and the rows of each summed up on either side into a digest that their order does not
    change. Buckets with the same digest hold the same rows and are neither shuffled nor
    joined. Worth it for stored snapshots of which a small part changes; take more buckets
    than changes, for each change keeps the rows of its bucket.
    """
    columns = current.columns
    compared = besides(columns, keys)
    if buckets:
        unlike = unlike_buckets(previous, current, keys, buckets)
        previous, current = (_of_buckets(df, unlike, keys, buckets) for df in (previous, current))

    def side(df: DataFrame, label: str) -> DataFrame:
        return df.select(
            *[name(k).alias(f"{label}_k{i}") for i, k in enumerate(keys)],
            F.struct(*names(columns)).alias(label),
            row_checksum(compared, null_token="\\N", escape=True).alias(f"{label}_sum")
            if compared
            else F.lit("").alias(f"{label}_sum"),
        )

    same_key = reduce(
        Column.__and__,
        [F.col(f"old_k{i}").eqNullSafe(F.col(f"new_k{i}")) for i in range(len(keys))],
    )
    both = side(previous, "old").join(side(current, "new"), same_key, "full")

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    changes = (
        F.when(F.col("old_sum").isNull(), F.array(change(INSERT, "new")))
        .when(F.col("new_sum").isNull(), F.array(change(DELETE, "old")))
        .when(
            F.col("old_sum") != F.col("new_sum"),
            F.array(change(PREIMAGE, "old"), change(POSTIMAGE, "new")),
        )
    )
    return both.select(F.explode(changes).alias("c")).select(
        "c.row.*",
        F.col("c.kind").alias(CHANGE_TYPE),
        (version if isinstance(version, Column) else F.lit(version)).cast("long").alias(COMMIT_VERSION),
        (committed_at if isinstance(committed_at, Column) else F.lit(committed_at)).alias(COMMIT_TIMESTAMP),
    )


# Buckets a list of which is sent to every task: a few megabytes.
MAX_BUCKETS = 1 << 18


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One row per bucket of keys: number of rows and two order-free sums of row hashes,
    combined in the map tasks."""
    given = [name(c) for c in sorted(df.columns)]
    # Hashing passes nulls over, so where they stand is hashed too.
    row = [*given, *[c.isNull() for c in given]]
    return df.groupBy(key_bucket(keys, buckets).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(*row)).alias("digest"),
        F.bit_xor(F.xxhash64(F.lit("second"), *row)).alias("digest2"),
    )


def unlike_buckets(previous: DataFrame, current: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The ``__bucket`` numbers in which the two snapshots, of one row per key each, differ."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {MAX_BUCKETS}")
    if sorted(previous.columns) != sorted(current.columns):
        raise ValueError("snapshots of different columns have no bucket in common")
    both = bucket_digests(previous, keys, buckets).unionByName(bucket_digests(current, keys, buckets))
    alike = (F.count(F.lit(1)) == 2) & reduce(Column.__and__, [F.min(c) == F.max(c) for c in ("rows", "digest", "digest2")])
    return stored(both.groupBy("__bucket").agg(alike.alias("alike")).where("not alike").select("__bucket"), "unlike")


def _of_buckets(df: DataFrame, unlike: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    # At most MAX_BUCKETS numbers are broadcast.
    marked = df.withColumn("__bucket", key_bucket(keys, buckets))
    return marked.join(F.broadcast(unlike), "__bucket", "left_semi").drop("__bucket")


def scan_changes(feed: DataFrame, from_version: int | Column) -> DataFrame:
    """Changes from a version on. Store a feed partitioned by ``_commit_version`` and older
    files are not opened."""
    return feed.where(F.col(COMMIT_VERSION) >= from_version)


def latest_changes(
    feed: DataFrame,
    from_version: int | Column,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    append_delete: bool = False,
) -> DataFrame:
    """Rows to load from a feed: inserts and post-images, one latest row per key.

    ``append_delete`` also lets delete rows through and marks them in ``deleted_date``;
    the column is there (null) in every case. Without ``keys`` all changes are kept.
    """
    kinds = [INSERT, POSTIMAGE] + ([DELETE] if append_delete else [])
    rows = soft_delete_column(
        scan_changes(feed, from_version).where(F.col(CHANGE_TYPE).isin(kinds)), append_delete
    )
    if keys:
        order = [*(order_by or []), COMMIT_VERSION]
        rows = dedup_latest(rows, keys, list(dict.fromkeys(order)))
    rows = rows.drop(*FEED_COLUMNS)
    return rows if append_delete else rows.drop("deleted_date")


def dedup_last_change(
    feed: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Latest insert or post-image per key, feed columns kept."""
    loaded = feed.where(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE))
    return dedup_latest(loaded, keys, list(dict.fromkeys([*(order_by or []), COMMIT_VERSION])))


def soft_delete_column(changes: DataFrame, append_delete: bool = True) -> DataFrame:
    """``deleted_date``: commit time of delete rows, else null."""
    deleted = F.when(F.col(CHANGE_TYPE) == DELETE, F.col(COMMIT_TIMESTAMP))
    if not append_delete:
        deleted = F.lit(None).cast(changes.schema[COMMIT_TIMESTAMP].dataType)
    return changes.withColumn("deleted_date", deleted)


def scan_empty(df: DataFrame, append_delete: bool = False) -> DataFrame:
    """Schema of ``df`` without rows; the optimizer never opens the source."""
    empty = df.where(F.lit(False))
    return empty.withColumn("deleted_date", F.lit(None).cast("timestamp")) if append_delete else empty


def scan_history(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Last version and last destructive version of a table history (one pass)."""
    operation, parameters = F.col("operation"), F.col("operationParameters").cast("string")
    destructive = (
        operation.like(DESTRUCTIVE_PATTERN)
        | operation.isin(*DESTRUCTIVE_OPERATIONS)
        | F.coalesce(parameters.like(FEED_ENABLED_PATTERN), F.lit(False))
    )
    return history.groupBy(*names(keys)).agg(
        F.max("version").alias("source_last_update_version"),
        F.max(F.when(destructive, F.col("version"))).alias("source_first_valid_update_version"),
    )


def start_version(last_loaded: Column | int, first_valid: Column | int) -> Column:
    """First version to read: after the last load, but not before the first valid one."""
    loaded = last_loaded if isinstance(last_loaded, Column) else F.lit(last_loaded)
    valid = first_valid if isinstance(first_valid, Column) else F.lit(first_valid)
    return F.greatest(loaded + F.lit(1), valid)


class SourceBehindTarget(RuntimeError):
    """The source is older than what the target loaded; a full refresh is needed."""


@dataclass(frozen=True)
class SourceState:
    """What is known about a source when an increment is planned."""

    last_version: int
    first_valid_version: int = UNKNOWN_VERSION
    feed_enabled: bool = True


def plan_increment(
    source: DataFrame,
    feed: DataFrame | None,
    state: SourceState,
    last_loaded: int | None,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    append_delete: bool = False,
    incremental: bool = True,
) -> tuple[DataFrame, int | None]:
    """Rows to load now, and the version to remember afterwards (None: keep the old one).

    ============================  =========================================
    feed off                      warn, full read
    last loaded version unknown   warn, full read
    source at the loaded version  no rows
    source newer                  changes since the start version
    source older                  :class:`SourceBehindTarget`
    ============================  =========================================
    """
    version = max(state.last_version, state.first_valid_version)

    def everything() -> DataFrame:
        if not append_delete:
            return source
        kind = feed.schema[COMMIT_TIMESTAMP].dataType if feed is not None else "timestamp"
        return source.withColumn("deleted_date", F.lit(None).cast(kind))

    if not incremental:
        return everything(), None
    if not state.feed_enabled or feed is None:
        log.warning("change feed is off; reading the whole source")
        return everything(), version
    if last_loaded is None or last_loaded == UNKNOWN_VERSION:
        log.warning("last loaded version is unknown; reading the whole source")
        return everything(), version
    if version == last_loaded:
        return everything().where(F.lit(False)), None
    if version < last_loaded:
        raise SourceBehindTarget(
            f"source is at version {version}, target loaded {last_loaded}: run a full refresh"
        )
    first = max(last_loaded + 1, state.first_valid_version)
    return latest_changes(feed, first, keys, order_by, append_delete), version


def high_water_mark(
    df: DataFrame, column: str, target: DataFrame | None, target_column: str | None = None
) -> DataFrame:
    """Rows newer than the target's maximum; all rows when the target has none.

    The maximum is a scalar subquery: computed once and pushed to the file scan. Whether
    there is a maximum at all is asked first, with a job that stops at the first row.
    """
    if target is None:
        return df
    loaded = target.select(name(target_column or column).alias("mark")).where("mark is not null")
    if loaded.isEmpty():
        return df
    return df.where(name(column) > loaded.agg(F.max("mark")).scalar())


def coalesce_with_target(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    columns: Sequence[str] | dict[str, str],
) -> DataFrame:
    """Fill null source columns from the target row of the same key.

    ``columns`` maps a source column to the target column that stands in for it; the
    result has the target column's name.
    """
    mapping = columns if isinstance(columns, dict) else {c: c for c in columns}
    kept = [c for c in source.columns if c not in mapping]
    if target is None:
        return source.select(*names(kept), *[name(s).alias(t) for s, t in mapping.items()])
    fallback = target.select(
        *names(keys), *[name(t).alias(f"__t{i}") for i, t in enumerate(mapping.values())]
    )
    joined = key_join(source, fallback, keys, "left")
    return joined.select(
        *names(kept),
        *[
            F.coalesce(name(s), F.col(f"__t{i}")).alias(t)
            for i, (s, t) in enumerate(mapping.items())
        ],
    )
