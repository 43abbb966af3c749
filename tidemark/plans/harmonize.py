"""Harmonized tables: renamed, tenant-filtered, joined on the keys that changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import name, names
from tidemark.operators.changes import high_water_mark
from tidemark.operators.history import dedup_latest
from tidemark.operators.joins import anti_join, inner_join_keys, left_join_many
from tidemark.operators.merge import delete_flagged, delete_opflag, document_replace, upsert
from tidemark.operators.skew import HOT_ROWS
from tidemark.operators.shape import (
    add_source_id,
    rename_project,
    stamp_ingested_at,
    tenant_filter,
    union_distinct,
    union_two_feeds,
)
from tidemark.session import stored
from tidemark.sources.snapshots import SnapshotTable


@dataclass(frozen=True)
class Feed:
    """One source table of a harmonized table.

    ``rename`` maps source columns to business names. ``tenant`` is a (source column, value)
    pair. ``mark`` is the ingestion time after renaming; it is kept in the result, and the
    next run loads what is newer than the result's maximum of it.
    """

    rows: DataFrame
    rename: Mapping[str, str] | None = None
    tenant: tuple[str, object] | None = None
    mark: str | None = None

    def prepared(self) -> DataFrame:
        df = tenant_filter(self.rows, *self.tenant) if self.tenant else self.rows
        return rename_project(df, self.rename) if self.rename else df

    def changed(self, df: DataFrame, target: DataFrame | None) -> DataFrame:
        if self.mark is None or target is None or self.mark not in target.columns:
            return df
        return high_water_mark(df, self.mark, target)


def affected_key_join(
    base: DataFrame | SnapshotTable,
    sides: Sequence[tuple[DataFrame | SnapshotTable, Sequence[str]]],
    keys: Sequence[str],
    changed: Sequence[DataFrame],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rows of ``base`` with changes on either side, left-joined to the full sides.

    ``changed`` holds the changed rows of each input; only their ``keys`` count. Base and
    sides are cut to those keys by semi-joins before the wide join, and both are complete,
    so a changed detail brings its header along and a changed header all its details. Hot
    keys are looked for in what the cut leaves.

    Of a :class:`SnapshotTable` whose buckets are made of the ``keys`` only the buckets that
    the changed keys fall into are read. A frame is read in full.
    """
    affected = stored(union_distinct(*[c.select(*names(keys)) for c in changed]), "affected")
    result = inner_join_keys(_possible(base, affected, keys), affected, keys)
    for side, on in sides:
        cut = stored(inner_join_keys(_possible(side, affected, keys), affected, keys), "cut")
        result = left_join_many(result, cut, on, hot_rows)
    return result


def _possible(side: DataFrame | SnapshotTable, affected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of a frame, of a table those that may have one of the keys."""
    if not isinstance(side, SnapshotTable):
        return side
    return side.read_keys(affected) if side.bucket_by == list(keys) else side.read()


def harmonize_joined(
    base: Feed,
    sides: Sequence[tuple[Feed, Sequence[str]]],
    keys: Sequence[str],
    system_id: str,
    client: str,
    target: DataFrame | None = None,
    now: datetime | Column | None = None,
) -> DataFrame:
    """Increment of a joined table: everything when there is no target yet."""
    main = base.prepared()
    prepared = [(feed, feed.prepared(), on) for feed, on in sides]
    changed = [base.changed(main, target)] + [feed.changed(df, target) for feed, df, _ in prepared]
    if target is None:
        joined = main
        for _, df, on in prepared:
            joined = left_join_many(joined, df, on)
    else:
        joined = affected_key_join(main, [(df, on) for _, df, on in prepared], keys, changed)
    return _finished(joined, system_id, client, now)


def harmonize_fact(header: Feed, detail: Feed, keys: Sequence[str], **options) -> DataFrame:
    """Document header with its lines."""
    return harmonize_joined(header, [(detail, keys)], keys, **options)


def harmonize_master(master: Feed, company: Feed, keys: Sequence[str], **options) -> DataFrame:
    """Master record with its company-code records."""
    return harmonize_joined(master, [(company, keys)], keys, **options)


def harmonize_master3(
    account: Feed,
    company: Feed,
    text: Feed,
    keys: Sequence[str],
    text_keys: Sequence[str],
    **options,
) -> DataFrame:
    """Account master with company-code records and texts; texts may join on more keys."""
    return harmonize_joined(account, [(company, keys), (text, text_keys)], keys, **options)


def harmonize_balance(
    feed: Feed,
    system_id: str,
    client: str,
    target: DataFrame | None = None,
    now: datetime | Column | None = None,
) -> DataFrame:
    """Renamed and filtered rows newer than what the target holds."""
    return _finished(feed.changed(feed.prepared(), target), system_id, client, now)


def harmonize_reference(
    feed: Feed, system_id: str, client: str, now: datetime | Column | None = None
) -> DataFrame:
    """Renamed and filtered rows, fully refreshed."""
    return _finished(feed.prepared(), system_id, client, now)


def load_keyed(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    mark: str | None = None,
) -> DataFrame:
    """Latest row per key of what is newer than the target, merged into it."""
    if target is None:
        return dedup_latest(source, keys, order_by)
    newer = high_water_mark(source, mark, target) if mark else source
    return upsert(target, dedup_latest(newer, keys, order_by), keys, check_keys=False)


def load_two_feeds(
    target: DataFrame | None,
    first: DataFrame,
    second: DataFrame,
    relations: tuple[str, str],
    keys: Sequence[str],
    order_by: Sequence[str],
    second_changed: str | None = None,
    partition_key: tuple[str, int] | None = None,
    header_keys: Sequence[str] | None = None,
    flag: str = "OPFLAG",
) -> DataFrame:
    """Union of two feeds, latest per key, merged; flagged rows go after the merge.

    With ``header_keys`` documents of the increment first replace those of the target.
    """
    rows = union_two_feeds(first, second, *relations, second_changed, partition_key)
    latest = dedup_latest(rows, keys, order_by)
    if target is not None:
        if header_keys:
            target = document_replace(target, latest, header_keys)
        latest = upsert(target, latest, keys, check_keys=False)
    return delete_opflag(latest, flag)


def scd1_join(
    target: DataFrame | None, left: DataFrame, right: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Left join of two type-1 tables, merged into a target."""
    joined = left_join_many(left, right, keys)
    return joined if target is None else upsert(target, joined, keys)


def scd1_join_with_delete(
    target: DataFrame | None,
    left: DataFrame | SnapshotTable,
    right: DataFrame | SnapshotTable,
    keys: Sequence[str],
    changed: Sequence[DataFrame],
    delete_column: str,
) -> DataFrame:
    """Join of the keys that changed on either side, merged; rows with a set delete column go."""
    joined = affected_key_join(left, [(right, keys)], keys, changed)
    merged = joined if target is None else upsert(target, joined, keys)
    return delete_flagged(merged, delete_column)


def join_view(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same join without state."""
    return left_join_many(left, right, keys)


def leaves(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows of a hierarchy that are no row's parent."""
    parents = df.select(name(parent).alias(key))
    return anti_join(df, parents, [key])


def _finished(df: DataFrame, system_id: str, client: str, now) -> DataFrame:
    return add_source_id(stamp_ingested_at(df, now), system_id, client).drop(client)
