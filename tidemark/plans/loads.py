"""Incremental loads of stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.changes import SourceState, plan_increment
from tidemark.sources.snapshots import IGNORE, SnapshotTable


def load_increment(
    table: SnapshotTable,
    source_name: str,
    source: DataFrame,
    feed: DataFrame | None,
    state: SourceState,
    order_by: Sequence[str] | None = None,
    delete_column: str | None = None,
    schema_change: str = IGNORE,
) -> int:
    """Bring a stored table up to the state of a source; returns the table's version.

    What was loaded last is read from the table itself, and what is loaded now is committed
    together with the rows. So a load that is lost before the commit is repeated, one that
    is lost after it has nothing left to do, and neither skips or repeats a change. With a
    ``delete_column`` (``deleted_date``) delete rows come along and remove their key.
    """
    rows, version = plan_increment(
        source, feed, state, table.loaded_version(source_name), table.keys, order_by, append_delete=delete_column is not None
    )
    if version is None:
        return table.version()
    return table.merge(
        rows, f"{source_name}@{version}", purge=delete_column, schema_change=schema_change, loaded={source_name: version}
    )
