"""Upserts, appends, deletes and document replacement as functions on frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import besides, name, names
from tidemark.operators.history import dedup_latest
from tidemark.operators.joins import anti_join
from tidemark.operators.ordered import KeyedOrder
from tidemark.operators.skew import HOT_ROWS, match
from tidemark.session import stored

DUPLICATE_KEY = "upsert source has more than one row for a key"


def reject_duplicate_keys(source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """``source`` unchanged, or a failing job when a key occurs twice.

    Counting and passing the row on is one aggregation, combined in the map tasks. With
    ``null_safe=False`` rows with a null key part match nothing and may repeat.
    """
    checked = source
    loose = None
    if not null_safe:
        has_null = reduce(Column.__or__, [name(k).isNull() for k in keys])
        checked, loose = source.where(~has_null), source.where(has_null)
    rest = besides(source.columns, keys)
    grouped = checked.groupBy(*names(keys)).agg(
        F.count(F.lit(1)).alias("__n"),
        F.any_value(F.struct(F.lit(1).alias("__one"), *names(rest))).alias("__row"),
    )
    guarded = grouped.where(
        F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit(DUPLICATE_KEY)).cast("boolean"))
    )
    value = {k.lower(): name(k) for k in keys} | {c.lower(): F.col(f"__row.`{c}`") for c in rest}
    unique = guarded.select(*[value[c.lower()].alias(c) for c in source.columns])
    return unique if loose is None else unique.unionByName(loose)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    schema_change: str = "ignore",
    check_keys: bool = True,
) -> DataFrame:
    """Type-1 merge: matched rows are replaced, new rows added, none deleted.

    ``schema_change`` is ``ignore`` (keep the target's columns) or ``sync_all_columns``.
    ``null_safe`` lets null key parts match, so that a rerun does not add the row again.
    """
    if check_keys:
        source = reject_duplicate_keys(source, keys, null_safe)
    if schema_change == "ignore":
        source = ignore_new_columns(source, target)
    elif schema_change == "sync_all_columns":
        target = sync_columns(target, source)
    else:
        raise ValueError(f"unknown schema_change: {schema_change}")
    return anti_join(target, source, keys, null_safe, distinct=False).unionByName(source)


def append_history(target: DataFrame, changes: DataFrame, sync: bool = True) -> DataFrame:
    """Append changes without a key; new columns widen the target when ``sync``."""
    if sync:
        return target.unionByName(changes, allowMissingColumns=True)
    return target.unionByName(ignore_new_columns(changes, target))


def delete_flagged(df: DataFrame, delete_column: str) -> DataFrame:
    """Drop rows whose delete column is set; a frame without the column passes unchanged."""
    known = {c.lower() for c in df.columns}
    return df.where(name(delete_column).isNull()) if delete_column.lower() in known else df


def delete_opflag(df: DataFrame, column: str = "OPFLAG", flag: str = "D") -> DataFrame:
    """Drop rows flagged as deleted; a null flag is no flag."""
    return df.where(~name(column).eqNullSafe(F.lit(flag)))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE WHERE``: rows for which the predicate is null stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE SET .. WHERE``: all assignments see the old row."""
    return df.withColumns(
        {
            c: F.when(predicate, value).otherwise(name(c)).cast(df.schema[c].dataType)
            for c, value in assignments.items()
        }
    )


def document_replace(target: DataFrame, increment: DataFrame, header_keys: Sequence[str]) -> DataFrame:
    """Target without any row of a document that occurs in the increment."""
    return anti_join(target, increment, header_keys)


def document_load(
    target: DataFrame, increment: DataFrame, header_keys: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Delta load of documents: replaced documents go, all increment rows come in."""
    return upsert(document_replace(target, increment, header_keys), increment, keys)


def document_prune(
    target: DataFrame,
    lines: DataFrame,
    header_keys: Sequence[str],
    keys: Sequence[str],
    order_by: Sequence[str],
    mode: str = "dense_rank",
    flag_column: str = "OPFLAG",
    flag: str = "D",
) -> DataFrame:
    """After an initial load, drop superseded lines of each document and flagged lines.

    ``dense_rank`` keeps the lines of the latest version of a document (all lines that share
    its newest order values); lines without a document number are one document. ``row_number``
    keeps only the single newest line per document, and drops its key too when an older row
    has that key. Neither needs a rank of every line: the newest line per document is found
    with one row per map task.
    """
    if mode == "dense_rank":
        position = F.struct(*[name(c).alias(f"o{i}") for i, c in enumerate(order_by)])
        # Read from a table of its own, with one row per document, the newest positions do
        # not force the grouping of their documents on the join: both sides are shuffled
        # for it, and adaptive execution splits the lines of a hot document.
        newest = stored(lines.groupBy(*names(header_keys)).agg(F.max(position).alias("__newest")), "newest")
        placed = lines.select(
            *names(dict.fromkeys([*header_keys, *keys])), position.alias("__position"),
            F.coalesce(name(flag_column) == F.lit(flag), F.lit(False)).alias("__flagged"),
        )
        judged = match(placed, newest, header_keys).groupBy(*names(keys)).agg(
            F.bool_or(F.col("__position") == F.col("__newest")).alias("__latest"), F.bool_or("__flagged").alias("__flagged")
        )
        gone = judged.where(~F.coalesce("__latest", F.lit(False)) | F.col("__flagged")).select(*names(keys))
        return anti_join(target, gone, keys)
    if mode != "row_number":
        raise ValueError(f"unknown mode: {mode}")
    # Newest lines and judged keys are tables of their own, so that no task holds the sorts and
    # aggregations of one step beside those of the next.
    newest = dedup_latest(lines.select(*names(dict.fromkeys([*keys, *order_by]))), header_keys, order_by)
    newest = stored(newest.select(*names(keys)), "newest")
    flagged = F.coalesce(name(flag_column) == F.lit(flag), F.lit(False))
    every = lines.select(*names(keys), F.lit(1).alias("__n"), F.lit(False).alias("__latest"), flagged.alias("__flagged"))
    latest = newest.select(*names(keys), F.lit(0).alias("__n"), F.lit(True).alias("__latest"), F.lit(False).alias("__flagged"))
    judged = every.unionByName(latest).groupBy(*names(keys)).agg(
        F.sum("__n").alias("__n"), F.bool_or("__latest").alias("__latest"), F.bool_or("__flagged").alias("__flagged")
    )
    gone = judged.where((F.col("__n") > 1) | ~F.col("__latest") | F.col("__flagged")).select(*names(keys))
    return anti_join(target, stored(gone, "gone"), keys, distinct=False)


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source's columns: new ones null, vanished ones dropped."""
    existing = {c.lower(): c for c in target.columns}
    return target.select(
        *[
            name(existing[f.name.lower()]).alias(f.name)
            if f.name.lower() in existing
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in source.schema.fields
        ]
    )


def ignore_new_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source cut to the target's columns; columns the source lacks become null."""
    return sync_columns(source, target)


def alter_columns(
    df: DataFrame, add: Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Add typed null columns and drop columns."""
    added = {c: F.lit(None).cast(t) for c, t in (add or {}).items()}
    return df.drop(*drop).withColumns(added) if added else df.drop(*drop)


def identity_key(
    df: DataFrame,
    out: str,
    order_by: Sequence[str],
    existing: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dense row id that continues after the largest id of ``existing``.

    ``order_by`` must be a total order. From ``hot_rows`` rows on, numbers are counted per
    slice of that order and shifted by the sizes of the slices before it, so no task sees a
    large table whole.
    """
    whole = KeyedOrder(df, [], order_by, hot_rows)
    numbered = whole.plain(whole.number(whole.sliced(df), out))
    if existing is None:
        return numbered
    last = existing.agg(F.coalesce(F.max(name(out)), F.lit(0)).cast("long")).scalar()
    return numbered.withColumn(out, name(out) + last)


def scd1_with_delete_feed(
    target: DataFrame | None,
    live: DataFrame,
    deletes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    operation: str = "operation",
    flag: str = "D",
) -> DataFrame:
    """Live rows and delete rows of a load, latest per key, merged; deleted rows go."""
    from tidemark.operators.shape import union_soft_deletes

    rows = dedup_latest(union_soft_deletes(live, deletes, operation, flag), keys, order_by)
    merged = rows if target is None else upsert(
        alter_columns(target, add={operation: "string"}) if operation not in target.columns else target,
        rows, keys, check_keys=False,
    )
    return delete_flagged(merged, operation)
