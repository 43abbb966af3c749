"""Projections, filters, unions and nesting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import date_parts
from tidemark.functions.keys import detail_hash_key, name, names, source_id


def rename_project(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``spec`` maps a technical name to a business name."""
    return df.select(*[name(c).alias(alias) for c, alias in spec.items()])


def tenant_filter(df: DataFrame, column: str, tenant: object) -> DataFrame:
    return df.where(name(column) == F.lit(tenant))


def select_except(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def add_lineage_column(df: DataFrame, relation: str, out: str = "_dbt_source_relation") -> DataFrame:
    return df.withColumn(out, F.lit(relation))


def pad_missing_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Add the columns ``like`` has and ``df`` lacks: '' for strings, null otherwise."""
    have = {c.lower() for c in df.columns}
    missing = {
        f.name: F.lit("" if f.dataType.typeName() == "string" else None).cast(f.dataType)
        for f in like.schema.fields
        if f.name.lower() not in have
    }
    return df.withColumns(missing) if missing else df


def add_metadata_columns(
    df: DataFrame, job_id: str, run_id: str, now: datetime | Column | None = None
) -> DataFrame:
    """``insert_date``, ``job_id`` and ``run_id``; ``now`` replaces the clock."""
    return df.withColumns(
        {
            "insert_date": _moment(now),
            "job_id": F.lit(job_id).cast("string"),
            "run_id": F.lit(run_id).cast("string"),
        }
    )


def stamp_ingested_at(
    df: DataFrame, now: datetime | Column | None = None, out: str = "Ingested_At"
) -> DataFrame:
    return df.withColumn(out, _moment(now))


def add_source_id(df: DataFrame, system_id: str | Column, client: str, out: str = "Source_ID") -> DataFrame:
    return df.withColumn(out, source_id(system_id, client))


def not_null_filter(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(name(column).isNotNull())
    return df


def flag_filter(df: DataFrame, column: str, *values: object) -> DataFrame:
    return df.where(name(column).isin(*values))


def like_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(name(column).like(pattern))


def sample_month(df: DataFrame, column: str, year: int, month: int) -> DataFrame:
    """Rows of one month, as a range that file statistics can prune."""
    kind = df.schema[column].dataType
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return df.where(
        (name(column) >= first.cast(kind)) & (name(column) < F.add_months(first, 1).cast(kind))
    )


def sort_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*names(columns))


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*names(columns)).distinct() if columns else df.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union of rows or keys; repeated keys are dropped in the map tasks already."""
    return union_all(*frames).distinct()


def union_two_feeds(
    first: DataFrame,
    second: DataFrame,
    first_relation: str,
    second_relation: str,
    second_changed: str | None = None,
    partition_key: tuple[str, int] | None = None,
) -> DataFrame:
    """Two extraction feeds of one table as one relation with a lineage column.

    Columns are matched by name; what one feed lacks is padded. Rows of the second feed
    without a change time (``second_changed``) are not loaded.
    """
    if second_changed:
        second = not_null_filter(second, second_changed)
    left = add_lineage_column(pad_missing_columns(first, second), first_relation)
    right = add_lineage_column(pad_missing_columns(second, first), second_relation)
    merged = left.unionByName(right).distinct()
    if partition_key:
        column, length = partition_key
        merged = merged.withColumn("partition_key", F.right(name(column), F.lit(length)))
    return merged


def union_soft_deletes(
    live: DataFrame, deletes: DataFrame, operation: str = "operation", flag: str = "D"
) -> DataFrame:
    """Live rows (null operation) and delete rows (null attributes) in one frame."""
    marked = live.withColumn(operation, F.lit(None).cast("string"))
    gone = deletes.where(name(operation) == F.lit(flag))
    return marked.unionByName(gone, allowMissingColumns=True).select(*names(marked.columns))


def nest_details(
    df: DataFrame, group: Sequence[str], details: Sequence[str], out: str = "details"
) -> DataFrame:
    """One row per group with its details as a sorted array of structs."""
    return df.groupBy(*names(group)).agg(
        F.array_sort(F.collect_list(F.struct(*names(details)))).alias(out)
    )


def explode_details(df: DataFrame, column: str) -> DataFrame:
    """One row per element of an array of structs; the struct fields become columns."""
    kept = [c for c in df.columns if c != column]
    fields = df.schema[column].dataType.elementType.fieldNames()
    return df.select(*names(kept), F.explode(name(column)).alias("__item")).select(
        *names(kept), *[F.col(f"__item.`{f}`").alias(f) for f in fields]
    )


def flatten_orders(
    orders: DataFrame,
    details: str = "order_details",
    ordered_at: str = "ordered_at",
    hash_key: str | None = "hash_key",
    detail_nr: str = "order_detail_nr",
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Order documents as detail rows with date parts and, if asked for, a single hash key."""
    flat = explode_details(orders, details)
    flat = flat.withColumns(date_parts(name(ordered_at)))
    if hash_key:
        flat = flat.withColumn("new_hash_key", detail_hash_key(name(hash_key), name(detail_nr)))
    return flat.withColumnsRenamed(dict(rename or {}))


def _moment(now: datetime | Column | None) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now)
