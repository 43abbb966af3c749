"""Tags of tables and columns, and the match of catalog tables with models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import case_map, name
from tidemark.operators.joins import anti_join, inner_join_keys

TABLE = ("catalog_name", "schema_name", "table_name")

# Catalog kinds and model materializations that mean a table.
TABLE_KINDS = ("EXTERNAL", "MANAGED")
TABLE_MATERIALIZATIONS = ("incremental", "snapshot", "seed")


def tag_text(tag: str = "tag_name", value: str = "tag_value") -> Column:
    """``name`` or ``name=value``."""
    return F.when(F.coalesce(name(value), F.lit("")) == "", name(tag)).otherwise(
        F.concat(name(tag), F.lit("="), name(value))
    )


def tag_rollup(column_tags: DataFrame, table_tags: DataFrame) -> DataFrame:
    """One row per table: ``full_name`` and its tags and column tags as JSON."""
    per_column = (
        column_tags.groupBy(*TABLE, "column_name")
        .agg(F.array_sort(F.collect_set(tag_text())).alias("tags"))
        .groupBy(*TABLE)
        .agg(F.array_sort(F.collect_list(F.struct("column_name", "tags"))).alias("columns"))
    )
    per_table = table_tags.groupBy(*TABLE).agg(F.array_sort(F.collect_set(tag_text())).alias("tags"))
    full_name = F.concat_ws(".", *[name(c) for c in TABLE])
    no_columns = F.array().cast(per_column.schema["columns"].dataType)
    record = F.struct(
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("columns", no_columns).alias("columns"),
    )
    return per_table.join(per_column, list(TABLE), "full").select(
        full_name.alias("full_name"), F.to_json(record).alias("config")
    )


def config_of(config: Column) -> Column:
    """Parse the JSON of :func:`tag_rollup`."""
    return F.from_json(
        config, "tags array<string>, columns array<struct<column_name: string, tags: array<string>>>"
    )


def column_tags_of(config: Column, column: str) -> Column:
    """Tags of one column in a parsed record; null when it has none."""
    return F.get(F.filter(config["columns"], lambda c: c["column_name"] == column), F.lit(0))["tags"]


def tag_parse(tags: Column, ignore: Sequence[str] = ()) -> Column:
    """Struct of tags with and without value, minus the ignored ones."""
    kept = F.filter(tags, lambda t: ~t.isin(*ignore)) if ignore else tags
    with_value = F.filter(kept, lambda t: F.instr(t, "=") > 0)
    return F.struct(
        F.transform(
            with_value,
            lambda t: F.struct(
                F.get(F.split(t, "="), F.lit(0)).alias("tag_name"),
                F.get(F.split(t, "="), F.lit(1)).alias("tag_value"),
            ),
        ).alias("tags_with_value"),
        F.filter(kept, lambda t: F.instr(t, "=") == 0).alias("tags_without_value"),
    )


def tag_diff(current: Column, declared: Column, ignore: Sequence[str] = ()) -> Column:
    """Struct of tag names to unset and tags to set; ignored tags are left alone in both."""
    skipped = F.array(*[F.lit(i) for i in ignore]).cast("array<string>")
    gone = F.array_except(F.array_except(current, declared), skipped)
    return F.struct(
        F.array_sort(F.array_distinct(F.transform(gone, lambda t: F.get(F.split(t, "="), F.lit(0))))).alias("unset"),
        F.array_sort(F.array_except(declared, skipped)).alias("set"),
    )


def tag_sync_plan(current: DataFrame, declared: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Actions that lead from the current to the declared tags.

    Inputs have one row per tag: ``table_name``, ``column_name`` (null for the table
    itself) and ``tag``. Objects whose tags agree get no action. Per object, unsetting
    comes before setting; tags with and without value are set in separate actions.
    """
    on = ["table_name", "column_name"]

    def rolled(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy("table_name", F.coalesce("column_name", F.lit("")).alias("column_name")).agg(
            F.array_sort(F.collect_set("tag")).alias(out)
        )

    empty = F.array().cast("array<string>")
    both = rolled(current, "current").join(rolled(declared, "declared"), on, "full").select(
        *on, F.coalesce("current", empty).alias("current"), F.coalesce("declared", empty).alias("declared")
    )
    changed = both.where(F.col("current") != F.col("declared")).withColumn(
        "diff", tag_diff(F.col("current"), F.col("declared"), ignore)
    )
    to_set = F.col("diff.set")

    def action(step: int, kind: str, tags: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("action"), tags.alias("tags"))

    actions = F.array(
        action(1, "unset", F.col("diff.unset")),
        action(2, "set_with_value", F.filter(to_set, lambda t: F.instr(t, "=") > 0)),
        action(3, "set_without_value", F.filter(to_set, lambda t: F.instr(t, "=") == 0)),
    )
    return (
        changed.select(*on, F.explode(actions).alias("a"))
        .where(F.size("a.tags") > 0)
        .select(
            "table_name",
            F.nullif(F.col("column_name"), F.lit("")).alias("column_name"),
            "a.step", "a.action", "a.tags",
        )
    )


def model_table_match(
    catalog: DataFrame,
    models: DataFrame,
    ignore_tables: Sequence[str] = (),
    ignore_schemas: Sequence[str] = (),
    prefix: str | None = None,
) -> DataFrame:
    """Catalog tables without a model of the same schema, name and kind.

    ``catalog`` has ``table_schema, table_name, table_type``; ``models`` has ``schema,
    name, materialized``. Only schemas that hold a model are looked at.
    """
    kind = F.when(F.col("table_type").isin(*TABLE_KINDS), "table").otherwise(F.lower("table_type"))
    tables = catalog.select("table_schema", "table_name", kind.alias("table_type"))
    if ignore_tables:
        tables = tables.where(~F.col("table_name").isin(*ignore_tables))
    if ignore_schemas:
        tables = tables.where(~F.col("table_schema").isin(*ignore_schemas))
    if prefix:
        tables = tables.where(F.col("table_name").startswith(prefix))
    materialized = case_map(
        F.col("materialized"), dict.fromkeys(TABLE_MATERIALIZATIONS, "table"), F.col("materialized")
    )
    known = models.select(
        F.col("schema").alias("table_schema"), F.col("name").alias("table_name"), materialized.alias("table_type")
    )
    modelled = inner_join_keys(tables, known, ["table_schema"])
    return anti_join(modelled, known, ["table_schema", "table_name", "table_type"])
