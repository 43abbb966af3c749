"""Data-quality monitors and metadata operators."""

from pyspark.sql import functions as F

from tidemark.plans import quality, tags
from tidemark.registry.base import query, table

WINDOW = "range between interval 14 day preceding and interval 1 second preceding"


def judged(source, metric, by="", sensitivity=3, direction="both"):
    partition = f"partition by {by} " if by else ""
    over = f"{metric} > training_avg + {sensitivity} * training_stddev"
    under = f"{metric} < training_avg - {sensitivity} * training_stddev"
    outside = {"both": f"{over} or {under}", "spike": over, "drop": under}[direction]
    return f"""
        select * exclude (training_avg, training_stddev), round(training_avg, 6) as training_avg,
            round(training_stddev, 6) as training_stddev, coalesce({outside}, false) as is_anomalous
        from (select *, avg({metric}) over w as training_avg, stddev_samp({metric}) over w as training_stddev
            from {source} window w as ({partition}order by bucket {WINDOW}))"""


ALL_DAYS = """
    days as (select unnest(generate_series(a, b, interval 1 day)) as bucket from (
        select date_trunc('day', min(ts)) as a, date_trunc('day', max(ts)) as b from events))
"""


def rounded(df, *extra):
    return df.withColumns({c: F.round(c, 6) for c in ("training_avg", "training_stddev", *extra)})


def events(spark, d):
    return table(spark, d, "events")


@query(
    "volume_anomalies",
    f"""with {ALL_DAYS}, counts as (
        select date_trunc('day', ts) as bucket, count(*) as n from events group by 1),
    filled as (select cast(bucket as timestamp) as bucket, coalesce(n, 0) as row_count from days left join counts using (bucket))
    {judged('filled', 'row_count', sensitivity=2)}""",
)
def volume_anomalies(spark, d):
    found = rounded(quality.volume_anomalies(events(spark, d), "ts", sensitivity=2))
    return found.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(
    "freshness_anomalies",
    f"""with {ALL_DAYS}, latest as (
        select date_trunc('day', ts) as bucket, max(ts) as latest from events group by 1),
    filled as (
        select cast(bucket as timestamp) as bucket, last_value(latest ignore nulls) over (order by bucket
            rows between unbounded preceding and current row) as latest
        from days left join latest using (bucket)),
    delays as (
        select bucket, latest, (epoch_us(bucket + interval 1 day) - epoch_us(latest)) / 1000000 as delay_seconds from filled)
    {judged('delays', 'delay_seconds', sensitivity=2, direction='spike')}""",
)
def freshness_anomalies(spark, d):
    found = rounded(quality.freshness_anomalies(events(spark, d), "ts", sensitivity=2))
    return found.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


HOLED = """
    holed as (select ts, case when value < 20 then null else value end as value,
        case event_type when 'error' then '' when 'signup' then null else event_type end as event_type from events)
"""


def cells(column, missing):
    return f"""
        select bucket, '{column}' as column_name, m.metric, case m.metric when 'null_count' then nulls
            when 'null_percent' then nulls * 100.0 / n else missing end as metric_value
        from (select date_trunc('day', ts) as bucket, count(*) as n, cast(count(*) filter ({column} is null) as double) as nulls,
                cast(count(*) filter ({missing}) as double) as missing from holed group by 1),
            (values ('null_count'), ('null_percent'), ('missing_count')) m(metric)"""


@query(
    "column_anomalies",
    f"""with {HOLED}, cells as (
        {cells('value', 'value is null')} union all
        {cells('event_type', "event_type is null or trim(event_type) = ''")}),
    found as ({judged('cells', 'metric_value', 'column_name, metric', 2)})
    select * exclude (metric_value), round(metric_value, 6) as metric_value from found""",
)
def column_anomalies(spark, d):
    kind = F.col("event_type")
    holed = table(spark, d, "events").select(
        "ts", F.when(F.col("value") >= 20, F.col("value")).alias("value"),
        F.when(kind == "error", "").when(kind != "signup", kind).alias("event_type"),
    )
    found = rounded(quality.column_anomalies(holed, "ts", sensitivity=2), "metric_value")
    return found.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(
    "schema_changes",
    """with before as (
        select l_suppkey as listing, 'c' || l_partkey as "column", min(l_linestatus) as type
        from lineitem where l_returnflag = 'A' group by 1, 2),
    after as (
        select l_suppkey as listing, 'c' || l_partkey as "column", max(l_linestatus) as type
        from lineitem where l_returnflag <> 'A' group by 1, 2)
    select listing, "column", b.type as old_type, a.type as new_type,
        case when b.type is null then 'column_added' when a.type is null then 'column_removed' else 'type_changed' end as change
    from before b full join after a using (listing, "column") where b.type is distinct from a.type""",
)
def schema_changes(spark, d):
    """Line items read as column listings of many tables, before and after."""
    lines = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("listing"), F.concat(F.lit("c"), "l_partkey").alias("column"), "l_linestatus", "l_returnflag"
    )
    before = lines.where("l_returnflag = 'A'").groupBy("listing", "column").agg(F.min("l_linestatus").alias("type"))
    after = lines.where("l_returnflag <> 'A'").groupBy("listing", "column").agg(F.max("l_linestatus").alias("type"))
    return quality.schema_changes(before, after, ["listing"])


@query(
    "model_table_match",
    """with catalog as (
        select p_brand as table_schema, p_name as table_name,
            case p_type when 'ECONOMY' then 'table' when 'STANDARD' then 'table' else lower(p_type) end as table_type from part
        where p_name <> 'red widget'),
    models as (
        select p_brand as schema, p_name as name, case when p_size > 25 then 'table' else 'view' end as materialized
        from part where p_retailprice < 1500)
    select * from catalog where table_schema in (select schema from models)
        and (table_schema, table_name, table_type) not in (select schema, name, materialized from models)""",
)
def model_table_match(spark, d):
    part = table(spark, d, "part")
    kind = F.col("p_type")
    catalog = part.select(
        F.col("p_brand").alias("table_schema"), F.col("p_name").alias("table_name"),
        F.when(kind == "ECONOMY", "EXTERNAL").when(kind == "STANDARD", "MANAGED").otherwise(kind).alias("table_type"),
    )
    models = part.where("p_retailprice < 1500").select(
        F.col("p_brand").alias("schema"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "incremental").otherwise("view").alias("materialized"),
    )
    return tags.model_table_match(catalog, models, ignore_tables=["red widget"])


PART_TAGS = """
    column_tags as (
        select 'cat' as catalog_name, p_brand as schema_name, p_name as table_name, p_type as column_name,
            'size' as tag_name, case when p_size > 10 then cast(p_size as varchar) else '' end as tag_value from part),
    table_tags as (
        select 'cat' as catalog_name, p_brand as schema_name, p_name as table_name, 'price' as tag_name,
            cast(cast(floor(p_retailprice / 100) as bigint) as varchar) as tag_value from part where p_size > 20)
"""
TAG_TEXT = "case when coalesce(tag_value, '') = '' then tag_name else tag_name || '=' || tag_value end"


def part_tags(spark, d):
    part = table(spark, d, "part")
    place = [F.lit("cat").alias("catalog_name"), F.col("p_brand").alias("schema_name"), F.col("p_name").alias("table_name")]
    column_tags = part.select(
        *place, F.col("p_type").alias("column_name"), F.lit("size").alias("tag_name"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).otherwise("").alias("tag_value"),
    )
    table_tags = part.where("p_size > 20").select(
        *place, F.lit("price").alias("tag_name"),
        F.floor(F.col("p_retailprice") / 100).cast("string").alias("tag_value"),
    )
    return column_tags, table_tags


@query(
    "tag_rollup",
    f"""with {PART_TAGS}, per_column as (
        select schema_name, table_name, column_name,
            '["' || string_agg(distinct {TAG_TEXT}, '","' order by {TAG_TEXT}) || '"]' as tags
        from column_tags group by 1, 2, 3),
    columns as (
        select schema_name, table_name, string_agg('{{"column_name":"' || column_name || '","tags":' || tags || '}}', ','
            order by column_name) as columns from per_column group by 1, 2),
    tables as (
        select schema_name, table_name, '["' || string_agg(distinct {TAG_TEXT}, '","' order by {TAG_TEXT}) || '"]' as tags
        from table_tags group by 1, 2)
    select 'cat.' || schema_name || '.' || table_name as full_name,
        '{{"tags":' || coalesce(tags, '[]') || ',"columns":[' || coalesce(columns, '') || ']}}' as config
    from columns full join tables using (schema_name, table_name)""",
)
def tag_rollup(spark, d):
    return tags.tag_rollup(*part_tags(spark, d))


@query(
    "tag_config_read",
    f"""with {PART_TAGS} select 'cat.' || schema_name || '.' || table_name as full_name,
        string_agg(distinct {TAG_TEXT}, ',' order by {TAG_TEXT}) as economy_tags
    from column_tags where column_name = 'ECONOMY' group by 1""",
)
def tag_config_read(spark, d):
    rolled = tags.tag_rollup(*part_tags(spark, d))
    found = tags.column_tags_of(tags.config_of(F.col("config")), "ECONOMY")
    return rolled.select("full_name", F.array_join(found, ",").alias("economy_tags")).where("economy_tags is not null")


def tag_arrays(spark, d):
    """Per brand, the tags of small and of large parts."""
    part = table(spark, d, "part")
    tag = F.concat("p_type", F.when(F.col("p_size") > 30, F.concat(F.lit("="), F.col("p_size") % 7)).otherwise(F.lit("")))
    rows = part.select("p_brand", tag.alias("tag"), (F.col("p_retailprice") > 1200).alias("is_declared"))
    empty = F.array().cast("array<string>")
    return rows.groupBy("p_brand").agg(
        F.coalesce(F.array_sort(F.collect_set(F.when(~F.col("is_declared"), F.col("tag")))), empty).alias("current"),
        F.coalesce(F.array_sort(F.collect_set(F.when(F.col("is_declared"), F.col("tag")))), empty).alias("declared"),
    )


TAG_ROWS = """
    rows as (select distinct p_brand, p_type || case when p_size > 30 then '=' || (p_size % 7) else '' end as tag,
        p_retailprice > 1200 as is_declared from part),
    current as (select p_brand, tag from rows where not is_declared),
    declared as (select p_brand, tag from rows where is_declared)
"""


@query(
    "tag_parse",
    f"""with {TAG_ROWS}, brands as (select distinct p_brand from rows)
    select p_brand,
        coalesce((select string_agg(tag, ',' order by tag) from declared c where c.p_brand = b.p_brand and instr(tag, '=') > 0), '')
            as with_value,
        coalesce((select string_agg(tag, ',' order by tag) from declared c where c.p_brand = b.p_brand and instr(tag, '=') = 0
            and tag <> 'PROMO'), '') as without_value
    from brands b""",
)
def tag_parse(spark, d):
    parsed = tags.tag_parse(F.col("declared"), ["PROMO"])
    with_value = F.transform(parsed["tags_with_value"], lambda t: F.concat_ws("=", t["tag_name"], t["tag_value"]))
    return tag_arrays(spark, d).select(
        "p_brand", F.array_join(with_value, ",").alias("with_value"),
        F.array_join(parsed["tags_without_value"], ",").alias("without_value"),
    )


@query(
    "tag_diff",
    f"""with {TAG_ROWS}, brands as (select distinct p_brand from rows)
    select p_brand,
        coalesce((select string_agg(distinct split_part(tag, '=', 1), ',' order by split_part(tag, '=', 1)) from current c
            where c.p_brand = b.p_brand and tag <> 'PROMO' and not exists (
                select 1 from declared d where d.p_brand = b.p_brand and d.tag = c.tag)), '') as unset,
        coalesce((select string_agg(tag, ',' order by tag) from declared d
            where d.p_brand = b.p_brand and tag <> 'PROMO'), '') as to_set
    from brands b""",
)
def tag_diff(spark, d):
    difference = tags.tag_diff(F.col("current"), F.col("declared"), ["PROMO"])
    return tag_arrays(spark, d).select(
        "p_brand", F.array_join(difference["unset"], ",").alias("unset"), F.array_join(difference["set"], ",").alias("to_set")
    )


@query(
    "tag_sync_plan",
    f"""with {TAG_ROWS}, changed as (
        select p_brand from (
            select p_brand, tag from (from current union all from declared)
            group by all having count(*) = 1) group by 1)
    select p_brand as table_name, cast(null as varchar) as column_name, 1 as step, 'unset' as action,
        string_agg(distinct split_part(tag, '=', 1), ',' order by split_part(tag, '=', 1)) as tags
    from current c where tag <> 'PROMO' and not exists (
        select 1 from declared d where d.p_brand = c.p_brand and d.tag = c.tag) group by 1
    union all
    select p_brand, null, 2, 'set_with_value', string_agg(tag, ',' order by tag) from declared
    where p_brand in (from changed) and instr(tag, '=') > 0 group by 1
    union all
    select p_brand, null, 3, 'set_without_value', string_agg(tag, ',' order by tag) from declared
    where p_brand in (from changed) and instr(tag, '=') = 0 and tag <> 'PROMO' group by 1""",
)
def tag_sync_plan(spark, d):
    arrays = tag_arrays(spark, d)
    nothing = F.lit(None).cast("string").alias("column_name")
    plan = tags.tag_sync_plan(
        arrays.select(F.col("p_brand").alias("table_name"), nothing, F.explode("current").alias("tag")),
        arrays.select(F.col("p_brand").alias("table_name"), nothing, F.explode("declared").alias("tag")),
        ["PROMO"],
    )
    return plan.withColumn("tags", F.array_join("tags", ","))
