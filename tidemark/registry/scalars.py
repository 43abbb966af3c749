"""Scalar functions and the date dimension."""

from pyspark.sql import functions as F

from tidemark.functions.calendar import date_dimension_of, date_parts, iso_weekday
from tidemark.functions.keys import detail_hash_key, key_number, key_suffix
from tidemark.plans.reports import run_type
from tidemark.registry.base import query, table


@query(
    "date_dimension",
    """with days as (
        select cast(unnest(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), interval 1 day)) as date) as date
        from (select year(min(o_orderdate)) as a, year(max(o_orderdate)) as b from orders)),
    sold as (select cast(o_orderdate as date) as date, count(*) as n_orders from orders group by 1)
    select date, cast(date + 1 as date) as next_day_date, year(date) as year,
        year(date) || '' || quarter(date) as year_quarter, year(date) || '' || month(date) as year_month,
        year(date) || '' || dayofyear(date) as year_day_of_year, quarter(date) as quarter,
        'Q' || quarter(date) as quarter_name, month(date) as month, strftime(date, '%B') as month_name,
        strftime(date, '%b') as month_abbr, day(date) as day, strftime(date, '%A') as day_name,
        isodow(date) as day_of_week, weekofyear(date) as week_of_year, strftime(date, '%Y-%B') as year_month_name_long,
        isodow(date) in (6, 7) as is_weekend, last_day(date) as last_day_of_month,
        day(date) = 1 as is_quarter_start, date = last_day(date) as is_quarter_end,
        day(date) = 1 as is_month_start, date = last_day(date) as is_month_end,
        date = date_trunc('quarter', date) as is_first_day_of_quarter,
        date = last_day(date_trunc('quarter', date) + interval 2 month) as is_last_day_of_quarter,
        isoyear(date) as iso_year, coalesce(n_orders, 0) as n_orders
    from days left join sold using (date)""",
)
def date_dimension(spark, d):
    orders = table(spark, d, "orders")
    sold = orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n_orders"))
    days = date_dimension_of(orders, "o_orderdate")
    return days.join(sold, ["date"], "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "scalar_dates",
    """select o_orderkey, year(o_orderdate) as year, quarter(o_orderdate) as quarter, month(o_orderdate) as month,
        day(o_orderdate) as day, dayofyear(o_orderdate) as day_of_year, isodow(o_orderdate) as weekday,
        weekofyear(o_orderdate) as week, strftime(o_orderdate, '%Y-%B') as month_name,
        strftime(o_orderdate + interval 365 day, '%Y-%m-%d') as next_year,
        strftime(last_day(o_orderdate), '%Y-%m-%d') as month_end,
        o_orderdate - interval 1 millisecond as just_before from orders""",
)
def scalar_dates(spark, d):
    at = F.col("o_orderdate")
    parts = [column.alias(key) for key, column in date_parts(at).items()]
    return table(spark, d, "orders").select(
        "o_orderkey", *parts, F.quarter(at).alias("quarter"), F.dayofyear(at).alias("day_of_year"),
        iso_weekday(at).alias("weekday"), F.weekofyear(at).alias("week"), F.date_format(at, "yyyy-MMMM").alias("month_name"),
        F.date_format(F.date_add(at.cast("date"), 365), "yyyy-MM-dd").alias("next_year"),
        F.date_format(F.last_day(at), "yyyy-MM-dd").alias("month_end"),
        F.try_subtract(at, F.expr("INTERVAL '0.001' SECOND")).alias("just_before"),
    )


@query(
    "scalar_text",
    """select c_custkey, md5(c_name) as name_hash, right(c_name, 3) as suffix, cast(substr(c_name, 10) as bigint) as number,
        lower(c_mktsegment) as segment, trim('  ' || c_name || ' ') as trimmed, replace(c_name, '#', '_') as replaced,
        split_part(c_name, '#', 1) as first_part, c_name || '_' || c_nationkey as joined,
        instr(c_name, '#') as hash_at, substr(c_name, instr(c_name, '#') - 4, 7) as around,
        coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') as or_none,
        case when c_acctbal < 0 then 'debit' else 'credit' end as side, cast(floor(c_acctbal) as bigint) as whole,
        md5(md5(c_name) || c_custkey) as detail_key from customer""",
)
def scalar_text(spark, d):
    named = F.col("c_name")
    return table(spark, d, "customer").select(
        "c_custkey", F.md5(named).alias("name_hash"), key_suffix("c_name").alias("suffix"),
        key_number("c_name", 9).alias("number"), F.lower("c_mktsegment").alias("segment"),
        F.trim(F.concat(F.lit("  "), named, F.lit(" "))).alias("trimmed"), F.replace(named, F.lit("#"), F.lit("_")).alias("replaced"),
        F.get(F.split(named, "#"), F.lit(0)).alias("first_part"), F.concat(named, F.lit("_"), "c_nationkey").alias("joined"),
        F.locate("#", named).alias("hash_at"), F.substring(named, F.locate("#", named) - 4, F.lit(7)).alias("around"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("or_none"),
        F.when(F.col("c_acctbal") < 0, "debit").otherwise("credit").alias("side"),
        F.floor("c_acctbal").alias("whole"), detail_hash_key(F.md5(named), F.col("c_custkey")).alias("detail_key"),
    )


@query(
    "scalar_arrays",
    """with tagged as (select p_partkey, list_sort(list_distinct([p_brand, p_type, split_part(p_name, ' ', 2)])) as tags, p_type from part)
    select p_partkey, array_to_string(tags, ' / ') as label, list_contains(tags, 'ECONOMY') as economy, tags[1] as first_tag,
        len(tags) as n from tagged""",
)
def scalar_arrays(spark, d):
    tags = F.array_sort(F.array_distinct(F.array("p_brand", "p_type", F.get(F.split("p_name", " "), F.lit(1)))))
    return table(spark, d, "part").select("p_partkey", tags.alias("tags")).select(
        "p_partkey", F.array_join("tags", " / ").alias("label"), F.array_contains("tags", "ECONOMY").alias("economy"),
        F.get("tags", F.lit(0)).alias("first_tag"), F.size("tags").alias("n"),
    )


@query(
    "scalar_json",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
        '{"event_type":"' || event_type || '","user_id":' || user_id || '}' as record from events""",
)
def scalar_json(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("event_type", "user_id")).alias("record"),
    )


@query(
    "scalar_run_label",
    """select substr(label, instr(substr(label, 4), 'run') + 3 - 4, 7) as run_type, count(*) as n from (
        select 'Load of ' || o_orderstatus || '. ' || case o_orderpriority when '1-URGENT' then '1st' when '2-HIGH' then '2nd'
            else '3th' end || ' run. Done' as label from orders) group by 1""",
)
def scalar_run_label(spark, d):
    priority = F.col("o_orderpriority")
    nth = F.when(priority == "1-URGENT", "1st").when(priority == "2-HIGH", "2nd").otherwise("3th")
    labels = table(spark, d, "orders").select(
        F.concat(F.lit("Load of "), "o_orderstatus", F.lit(". "), nth, F.lit(" run. Done")).alias("label")
    )
    return labels.groupBy(run_type("label").alias("run_type")).agg(F.count(F.lit(1)).alias("n"))
