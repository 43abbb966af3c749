"""Projections, filters, unions and nesting."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.keys import case_map, key_suffix, system_id_lookup
from tidemark.operators import changes, merge, shape
from tidemark.registry.base import LATEST_LINES, latest_lines, money, query, table
from tidemark.session import shared_dir
from tidemark.sources.snapshots import SnapshotTable

CUSTOMER_NAMES = {
    "c_custkey": "Customer_Number", "c_name": "Customer_Name",
    "c_mktsegment": "Client", "c_acctbal": "Account_Balance", "c_nationkey": "Country_Key",
}


@query(
    "rename_project",
    """select c_custkey as Customer_Number, c_name as Customer_Name, c_mktsegment as Client,
        c_acctbal as Account_Balance, c_nationkey as Country_Key from customer""",
)
def rename_project(spark, d):
    return shape.rename_project(table(spark, d, "customer"), CUSTOMER_NAMES)


@query("tenant_filter", "select * from customer where c_mktsegment = 'BUILDING'")
def tenant_filter(spark, d):
    return shape.tenant_filter(table(spark, d, "customer"), "c_mktsegment", "BUILDING")


@query(
    "rename_filter",
    """select c_custkey as Customer_Number, c_name as Customer_Name, c_nationkey as Country_Key,
        'D80_' || c_mktsegment as Source_ID from customer where c_mktsegment = 'MACHINERY'""",
)
def rename_filter(spark, d):
    kept = shape.tenant_filter(table(spark, d, "customer"), "c_mktsegment", "MACHINERY")
    renamed = shape.select_except(shape.rename_project(kept, CUSTOMER_NAMES), "Account_Balance")
    return shape.add_source_id(renamed, "D80", "Client").drop("Client")


@query("select_except", "select * exclude (l_tax, l_discount) from lineitem")
def select_except(spark, d):
    return shape.select_except(table(spark, d, "lineitem"), "l_tax", "l_discount")


@query(
    "add_lineage_column",
    "select s_suppkey, s_name, 'MAIN' as _dbt_source_relation from supplier",
)
def add_lineage_column(spark, d):
    return shape.add_lineage_column(table(spark, d, "supplier").select("s_suppkey", "s_name"), "MAIN")


@query("pad_missing_columns", "select p_partkey, p_name, '' as p_brand, cast(null as integer) as p_size from part")
def pad_missing_columns(spark, d):
    part = table(spark, d, "part")
    return shape.pad_missing_columns(
        part.select("p_partkey", "p_name"), part.select("p_partkey", "p_name", "p_brand", "p_size")
    )


@query(
    "add_metadata_columns",
    """select n_nationkey, n_name, timestamp '2023-01-01' as insert_date, 'job123' as job_id, 'run123' as run_id
    from nation""",
)
def add_metadata_columns(spark, d):
    return shape.add_metadata_columns(
        table(spark, d, "nation").select("n_nationkey", "n_name"), "job123", "run123",
        F.lit("2023-01-01").cast("timestamp_ntz"),
    )


@query("stamp_ingested_at", "select o_orderkey, timestamp '2024-02-01 12:00:00' as Ingested_At from orders")
def stamp_ingested_at(spark, d):
    return shape.stamp_ingested_at(
        table(spark, d, "orders").select("o_orderkey"), F.lit(datetime(2024, 2, 1, 12)).cast("timestamp_ntz")
    )


@query("add_source_id", "select c_custkey, 'P80_' || c_mktsegment as Source_ID from customer")
def add_source_id(spark, d):
    return shape.add_source_id(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "P80", "c_mktsegment").drop(
        "c_mktsegment"
    )


@query(
    "system_id_lookup",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'P80' when '2-HIGH' then 'B80'
        when '3-MEDIUM' then 'A80' else 'Unknown' end as system_id from orders""",
)
def system_id(spark, d):
    mapping = {"1-URGENT": "P80", "2-HIGH": "B80", "3-MEDIUM": "A80"}
    return table(spark, d, "orders").select(
        "o_orderkey", system_id_lookup(F.col("o_orderpriority"), mapping).alias("system_id")
    )


@query(
    "high_water_mark",
    """select event_id, user_id, ts from events
    where ts > (select max(ts) from events where event_type = 'signup')""",
)
def high_water_mark(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    target = events.where("event_type = 'signup'")
    return changes.high_water_mark(events, "ts", target).drop("event_type")


@query("high_water_mark_empty", "select event_id, user_id, ts from events")
def high_water_mark_empty(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    return changes.high_water_mark(events, "ts", events.where("value < -1e9"))


@query(
    "not_null_filter",
    "select o_orderkey, nullif(o_orderstatus, 'P') as status from orders where nullif(o_orderstatus, 'P') is not null",
)
def not_null_filter(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return shape.not_null_filter(rows, "status")


@query("flag_filter", "select l_orderkey, l_linenumber, l_partkey, l_returnflag from lineitem where l_returnflag in ('R', 'A')")
def flag_filter(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return shape.flag_filter(lines, "l_returnflag", "R", "A")


@query("like_filter", "select p_partkey, p_name from part where p_name like '%ring%'")
def like_filter(spark, d):
    return shape.like_filter(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "%ring%")


@query(
    "sample_month",
    "select o_orderkey, o_orderdate from orders where year(o_orderdate) = 1997 and month(o_orderdate) = 5",
)
def sample_month(spark, d):
    return shape.sample_month(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 1997, 5)


@query(
    "case_map",
    """select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'other' end as status
    from orders""",
)
def case_mapping(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        case_map(F.col("o_orderstatus"), {"F": "finished", "O": "open"}, F.lit("other")).alias("status"),
    )


@query(
    "partition_key",
    """select right(lpad(cast(o_orderkey as varchar), 10, '0'), 3) as partition_key, count(*) as n
    from orders group by 1""",
)
def partition_key(spark, d):
    padded = table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("nr"))
    return padded.groupBy(key_suffix("nr").alias("partition_key")).agg(F.count(F.lit(1)).alias("n"))


@query("sort_rows", "select c_nationkey, c_acctbal, c_custkey from customer order by 1, 2, 3")
def sort_rows(spark, d):
    return shape.sort_rows(
        table(spark, d, "customer").select("c_nationkey", "c_acctbal", "c_custkey"), "c_nationkey", "c_acctbal", "c_custkey"
    )


@query("distinct_rows", "select distinct l_orderkey, l_suppkey from lineitem")
def distinct_rows(spark, d):
    return shape.distinct_rows(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query(
    "union_distinct",
    """select c_nationkey as key from customer union select s_nationkey from supplier union select n_nationkey from nation""",
)
def union_distinct(spark, d):
    return shape.union_distinct(
        table(spark, d, "customer").select(F.col("c_nationkey").alias("key")),
        table(spark, d, "supplier").select(F.col("s_nationkey").alias("key")),
        table(spark, d, "nation").select(F.col("n_nationkey").alias("key")),
    )


@query(
    "union_all",
    "select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier",
)
def union_all(spark, d):
    return shape.union_all(
        table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    )


TWO_FEEDS = """
    select c_custkey as nr, c_name as name, c_mktsegment as segment, '' as opflag, '' as changed, 'MAIN' as _dbt_source_relation
    from customer where c_acctbal >= 0
    union
    select c_custkey, c_name, '', case when c_acctbal < -500 then 'D' else 'I' end, c_mktsegment, 'OTHER'
    from customer where c_acctbal < 0
"""


def two_feeds(spark, d):
    customer = table(spark, d, "customer")
    first = customer.where("c_acctbal >= 0").selectExpr("c_custkey nr", "c_name name", "c_mktsegment segment")
    second = customer.where("c_acctbal < 0").selectExpr(
        "if(c_acctbal < -500, 'D', 'I') opflag", "c_mktsegment changed", "c_name name", "c_custkey nr"
    )
    return first, second


@query("union_two_feeds", TWO_FEEDS)
def union_two_feeds(spark, d):
    return shape.union_two_feeds(*two_feeds(spark, d), "MAIN", "OTHER", "changed")


@query(
    "union_soft_deletes",
    """select c_custkey, c_name, c_acctbal, cast(null as varchar) as operation from customer
    union all
    select o_custkey, null, null, 'D' from orders where o_orderstatus = 'F'""",
)
def union_soft_deletes(spark, d):
    live = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    gone = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "D").otherwise("I").alias("operation")
    )
    return shape.union_soft_deletes(live, gone)


def nested_lines(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = latest_lines(spark, d).join(orders, ["l_orderkey"])
    return shape.nest_details(
        lines, ["l_orderkey", "o_orderdate"], ["l_linenumber", "l_partkey", "l_quantity"], "order_details"
    )


@query(
    "nest_details",
    f"""with lines as ({LATEST_LINES})
    select l_orderkey, count(*) as n_lines, string_agg(l_linenumber || ':' || l_partkey, ',' order by l_linenumber) as lines
    from lines join orders on l_orderkey = o_orderkey group by 1""",
)
def nest_details(spark, d):
    nested = nested_lines(spark, d)
    text = F.transform("order_details", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"]))
    return nested.select(
        "l_orderkey", F.size("order_details").cast("long").alias("n_lines"), F.array_join(text, ",").alias("lines")
    )


@query(
    "flatten_orders",
    f"""with lines as ({LATEST_LINES})
    select md5(md5(cast(l_orderkey as varchar)) || l_linenumber) as new_hash_key, md5(cast(l_orderkey as varchar)) as hash_key,
        l_orderkey, o_orderdate, l_linenumber, l_partkey, l_quantity as amount,
        year(o_orderdate) as year, month(o_orderdate) as month, day(o_orderdate) as day
    from lines join orders on l_orderkey = o_orderkey""",
)
def flatten_orders(spark, d):
    nested = nested_lines(spark, d).withColumn("hash_key", F.md5(F.col("l_orderkey").cast("string")))
    return shape.flatten_orders(
        nested, ordered_at="o_orderdate", detail_nr="l_linenumber", rename={"l_quantity": "amount"}
    )


@query(
    "explode_details",
    f"""with lines as ({LATEST_LINES})
    select l_orderkey, o_orderdate, l_linenumber, l_partkey, l_quantity from lines join orders on l_orderkey = o_orderkey""",
)
def explode_details(spark, d):
    return shape.explode_details(nested_lines(spark, d), "order_details")


@query(
    "sync_columns",
    "select s_suppkey, s_name, cast(null as varchar) as s_rating from supplier",
)
def sync_columns(spark, d):
    supplier = table(spark, d, "supplier")
    new = supplier.select("s_suppkey", "s_name", F.lit("A").alias("s_rating"))
    return merge.sync_columns(supplier, new)


@query(
    "sync_columns_stored",
    """select s_suppkey, s_name, case when s_suppkey % 3 = 0 then cast(null as varchar) when s_suppkey % 3 = 1 then 'B'
            else cast(null as varchar) end as s_rating,
        case when s_suppkey % 3 = 2 then 'late' end as s_comment, cast(s_nationkey as bigint) as s_nationkey from supplier""",
)
def sync_columns_stored(spark, d):
    """A stored table over merges that add, drop, retype and add again."""
    supplier = table(spark, d, "supplier")
    target = SnapshotTable(spark, shared_dir(spark, "supplier"), ["s_suppkey"], buckets=8)
    third = F.col("s_suppkey") % 3
    nation = F.col("s_nationkey").cast("int").alias("s_nationkey")
    target.merge(supplier.select("s_suppkey", "s_name", nation, F.lit("first").alias("s_comment")))
    rated = supplier.where(third == 1).select("s_suppkey", "s_name", nation, F.lit("B").alias("s_rating"))
    target.merge(rated, schema_change="sync_all_columns")  # drops the comment
    wide = supplier.where(third == 2).select("s_suppkey", "s_name", F.lit(None).cast("string").alias("s_rating"),
                                             F.lit("late").alias("s_comment"), F.col("s_nationkey").cast("bigint").alias("s_nationkey"))
    target.merge(wide, schema_change="sync_all_columns")  # widens the nation; comments of before stay gone
    return target.read()


@query("ignore_new_columns", "select s_suppkey, s_name, s_nationkey, cast(null as double) as s_acctbal from supplier")
def ignore_new_columns(spark, d):
    supplier = table(spark, d, "supplier")
    new = supplier.select("s_suppkey", "s_name", "s_nationkey", F.lit("A").alias("s_rating"))
    return merge.ignore_new_columns(new, supplier)


@query(
    "alter_columns",
    """select s_suppkey, s_name, s_nationkey, cast(null as bigint) as population, cast(null as varchar) as capital_city
    from supplier""",
)
def alter_columns(spark, d):
    return merge.alter_columns(
        table(spark, d, "supplier"), add={"population": "bigint", "capital_city": "string"}, drop=["s_acctbal"]
    )


@query(
    "update_where",
    """select s_suppkey, case when s_acctbal < 0 then 0 else s_acctbal end as s_acctbal,
        case when s_acctbal < 0 then 'blocked' else s_name end as s_name from supplier""",
)
def update_where(spark, d):
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_acctbal", "s_name")
    return merge.update_where(supplier, F.col("s_acctbal") < 0, {"s_acctbal": F.lit(0), "s_name": F.lit("blocked")})


@query("delete_where", "select * from supplier where not s_acctbal < 0")
def delete_where(spark, d):
    return merge.delete_where(table(spark, d, "supplier"), F.col("s_acctbal") < 0)


@query(
    "identity_key",
    "select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) as id from orders",
)
def identity_key(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return merge.identity_key(orders, "id", ["o_orderdate", "o_orderkey"], hot_rows=100)


@query(
    "identity_key_continued",
    """select s_suppkey, (select max(c_custkey) from customer) + row_number() over (order by s_suppkey) as c_custkey
    from supplier""",
)
def identity_key_continued(spark, d):
    return merge.identity_key(
        table(spark, d, "supplier").select("s_suppkey"), "c_custkey", ["s_suppkey"], table(spark, d, "customer")
    )


@query(
    "scalar_arithmetic",
    """select l_orderkey, l_linenumber, l_partkey,
        cast(cast(l_extendedprice as decimal(18,2)) * cast(l_quantity as decimal(18,2)) as double) as payable,
        l_quantity / 60 as minutes from lineitem""",
)
def arithmetic(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (money("l_extendedprice") * money("l_quantity")).cast("double").alias("payable"),
        (F.col("l_quantity") / 60).alias("minutes"),
    )
