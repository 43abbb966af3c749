"""Scans and sinks."""

from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.operators.joins import insert_select_where_new
from tidemark.plans import loads
from tidemark.registry.base import EVENT_FEED, event_feed, query, table
from tidemark.session import shared_dir
from tidemark.sources import tables as io
from tidemark.sources.landing import LandingLedger
from tidemark.sources.snapshots import SnapshotTable, load_state, save_load_version

EVENT_JSON = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@query("scan_table", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def scan_table(spark, d):
    return io.scan_table(spark, "orders", d).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("scan_model", "select o_custkey, o_orderstatus, count(*) as n from orders group by 1, 2")
def scan_model(spark, d):
    model = io.publish_view(table(spark, d, "orders").select("o_custkey", "o_orderstatus"), "order_states")
    return model.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("scan_changes", f"with feed as ({EVENT_FEED}) select * from feed where _commit_version >= 20")
def scan_changes(spark, d):
    return changes.scan_changes(event_feed(spark, d), 20)


@query("scan_empty", "select c_custkey, c_name from customer where false")
def scan_empty(spark, d):
    return changes.scan_empty(table(spark, d, "customer").select("c_custkey", "c_name"))


@query("scan_json_landing", "select event_id, ts, user_id, event_type, value, props, true as has_path from events")
def scan_json_landing(spark, d):
    folder = shared_dir(spark, "landing")
    table(spark, d, "events").write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(folder)
    rows = io.scan_json_landing(spark, folder, EVENT_JSON)
    return rows.select(
        "event_id", "ts", "user_id", "event_type", "value", "props", F.col("file_path").endswith(".json").alias("has_path")
    )


NEW_EVENTS = "select event_id, ts, user_id, event_type, value, props from events where event_type <> 'signup' or event_type is null"


def arrivals(spark, d):
    """A landing folder and the two loads that arrive in it."""
    events = table(spark, d, "events")
    signup = F.coalesce(F.col("event_type") == "signup", F.lit(False))
    return shared_dir(spark, "landing"), events.where(signup), events.where(~signup)


def write_json(df, folder):
    df.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(folder)


@query("scan_json_new_files", NEW_EVENTS)
def scan_json_new_files(spark, d):
    folder, first, second = arrivals(spark, d)
    ledger = LandingLedger(spark, folder, shared_dir(spark, "ledger"), EVENT_JSON, max_files=100)
    write_json(first, folder)
    io.write_table(io.scan_json_new_files(spark, folder, ledger), shared_dir(spark, "loaded"))
    ledger.confirm()
    write_json(second, folder)
    return io.scan_json_new_files(spark, folder, ledger).drop("file_path")


@query("scan_json_new_files_by_table", NEW_EVENTS)
def scan_json_new_files_by_table(spark, d):
    folder, first, second = arrivals(spark, d)
    target = shared_dir(spark, "loaded")
    write_json(first, folder)
    io.write_table(io.scan_json_landing(spark, folder, EVENT_JSON), target)
    write_json(second, folder)
    return io.scan_json_new_files(spark, folder, io.read_df(spark, target), EVENT_JSON).drop("file_path")


@query(
    "scan_csv_seed",
    "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment from customer",
)
def scan_csv_seed(spark, d):
    folder = shared_dir(spark, "seed")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(folder)
    return io.scan_csv_seed(spark, folder, ["c_custkey", "c_name", "c_mktsegment"])


HISTORY = f"""
    select user_id as table_id, event_id as version,
        case event_type when 'signup' then 'CREATE TABLE AS SELECT' when 'error' then 'DROP COLUMNS'
            when 'view' then 'SET TBLPROPERTIES' else 'WRITE' end as operation,
        case when event_type = 'view' and value > 100 then '{{"properties":"{{\\"delta.enableChangeDataFeed":"true\\"}}"}}'
            else '{{}}' end as operationParameters
    from events
"""


def table_history(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("user_id").alias("table_id"),
        F.col("event_id").alias("version"),
        F.when(kind == "signup", "CREATE TABLE AS SELECT").when(kind == "error", "DROP COLUMNS")
        .when(kind == "view", "SET TBLPROPERTIES").otherwise("WRITE").alias("operation"),
        F.when((kind == "view") & (F.col("value") > 100), '{"properties":"{\\"delta.enableChangeDataFeed":"true\\"}"}')
        .otherwise("{}").alias("operationParameters"),
    )


SCAN_HISTORY = f"""
    with h as ({HISTORY})
    select table_id, max(version) as source_last_update_version,
        max(version) filter (operation like '%CREATE%TABLE%'
            or operation in ('REPLACE TABLE AS SELECT', 'DROP COLUMNS', 'RENAME COLUMN')
            or operationParameters like '%delta.enableChangeDataFeed":"true%') as source_first_valid_update_version
    from h group by 1
"""


@query("scan_history", SCAN_HISTORY)
def scan_history(spark, d):
    return changes.scan_history(table_history(spark, d), ["table_id"])


@query(
    "start_version",
    f"""with h as ({SCAN_HISTORY}), loaded as (
        select user_id as table_id, max(event_id) as last_loaded from events where ts < timestamp '2024-01-10' group by 1)
    select table_id, greatest(last_loaded + 1, source_first_valid_update_version) as start_version
    from h join loaded using (table_id)""",
)
def start_version(spark, d):
    loaded = (
        table(spark, d, "events").where("ts < timestamp_ntz'2024-01-10'")
        .groupBy(F.col("user_id").alias("table_id")).agg(F.max("event_id").alias("last_loaded"))
    )
    known = changes.scan_history(table_history(spark, d), ["table_id"])
    return known.join(loaded, ["table_id"]).select(
        "table_id",
        changes.start_version(F.col("last_loaded"), F.col("source_first_valid_update_version")).alias("start_version"),
    )


@query(
    "literal_rows",
    """select status_name, count(*) as n from orders
    join (values ('F', 'finished'), ('O', 'open'), ('P', 'partial')) s(o_orderstatus, status_name)
        using (o_orderstatus) group by 1""",
)
def literal_rows(spark, d):
    statuses = io.literal_rows(
        spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, status_name string"
    )
    return (
        table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
        .join(statuses, ["o_orderstatus"]).select("status_name", "n")
    )


@query("write_table", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier where s_acctbal > 0")
def write_table(spark, d):
    path = shared_dir(spark, "table")
    supplier = table(spark, d, "supplier")
    io.write_table(supplier, path)
    io.write_table(supplier.where("s_acctbal > 0"), path)
    return io.read_df(spark, path)


@query(
    "write_append",
    "select o_orderkey, o_orderstatus, o_totalprice from orders",
)
def write_append(spark, d):
    path = shared_dir(spark, "append")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    io.write_append(orders.where("o_orderstatus <=> 'F'"), path)
    io.write_append(orders.where("not o_orderstatus <=> 'F'"), path)
    return io.read_df(spark, path)


@query(
    "write_merge",
    """select user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc) = 1""",
)
def write_merge(spark, d):
    from tidemark.operators.history import dedup_latest

    keys = ["user_id", "event_type"]
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    target = SnapshotTable(spark, shared_dir(spark, "merge"), keys, buckets=8)
    for period in ("ts < timestamp_ntz'2024-01-20'", "ts >= timestamp_ntz'2024-01-20'"):
        target.merge(dedup_latest(events.where(period), keys, ["ts"]))
    return target.read()


@query(
    "write_df",
    """select s_suppkey, s_name, cast(null as double) as s_acctbal from supplier where s_acctbal < 0
    union all select s_suppkey, s_name, s_acctbal from supplier where s_acctbal >= 0""",
)
def write_df(spark, d):
    path = shared_dir(spark, "frame")
    supplier = table(spark, d, "supplier")
    io.write_df(supplier.where("s_acctbal < 0").select("s_suppkey", "s_name"), path, "Overwrite")
    io.write_df(supplier.where("s_acctbal >= 0").select("s_suppkey", "s_name", "s_acctbal"), path, "Append")
    return io.read_df(spark, path).select("s_suppkey", "s_name", "s_acctbal")


@query("read_df", "select p_partkey, p_brand, p_size from part")
def read_df(spark, d):
    path = shared_dir(spark, "frame")
    io.write_df(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), path, "overwrite")
    return io.read_df(spark, path)


@query(
    "write_partitioned",
    "select o_orderkey, o_totalprice, year(o_orderdate) as year, month(o_orderdate) as month from orders",
)
def write_partitioned(spark, d):
    path = shared_dir(spark, "partitioned")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    io.write_partitioned(orders, path, ["year", "month"])
    return spark.read.parquet(path)


@query("write_external", "select c_custkey, c_name, c_acctbal from customer")
def write_external(spark, d):
    path = shared_dir(spark, "external")
    name = "external_" + path.rsplit("-", 1)[-1]
    io.write_external(
        table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path, name
    )
    rows = io.read_df(spark, path)
    spark.sql(f"drop table {name}")  # an external table leaves its files
    return rows


@query("publish_view", "select n_name, r_name from nation join region on n_regionkey = r_regionkey")
def publish_view(spark, d):
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    return io.publish_view(joined.select("n_name", "r_name"), "nation_region")


@query(
    "insert_select_where_new",
    """select user_id, event_type from events where ts >= timestamp '2024-01-03'
    except select user_id, event_type from events where ts < timestamp '2024-01-03'""",
)
def new_rows(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "ts")
    known = events.where("ts < timestamp_ntz'2024-01-03'")
    later = events.where("ts >= timestamp_ntz'2024-01-03'").select("user_id", "event_type").distinct()
    return insert_select_where_new(known, later, ["user_id", "event_type"])


@query("save_load_version", "select event_type as source, max(event_id) as last_version from events group by 1")
def load_versions(spark, d):
    path = shared_dir(spark, "state")
    events = table(spark, d, "events")
    for period in ("ts < timestamp_ntz'2024-01-15'", "true"):
        versions = events.where(period).groupBy("event_type").agg(F.max("event_id").alias("v"))
        for row in versions.collect():  # one row per source
            save_load_version(spark, path, row["event_type"], row["v"])
    return load_state(spark, path)


@query(
    "load_increment",
    """select o_orderkey, o_orderpriority, o_totalprice from orders where o_orderstatus is distinct from 'F'""",
)
def load_increment(spark, d):
    """A stored table brought up to a source twice, its load state in the same commits: all
    orders first, then from a feed of changes in which finished orders are deleted."""
    orders = table(spark, d, "orders")
    now = orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    before = now.withColumn("o_orderpriority", F.lit("old")).drop("o_orderstatus")
    after = now.where("o_orderstatus is distinct from 'F'").drop("o_orderstatus")
    target = SnapshotTable(spark, shared_dir(spark, "orders"), ["o_orderkey"], buckets=8)
    at = F.lit("2024-01-02").cast("timestamp_ntz")
    feed = changes.change_feed(before, after, ["o_orderkey"], 2, at)
    for source, version in ((before, 1), (after, 2), (after, 2)):
        loads.load_increment(target, "orders", source, feed, changes.SourceState(version), delete_column="deleted_date")
    return target.read().drop("deleted_date")
