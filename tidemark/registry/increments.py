"""History, change feeds, merges and harmonized tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import row_checksum, with_surrogate_key
from tidemark.operators import changes, history, merge
from tidemark.operators.ordered import KeyedOrder
from tidemark.plans import harmonize
from tidemark.plans.harmonize import Feed
from tidemark.plans.quality import test_valid_range
from tidemark.registry.base import (
    EVENT_FEED, LATEST_LINES, LINE_KEYS, LINE_ORDER, event_feed, latest_lines, query, stored_lines, table,
)
from tidemark.registry.shapes import TWO_FEEDS, two_feeds
from tidemark.session import shared_dir
from tidemark.sources.tables import read_df, write_table


def states(spark, d):
    return table(spark, d, "events").select("user_id", "event_type", "ts")


def scd2_sql(source="events", columns="user_id, event_type, ts", changed="event_type", first=None, where=""):
    start = f"case when previous is null then timestamp '{first}' else ts end" if first else "ts"
    return f"""
        with compared as (
            select *, lag({changed}) over w as previous, row_number() over w as position
            from {source} window w as (partition by user_id order by ts)),
        kept as (
            select *, lead(ts) over (partition by user_id order by ts) as next_ts
            from compared where position = 1 or previous is distinct from {changed})
        select {columns}, {start} as valid_from,
            coalesce(next_ts - interval 1 millisecond, timestamp '9999-12-31') as valid_to, next_ts is null as is_current
        from kept {where}"""


@query("scd2_history", scd2_sql())
def scd2_history(spark, d):
    return history.scd2_history(states(spark, d), ["user_id"], "ts")


@query("scd2_hot_keys", scd2_sql())
def scd2_hot_keys(spark, d):
    """The same history with users of many rows cut into slices."""
    return history.scd2_history(states(spark, d), ["user_id"], "ts", hot_rows=5)


@query("scd2_first_valid_from", scd2_sql(first="1900-01-01"))
def scd2_first_valid_from(spark, d):
    return history.scd2_history(states(spark, d), ["user_id"], "ts", first_valid_from="1900-01-01")


@query("scd2_exclude", scd2_sql(columns="user_id, event_type, props, ts"))
def scd2_exclude(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "props", "ts")
    return history.scd2_history(events, ["user_id"], "ts", exclude_from_check=["props"])


@query("current_only", scd2_sql(where="where next_ts is null"))
def current_only(spark, d):
    return history.current_only(history.scd2_history(states(spark, d), ["user_id"], "ts"))


MARKED = """
    marked as (
        select user_id, case when event_type = 'error' then null else event_type end as event_type,
            case when event_type = 'error' then 'D' end as operation, ts from events)
"""


@query(
    "scd2_with_deletes",
    "with " + MARKED + ", history as (" + scd2_sql(
        "marked", "user_id, event_type, ts, operation", "coalesce(event_type, '') || '|' || coalesce(operation, '')"
    ) + ") select * from history",
)
def scd2_with_deletes(spark, d):
    from tidemark.operators.shape import union_soft_deletes

    events = states(spark, d)
    live = events.where("event_type <> 'error'")
    gone = events.where("event_type = 'error'").select("user_id", "ts", F.lit("D").alias("operation"))
    return history.scd2_history(union_soft_deletes(live, gone), ["user_id"], "ts")


@query(
    "test_valid_range",
    f"""with h as ({scd2_sql()})
    select user_id, event_type, valid_from, valid_to from (
        select user_id, event_type, valid_from,
            case when event_type = 'error' then valid_from - interval 1 day else valid_to end as valid_to from h)
    where valid_from > valid_to""",
)
def valid_range(spark, d):
    versions = history.scd2_history(states(spark, d), ["user_id"], "ts")
    broken = versions.withColumn(
        "valid_to",
        F.when(F.col("event_type") == "error", F.col("valid_from") - F.expr("interval 1 day")).otherwise(F.col("valid_to")),
    )
    return test_valid_range(broken).select("user_id", "event_type", "valid_from", "valid_to")


@query(
    "lag_checksum",
    """select user_id, event_type, ts, md5(user_id || '|' || event_type) as row_checksum,
        lag(md5(user_id || '|' || event_type)) over (partition by user_id order by ts) as previous_checksum from events""",
)
def lag_checksum(spark, d):
    return history.lag_checksum(states(spark, d), ["user_id"], "ts", ["user_id", "event_type"], hot_rows=5)


@query(
    "lead_next_change",
    "select user_id, ts, lead(ts) over (partition by user_id order by ts) as next_change_at from events",
)
def lead_next_change(spark, d):
    kept = states(spark, d).select("user_id", "ts")
    time = KeyedOrder(kept, ["user_id"], ["ts"], hot_rows=5)
    return time.plain(time.next(time.sliced(kept), "ts", "next_change_at"))


@query(
    "lead_default",
    """select user_id, event_type, ts as valid_from,
        lead(ts, 1, timestamp '9999-12-31') over (partition by user_id order by ts) as valid_to from events""",
)
def lead_default(spark, d):
    versions = states(spark, d).withColumnRenamed("ts", "valid_from")
    return history.with_version_end(versions, ["user_id"], "valid_from")


@query(
    "row_number_per_header",
    f"""select l_orderkey, l_linenumber, l_partkey, row_number() over (
        partition by l_orderkey order by {', '.join(c + ' desc' for c in [*LINE_ORDER, 'l_linenumber'])}) as row_num
    from lineitem qualify row_num <> 1""",
)
def row_number_per_header(spark, d):
    ranked = history.row_number_per_header(
        table(spark, d, "lineitem"), ["l_orderkey"], [*LINE_ORDER, "l_linenumber"], hot_rows=5
    )
    return ranked.where("row_num <> 1").select("l_orderkey", "l_linenumber", "l_partkey", "row_num")


LATEST_EVENT = """
    select event_id, user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id order by ts desc) = 1
"""


@query("dedup_latest", LATEST_EVENT)
def dedup_latest(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return history.dedup_latest(events, ["user_id"], ["ts"])


@query("dedup_latest_multi", LATEST_LINES)
def dedup_latest_multi(spark, d):
    return latest_lines(spark, d)


@query(
    "top1_per_key",
    """select o_custkey, o_orderkey, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey desc) = 1""",
)
def top1_per_key(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return history.top1_per_key(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query(
    "dedup_last_change",
    f"""with feed as ({EVENT_FEED}) select * from feed where _change_type in ('insert', 'update_postimage')
    qualify row_number() over (partition by user_id order by _commit_version desc, event_id desc) = 1""",
)
def dedup_last_change(spark, d):
    feed = event_feed(spark, d)
    return changes.dedup_last_change(feed.select(*feed.columns), ["user_id"])


@query(
    "latest_changes",
    f"""with feed as ({EVENT_FEED}) select event_id, user_id, ts, value from feed
    where _commit_version >= 10 and _change_type in ('insert', 'update_postimage')
    qualify row_number() over (partition by user_id order by ts desc) = 1""",
)
def latest_changes(spark, d):
    return changes.latest_changes(event_feed(spark, d), 10, ["user_id"], ["ts"])


@query(
    "latest_changes_with_deletes",
    f"""with feed as ({EVENT_FEED}) select event_id, user_id, ts, value,
        case when _change_type = 'delete' then _commit_timestamp end as deleted_date from feed
    where _commit_version >= 10 and _change_type in ('insert', 'update_postimage', 'delete')
    qualify row_number() over (partition by user_id order by ts desc) = 1""",
)
def latest_changes_with_deletes(spark, d):
    return changes.latest_changes(event_feed(spark, d), 10, ["user_id"], ["ts"], append_delete=True)


CHANGE_HISTORY = """
    select version, count(*) filter (kind = 'CREATE TABLE AS SELECT') > 0 as destructive from (
        select date_diff('day', date '2024-01-01', cast(ts as date)) as version,
            case when event_type = 'signup' and value > 100 then 'CREATE TABLE AS SELECT' else 'WRITE' end as kind from events)
    where version < 20 or kind = 'WRITE' group by 1
"""


def change_history(spark, d):
    """History of the events as a table: one operation per event, large signups create it."""
    feed = event_feed(spark, d)
    created = (F.col("_change_type") == "insert") & (F.col("value") > 100)
    operation = F.when(created, "CREATE TABLE AS SELECT").otherwise("WRITE")
    rows = feed.select(F.col("_commit_version").alias("version"), operation.alias("operation"), F.lit("{}").alias("operationParameters"))
    return rows.where("version < 20 or operation = 'WRITE'")


@query(
    "soft_delete_column",
    f"""with feed as ({EVENT_FEED}) select *, case when _change_type = 'delete' then _commit_timestamp end as deleted_date
    from feed""",
)
def soft_delete_column(spark, d):
    return changes.soft_delete_column(event_feed(spark, d))


INCREMENT = """qualify row_number() over (partition by user_id order by ts desc) = 1"""


@query(
    "plan_increment",
    f"""with feed as ({EVENT_FEED}), history as ({CHANGE_HISTORY}),
    versions as (select max(version) as last, coalesce(max(version) filter (destructive), -1) as valid from history),
    changes as (
        select event_id, user_id, ts, value, _commit_version from feed where _change_type in ('insert', 'update_postimage'))
    select 'feed off' as situation, event_id, user_id, ts, value from feed
    union all select 'version unknown', event_id, user_id, ts, value from feed
    union all (select 'newer', event_id, user_id, ts, value from changes, versions where _commit_version >= greatest(11, valid) {INCREMENT})
    union all (select 'long ago', event_id, user_id, ts, value from changes, versions where _commit_version >= greatest(1, valid) {INCREMENT})""",
)
def plan_increment(spark, d):
    """All situations, from a table history and the loads so far; nothing comes of a source
    that is at the loaded version, and one behind it is refused."""
    feed = event_feed(spark, d)
    source = feed.drop(*changes.FEED_COLUMNS)
    seen = changes.scan_history(change_history(spark, d)).first()
    last, valid = seen["source_last_update_version"], seen["source_first_valid_update_version"]
    state = changes.SourceState(last, changes.UNKNOWN_VERSION if valid is None else valid)
    off = changes.SourceState(state.last_version, state.first_valid_version, feed_enabled=False)

    def planned(situation, loaded, state=state):
        rows, _ = changes.plan_increment(source, feed, state, loaded, ["user_id"], ["ts"])
        return rows.withColumn("situation", F.lit(situation))

    found = [planned("feed off", 10, off), planned("version unknown", None), planned("newer", 10), planned("long ago", 0), planned("same", last)]
    try:
        found.append(planned("behind", last + 1))
    except changes.SourceBehindTarget:
        pass
    return reduce(DataFrame.unionByName, found)


SNAPSHOTS = """
    old as (select o_orderkey, o_orderpriority, o_totalprice from orders where o_orderstatus <> 'O'),
    new as (select o_orderkey, case when o_orderpriority = '1-URGENT' then '2-HIGH' else o_orderpriority end as o_orderpriority,
        o_totalprice from orders where o_orderstatus <> 'F')
"""


def snapshots(spark, d):
    orders = table(spark, d, "orders")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    lowered = orders.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderpriority") == "1-URGENT", "2-HIGH").otherwise(F.col("o_orderpriority")),
    )
    return orders.where("o_orderstatus <> 'O'").select(*columns), lowered.where("o_orderstatus <> 'F'").select(*columns)


CHANGES = f"""with {SNAPSHOTS}, both_rows as (
        select old.o_orderkey as ok, old.o_orderpriority as op, old.o_totalprice as ot,
            new.o_orderkey as nk, new.o_orderpriority as np, new.o_totalprice as nt
        from old full join new on old.o_orderkey = new.o_orderkey)
    select nk as o_orderkey, np as o_orderpriority, nt as o_totalprice, 'insert' as _change_type,
        7 as _commit_version, timestamp '2024-01-07' as _commit_timestamp from both_rows where ok is null
    union all select ok, op, ot, 'delete', 7, timestamp '2024-01-07' from both_rows where nk is null
    union all select ok, op, ot, 'update_preimage', 7, timestamp '2024-01-07' from both_rows where ok = nk and op <> np
    union all select nk, np, nt, 'update_postimage', 7, timestamp '2024-01-07' from both_rows where ok = nk and op <> np"""


@query("change_feed", CHANGES)
def change_feed(spark, d):
    old, new = snapshots(spark, d)
    return changes.change_feed(old, new, ["o_orderkey"], 7, F.lit("2024-01-07").cast("timestamp_ntz"))


@query("change_feed_digests", CHANGES)
def change_feed_digests(spark, d):
    """Only buckets of keys whose digests differ are joined."""
    old, new = snapshots(spark, d)
    at = F.lit("2024-01-07").cast("timestamp_ntz")
    return changes.change_feed(old, new, ["o_orderkey"], 7, at, buckets=4096)


@query("replay_changes", f"with {SNAPSHOTS} select * from new")
def replay_changes(spark, d):
    """Feed of two snapshots, applied to the first one, gives the second."""
    old, new = snapshots(spark, d)
    feed = changes.change_feed(old, new, ["o_orderkey"], 7, F.lit("2024-01-07").cast("timestamp_ntz"))
    rows = changes.latest_changes(feed, 7, ["o_orderkey"], append_delete=True)
    target = merge.alter_columns(old, add={"deleted_date": "timestamp_ntz"})
    merged = merge.upsert(target, rows, ["o_orderkey"])
    return merge.delete_flagged(merged, "deleted_date").drop("deleted_date")


KEYED = ["user_id", "event_type"]
CUT = "2024-01-20"


def slices_of_events(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    before = history.dedup_latest(events.where(f"ts < timestamp_ntz'{CUT}'"), KEYED, ["ts"])
    after = history.dedup_latest(events.where(f"ts >= timestamp_ntz'{CUT}'"), KEYED, ["ts"])
    return before, after


@query(
    "upsert",
    """select user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc) = 1""",
)
def upsert(spark, d):
    before, after = slices_of_events(spark, d)
    return merge.upsert(before, after, KEYED)


@query(
    "append_history",
    """select user_id, ts, value, cast(null as varchar) as event_type from events where event_type in ('view', 'click')
    union all select user_id, ts, value, event_type from events
        where event_type is null or event_type not in ('view', 'click')""",
)
def append_history(spark, d):
    events = table(spark, d, "events")
    first = events.where("event_type in ('view', 'click')").select("user_id", "ts", "value")
    second = events.where("event_type is null or event_type not in ('view', 'click')").select("user_id", "ts", "value", "event_type")
    return merge.append_history(first, second)


@query(
    "coalesce_with_target",
    """select c_custkey, coalesce(case when c_acctbal >= 0 then c_mktsegment end, upper(n_name)) as segment
    from customer left join nation on c_nationkey = n_nationkey""",
)
def coalesce_with_target(spark, d):
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    update = customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("new_segment"))
    target = customer.join(nation, F.expr("c_nationkey = n_nationkey")).select(
        "c_custkey", F.upper("n_name").alias("segment")
    )
    return changes.coalesce_with_target(update, target, ["c_custkey"], {"new_segment": "segment"})


@query("delete_flagged", "select user_id, ts, cast(null as timestamp) as deleted_date from events where event_type <> 'error'")
def delete_flagged(spark, d):
    rows = table(spark, d, "events").select(
        "user_id", "ts", F.when(F.col("event_type") == "error", F.col("ts")).alias("deleted_date")
    )
    return merge.delete_flagged(rows, "deleted_date")


@query(
    "delete_opflag",
    """select event_id, case event_type when 'click' then 'I' when 'view' then 'U' end as OPFLAG from events
    where event_type <> 'error'""",
)
def delete_opflag(spark, d):
    kind = F.col("event_type")
    flag = F.when(kind == "click", "I").when(kind == "view", "U").when(kind == "error", "D")
    return merge.delete_opflag(table(spark, d, "events").select("event_id", flag.alias("OPFLAG")))


DOCUMENT = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate"


@query(
    "document_replace",
    f"""with lines as ({LATEST_LINES}) select {DOCUMENT} from lines
    where l_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""",
)
def document_replace(spark, d):
    increment = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    target = latest_lines(spark, d).select(*DOCUMENT.split(", "))
    return merge.document_replace(target, increment, ["l_orderkey"])


@query(
    "document_load",
    f"""with lines as ({LATEST_LINES}), increment as (
        select * from lineitem where l_returnflag = 'R' qualify row_number() over (
            partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in LINE_ORDER)}) = 1)
    select {DOCUMENT} from lines where l_orderkey not in (select l_orderkey from increment)
    union all select {DOCUMENT} from increment""",
)
def document_load(spark, d):
    columns = DOCUMENT.split(", ")
    increment = history.dedup_latest(table(spark, d, "lineitem").where("l_returnflag = 'R'"), LINE_KEYS, LINE_ORDER)
    return merge.document_load(
        latest_lines(spark, d).select(*columns), increment.select(*columns), ["l_orderkey"], LINE_KEYS
    )


def flagged_lines(spark, d):
    return table(spark, d, "lineitem").withColumn(
        "OPFLAG", F.when(F.col("l_returnflag") == "R", "D").otherwise("I")
    )


@query(
    "document_prune",
    f"""with lines as ({LATEST_LINES}), kept as (
        select l_orderkey, l_linenumber from lineitem
        qualify dense_rank() over (partition by l_orderkey order by l_shipdate desc) = 1)
    select {DOCUMENT} from lines
    where (l_orderkey, l_linenumber) in (select l_orderkey, l_linenumber from kept)
        and (l_orderkey, l_linenumber) not in (select l_orderkey, l_linenumber from lineitem where l_returnflag = 'R')""",
)
def document_prune(spark, d):
    target = latest_lines(spark, d).select(*DOCUMENT.split(", "))
    return merge.document_prune(target, flagged_lines(spark, d), ["l_orderkey"], LINE_KEYS, ["l_shipdate"])


@query(
    "document_prune_row_number",
    f"""with lines as ({LATEST_LINES}), ranked as (
        select l_orderkey, l_linenumber, l_returnflag, row_number() over (
            partition by l_orderkey order by {', '.join(c + ' desc' for c in [*LINE_ORDER, 'l_linenumber'])}) as rn
        from lineitem),
    gone as (select l_orderkey, l_linenumber from ranked where rn <> 1 or l_returnflag = 'R')
    select {DOCUMENT} from lines where (l_orderkey, l_linenumber) not in (select l_orderkey, l_linenumber from gone)""",
)
def document_prune_row_number(spark, d):
    target = latest_lines(spark, d).select(*DOCUMENT.split(", "))
    return merge.document_prune(
        target, flagged_lines(spark, d), ["l_orderkey"], LINE_KEYS, [*LINE_ORDER, "l_linenumber"], mode="row_number"
    )


@query(
    "scd1_with_delete_feed",
    """select user_id, event_type, ts, value, cast(null as varchar) as operation from (
        select * from events
        qualify row_number() over (partition by user_id order by ts desc) = 1)
    where event_type <> 'error'""",
)
def scd1_with_delete_feed(spark, d):
    """Live and delete rows of two loads; error events play the delete feed."""
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    live = events.where("event_type <> 'error'")
    gone = events.where("event_type = 'error'").select("user_id", "ts", F.lit("D").alias("operation"))
    target = None
    for period in (f"ts < timestamp_ntz'{CUT}'", f"ts >= timestamp_ntz'{CUT}'"):
        target = merge.scd1_with_delete_feed(target, live.where(period), gone.where(period), ["user_id"], ["ts"])
    return target


TOTALS = "select o_custkey as c_custkey, count(*) as orders from orders group by 1"


def customer_totals(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    totals = (
        table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    )
    return customer, totals


JOINED = f"select c.c_custkey, c_name, c_mktsegment, orders from customer c left join ({TOTALS}) t on c.c_custkey = t.c_custkey"


@query("scd1_join", JOINED)
def scd1_join(spark, d):
    customer, totals = customer_totals(spark, d)
    first = harmonize.scd1_join(None, customer.where("c_mktsegment <> 'BUILDING'"), totals, ["c_custkey"])
    return harmonize.scd1_join(first, customer.where("c_mktsegment = 'BUILDING'"), totals, ["c_custkey"])


@query("join_view", JOINED)
def join_view(spark, d):
    return harmonize.join_view(*customer_totals(spark, d), ["c_custkey"])


@query(
    "scd1_join_with_delete",
    f"""with target as ({JOINED}), deleted as (select c_custkey from customer where c_acctbal < 0)
    select c_custkey, c_name, case when orders > 2 then 'NEW' else c_mktsegment end as c_mktsegment, orders,
        cast(null as varchar) as operation
    from target where not (c_custkey in (select * from deleted) and orders > 2)""",
)
def scd1_join_with_delete(spark, d):
    customer, totals = customer_totals(spark, d)
    keys = ["c_custkey"]
    target = merge.alter_columns(harmonize.join_view(customer, totals, keys), add={"operation": "string"})
    negative = table(spark, d, "customer").where("c_acctbal < 0").select("c_custkey", F.lit("D").alias("operation"))
    updated = customer.withColumn("c_mktsegment", F.lit("NEW")).join(negative, keys, "left")
    return harmonize.scd1_join_with_delete(
        target, updated, totals, keys, [totals.where("orders > 2")], "operation"
    ).select("c_custkey", "c_name", "c_mktsegment", "orders", "operation")


@query(
    "load_keyed",
    """select user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc) = 1""",
)
def load_keyed(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    target = harmonize.load_keyed(None, events.where(f"ts < timestamp_ntz'{CUT}'"), KEYED, ["ts"])
    return harmonize.load_keyed(target, events, KEYED, ["ts"], mark="ts")


@query("load_two_feeds", f"with u as ({TWO_FEEDS}) select *, right(name, 3) as partition_key from u where opflag <> 'D'")
def load_two_feeds(spark, d):
    first, second = two_feeds(spark, d)
    return harmonize.load_two_feeds(
        None, first, second, ("MAIN", "OTHER"), ["nr"], ["changed"], "changed", ("name", 3), flag="opflag"
    )


def fact_feeds(spark, d):
    header = Feed(
        table(spark, d, "orders"),
        {"o_orderkey": "Document_Number", "o_custkey": "Client", "o_totalprice": "Amount", "o_orderdate": "Header_Ingested_At"},
        ("o_orderstatus", "O"), "Header_Ingested_At",
    )
    detail = Feed(
        stored_lines(spark, d),
        {"l_orderkey": "Document_Number", "l_linenumber": "Line_Item", "l_partkey": "Material", "l_shipdate": "Detail_Ingested_At"},
        None, "Detail_Ingested_At",
    )
    return header, detail


FACT = f"""
    lines as ({LATEST_LINES}),
    joined as (
        select o_orderkey as Document_Number, o_totalprice as Amount, o_orderdate as Header_Ingested_At,
            l_linenumber as Line_Item, l_partkey as Material, l_shipdate as Detail_Ingested_At,
            'D80_' || o_custkey as Source_ID, timestamp '2024-02-01' as Ingested_At
        from orders left join lines on o_orderkey = l_orderkey where o_orderstatus = 'O')
"""
NOW = "2024-02-01"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("harmonize_fact", f"with {FACT} select * from joined")
def harmonize_fact(spark, d):
    return harmonize.harmonize_fact(*fact_feeds(spark, d), ["Document_Number"], system_id="D80", client="Client", now=now())


@query(
    "header_detail_fact",
    f"""with {FACT}, loaded as (
        select * from joined where Header_Ingested_At < timestamp '1998-01-01' and Detail_Ingested_At < timestamp '1998-02-01'),
    affected as (
        select Document_Number from joined where Header_Ingested_At > (select max(Header_Ingested_At) from loaded)
        union
        select Document_Number from joined where Detail_Ingested_At > (select max(Detail_Ingested_At) from loaded))
    select * from joined where Document_Number in (select Document_Number from affected)""",
)
def header_detail_fact(spark, d):
    """Increment of the fact against a target that holds the older documents."""
    header, detail = fact_feeds(spark, d)
    options = {"system_id": "D80", "client": "Client", "now": now()}
    path = shared_dir(spark, "fact")
    older = harmonize.harmonize_fact(header, detail, ["Document_Number"], **options).where(
        "Header_Ingested_At < timestamp_ntz'1998-01-01' and Detail_Ingested_At < timestamp_ntz'1998-02-01'"
    )
    write_table(older, path)
    return harmonize.harmonize_fact(header, detail, ["Document_Number"], target=read_df(spark, path), **options)


@query(
    "harmonize_balance",
    """select o_orderkey as Doc_Number, o_totalprice as Balance, o_orderdate as Loaded_At,
        timestamp '2024-02-01' as Ingested_At, 'P80_' || o_orderpriority as Source_ID
    from orders where o_orderstatus = 'F'
        and o_orderdate > (select max(o_orderdate) from orders where o_orderstatus = 'F' and o_orderdate < timestamp '1997-01-01')""",
)
def harmonize_balance(spark, d):
    feed = Feed(
        table(spark, d, "orders"),
        {"o_orderkey": "Doc_Number", "o_totalprice": "Balance", "o_orderdate": "Loaded_At", "o_orderpriority": "Client"},
        ("o_orderstatus", "F"), "Loaded_At",
    )
    loaded = harmonize.harmonize_balance(feed, "P80", "Client", now=now()).where("Loaded_At < timestamp_ntz'1997-01-01'")
    return harmonize.harmonize_balance(feed, "P80", "Client", loaded, now())


@query(
    "harmonize_master",
    """select c_custkey as Customer_Number, c_name as Customer_Name, o_orderkey as Company_Code, o_totalprice as Credit_Limit,
        timestamp '2024-02-01' as Ingested_At, 'D80_' || c_mktsegment as Source_ID
    from customer left join orders on c_custkey = o_custkey""",
)
def harmonize_master(spark, d):
    master = Feed(
        table(spark, d, "customer"), {"c_custkey": "Customer_Number", "c_name": "Customer_Name", "c_mktsegment": "Client"}
    )
    company = Feed(
        table(spark, d, "orders"), {"o_custkey": "Customer_Number", "o_orderkey": "Company_Code", "o_totalprice": "Credit_Limit"}
    )
    return harmonize.harmonize_master(master, company, ["Customer_Number"], system_id="D80", client="Client", now=now())


@query(
    "harmonize_master3",
    """select p_partkey as Account, p_brand as Chart, s_suppkey as Company, text_name as Account_Text,
        timestamp '2024-02-01' as Ingested_At, 'D80_' || p_type as Source_ID
    from part
    left join (select distinct l_partkey, l_suppkey as s_suppkey from lineitem) on p_partkey = l_partkey
    left join (select p_partkey as tk, p_brand as tb, upper(p_name) as text_name from part)
        on p_partkey = tk and p_brand = tb""",
)
def harmonize_master3(spark, d):
    part = table(spark, d, "part")
    account = Feed(part, {"p_partkey": "Account", "p_brand": "Chart", "p_type": "Client"})
    company = Feed(
        table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct(),
        {"l_partkey": "Account", "l_suppkey": "Company"},
    )
    text = Feed(
        part.withColumn("p_name", F.upper("p_name")),
        {"p_partkey": "Account", "p_brand": "Chart", "p_name": "Account_Text"},
    )
    return harmonize.harmonize_master3(
        account, company, text, ["Account"], ["Account", "Chart"], system_id="D80", client="Client", now=now()
    )


@query(
    "harmonize_reference",
    """select s_suppkey as Company_Code, s_name as Company_Name, timestamp '2024-02-01' as Ingested_At,
        'D80_' || s_nationkey as Source_ID from supplier where s_nationkey = 3""",
)
def harmonize_reference(spark, d):
    feed = Feed(
        table(spark, d, "supplier"),
        {"s_suppkey": "Company_Code", "s_name": "Company_Name", "s_nationkey": "Client"}, ("s_nationkey", 3),
    )
    return harmonize.harmonize_reference(feed, "D80", "Client", now())


@query(
    "surrogate_key",
    """select o_orderkey, md5(cast(o_orderkey as varchar) || '-' || cast(o_custkey as varchar) || '-' ||
        coalesce(nullif(o_orderstatus, 'F'), '_dbt_utils_surrogate_key_null_')) as orders_sk from orders""",
)
def surrogate(spark, d):
    orders = table(spark, d, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    keyed = with_surrogate_key(orders, "fct__orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    return keyed.select("o_orderkey", "orders_sk")


@query(
    "row_checksum",
    """select c_custkey, md5(c_custkey || '|' || c_name || '|' || c_nationkey || '|' || coalesce(nullif(c_mktsegment, 'BUILDING'), ''))
        as row_checksum from customer""",
)
def checksum(spark, d):
    customer = table(spark, d, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return customer.select("c_custkey", row_checksum(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).alias("row_checksum"))
