"""Joins and aggregations."""

from pyspark.sql import functions as F

from tidemark.functions.calendar import date_dimension_of
from tidemark.functions.keys import name
from tidemark.operators import joins
from tidemark.operators.history import overlapping_versions, range_join_validity, with_version_end
from tidemark.plans import harmonize, reports, sales
from tidemark.registry.base import LATEST_LINES, latest_lines, money, query, stored_lines, table
from tidemark.session import shared_dir
from tidemark.sources.snapshots import SnapshotTable



@query(
    "inner_join_keys",
    "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')",
)
def inner_join_keys(spark, d):
    affected = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.inner_join_keys(table(spark, d, "customer").select("c_custkey", "c_name"), affected, ["c_custkey"])


@query(
    "inner_join_composite",
    f"""with lines as ({LATEST_LINES})
    select l_orderkey, l_linenumber, l_partkey, l_quantity from lines
    where exists (select 1 from lineitem k where k.l_returnflag = 'R' and k.l_orderkey = lines.l_orderkey
        and k.l_linenumber = lines.l_linenumber and k.l_partkey = lines.l_partkey)""",
)
def inner_join_composite(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(*keys)
    return joins.inner_join_keys(latest_lines(spark, d).select(*keys, "l_quantity"), returned, keys)


@query(
    "semi_join_in",
    "select o_orderkey, o_totalprice from orders where o_orderkey in (select l_orderkey from lineitem where l_discount > 0.09)",
)
def semi_join_in(spark, d):
    lines = table(spark, d, "lineitem").where("l_discount > 0.09").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.semi_join_in(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), lines, ["o_orderkey"])


USER_DAYS = "select distinct user_id, cast(ts as date) as day from events"


@query(
    "semi",
    """select user_id, date_trunc('day', ts) as day, count(*) as n from events e
    where exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = e.user_id
        and date_trunc('day', p.ts) = date_trunc('day', e.ts)) group by 1, 2""",
)
def semi(spark, d):
    events = table(spark, d, "events").select("user_id", F.date_trunc("day", "ts").alias("day"), "event_type")
    buyers = events.where("event_type = 'purchase'")
    return joins.semi_join_in(events, buyers, ["user_id", "day"]).groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "anti_join",
    """select user_id, date_trunc('day', ts) as day, count(*) as n from events e
    where not exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = e.user_id
        and date_trunc('day', p.ts) = date_trunc('day', e.ts)) group by 1, 2""",
)
def anti_join(spark, d):
    events = table(spark, d, "events").select("user_id", F.date_trunc("day", "ts").alias("day"), "event_type")
    buyers = events.where("event_type = 'purchase'")
    return joins.anti_join(events, buyers, ["user_id", "day"]).groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "not_in",
    "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)",
)
def not_in(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000")
    return joins.not_in(table(spark, d, "customer").select("c_custkey"), "c_custkey", big, "o_custkey")


@query(
    "not_in_null_aware",
    """select c_custkey from customer
    where c_custkey not in (select case when o_totalprice > 400000 then o_custkey end from orders)""",
)
def not_in_null_aware(spark, d):
    partly = table(spark, d, "orders").select(F.when(F.col("o_totalprice") > 400000, F.col("o_custkey")).alias("key"))
    return joins.not_in(table(spark, d, "customer").select("c_custkey"), "c_custkey", partly, "key")


@query(
    "not_exists",
    """select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem n
    where not exists (select 1 from lineitem o where o.l_returnflag = 'N' and o.l_orderkey = n.l_orderkey
        and o.l_linenumber = n.l_linenumber and o.l_partkey = n.l_partkey and o.l_suppkey = n.l_suppkey)""",
)
def not_exists(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, d, "lineitem")
    return joins.not_exists(lines.select(*keys).distinct(), lines.where("l_returnflag = 'N'"), keys)


@query(
    "header_detail_join",
    f"""with lines as ({LATEST_LINES})
    select o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity
    from orders left join lines on o_orderkey = l_orderkey""",
)
def header_detail_join(spark, d):
    header = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    detail = stored_lines(spark, d).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    return joins.left_join_many(header, detail, ["o_orderkey"])


@query(
    "master_left_join",
    """select c_custkey, c_name, o_orderkey, o_totalprice from customer
    left join orders on c_custkey = o_custkey""",
)
def master_left_join(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return joins.left_join_many(table(spark, d, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"])


@query(
    "left_join_hot_keys",
    """select n_nationkey, n_name, c_custkey, c_acctbal from nation
    left join customer on n_nationkey = c_nationkey""",
)
def left_join_hot_keys(spark, d):
    """The right side holds so many rows per nation that each nation counts as hot."""
    customers = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_acctbal")
    return joins.left_join_many(table(spark, d, "nation").select("n_nationkey", "n_name"), customers, ["n_nationkey"], hot_rows=6)


@query(
    "affected_key_join_hot_keys",
    """select n_nationkey, n_name, c_custkey, c_acctbal from nation left join customer on n_nationkey = c_nationkey
    where n_nationkey in (select c_nationkey from customer where c_acctbal > 9000 union select s_nationkey from supplier)""",
)
def affected_key_join_hot_keys(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    customers = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_acctbal")
    suppliers = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    return harmonize.affected_key_join(
        nation, [(customers, ["n_nationkey"])], ["n_nationkey"],
        [customers.where("c_acctbal > 9000"), suppliers], hot_rows=6,
    )


@query(
    "three_way_left_join",
    """select n_nationkey, n_name, r_name, s_suppkey, s_name from nation
    left join region on n_regionkey = r_regionkey
    left join supplier on n_nationkey = s_nationkey""",
)
def three_way_left_join(spark, d):
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    supplier = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    return joins.left_join_chain(
        table(spark, d, "nation"), (region, ["n_regionkey"]), (supplier, ["n_nationkey"])
    ).drop("n_regionkey")


@query(
    "inner_join_lookup",
    """select label, count(*) as n, count(distinct user_id) as users from events
    join (values ('click', 'web'), ('view', 'web'), ('purchase', 'shop')) l(event_type, label) using (event_type)
    group by 1""",
)
def inner_join_lookup(spark, d):
    labels = spark.createDataFrame(
        [("click", "web"), ("view", "web"), ("purchase", "shop")], "event_type string, label string"
    )
    events = table(spark, d, "events").select("event_type", "user_id")
    return joins.inner_join_lookup(events, labels, ["event_type"]).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )


@query(
    "range_join_validity",
    """with versions as (
        select user_id, event_type as state, ts as valid_from,
            lead(ts, 1, timestamp '9999-12-31') over (partition by user_id order by ts) as valid_to
        from events where event_type <> 'purchase')
    select e.event_id, e.user_id, e.ts, v.state, v.valid_from, v.valid_to from events e join versions v
        on e.user_id = v.user_id and e.ts >= v.valid_from and e.ts < v.valid_to
    where e.event_type = 'purchase'""",
)
def range_join(spark, d, hot_rows=1_000_000):
    events = table(spark, d, "events")
    versions = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("event_type").alias("state"), F.col("ts").alias("valid_from")
    )
    ended = with_version_end(versions, ["user_id"], "valid_from", hot_rows=hot_rows)
    facts = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return range_join_validity(facts, ended, ["user_id"], "ts", hot_rows=hot_rows)


@query(
    "range_join_validity_hot_keys",
    """select e.event_id, e.user_id, e.ts, v.event_type as state, v.ts as valid_from
    from (select * from events where event_type = 'purchase') e
    asof join (select * from events where event_type <> 'purchase') v on e.user_id = v.user_id and e.ts >= v.ts""",
)
def range_join_hot(spark, d):
    events = table(spark, d, "events")
    versions = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("event_type").alias("state"), F.col("ts").alias("valid_from")
    )
    facts = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return range_join_validity(facts, versions, ["user_id"], "ts", valid_to=None, hot_rows=5)


OVERLAPPING = """
    versions as (select event_id as version_id, user_id, event_type as state, ts as valid_from,
        ts + to_hours(cast(floor(value) as bigint)) as valid_to from events where event_type <> 'purchase'),
    facts as (select event_id, user_id, ts from events where event_type = 'purchase')
"""


def overlapping(spark, d):
    """Facts, and versions that are valid for as many hours as their value, rounded down."""
    events = table(spark, d, "events")
    hours = F.make_dt_interval(hours=F.floor("value").cast("int"))
    versions = events.where("event_type <> 'purchase'").select(
        F.col("event_id").alias("version_id"), "user_id", F.col("event_type").alias("state"),
        F.col("ts").alias("valid_from"), (F.col("ts") + hours).alias("valid_to"),
    )
    return events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), versions


@query(
    "range_join_overlapping",
    f"""with {OVERLAPPING} select event_id, user_id, ts, version_id, state, valid_from, valid_to
    from facts join versions using (user_id) where ts >= valid_from and ts < valid_to""",
)
def range_join_overlapping(spark, d):
    facts, versions = overlapping(spark, d)
    return range_join_validity(facts, versions, ["user_id"], "ts", hot_rows=1_000_000, overlapping=True)


@query(
    "overlapping_versions",
    f"""with {OVERLAPPING}, followed as (
        select *, lead(valid_from) over (partition by user_id order by valid_from, valid_to) as next_from
        from versions where valid_from < valid_to)
    select * from followed where next_from < valid_to""",
)
def overlap_check(spark, d):
    return overlapping_versions(overlapping(spark, d)[1], ["user_id"])


SIZES = ["small", "medium", "large"]


@query(
    "cross_join_grid",
    """select c_mktsegment as use_case, size, serverless, count(*) as customers
    from customer, (values ('small', []), ('medium', ['BUILDING']), ('large', ['BUILDING', 'MACHINERY'])) s(size, excluded),
        (values (0), (1)) f(serverless)
    where not list_contains(excluded, c_mktsegment) group by 1, 2, 3""",
)
def cross_join_grid(spark, d):
    cases = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("use_case")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return reports.benchmark_grid(
        cases, {"size": SIZES, "serverless": [0, 1]},
        {"medium": ["BUILDING"], "large": ["BUILDING", "MACHINERY"]}, "size",
    ).select("use_case", "size", "serverless", "customers")


@query(
    "cross_join_scalars",
    """select * from (select max(event_id) as last_version from events),
        (select max(event_id) as first_valid from events where event_type = 'signup')""",
)
def cross_join_scalars(spark, d):
    # Two scalars of one table are one aggregation, not a join.
    return table(spark, d, "events").agg(
        F.max("event_id").alias("last_version"),
        F.max(F.when(F.col("event_type") == "signup", F.col("event_id"))).alias("first_valid"),
    )


TODO = """
    select c_custkey as id, 12 as nr_of_runs, 12 - coalesce(runs, 0) as nr_runs_to_go
    from customer left join (select o_custkey, count(*) as runs from orders where o_orderstatus = 'F' group by 1)
        on c_custkey = o_custkey
    where coalesce(runs, 0) < 12
"""


@query("left_join_counts", TODO)
def left_join_counts(spark, d):
    planned = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit(12).alias("nr_of_runs"))
    done = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return joins.left_join_counts(planned, done, "id", "o_custkey")


@query("benchmark_todo", TODO)
def benchmark_todo(spark, d):
    planned = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit(12).alias("nr_of_runs"))
    log = table(spark, d, "orders").select(
        F.col("o_custkey").alias("benchmark_run_config_id"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
    )
    return reports.benchmark_todo(planned, log)


@query(
    "self_join_merge",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem t
    where not exists (select 1 from lineitem d where d.l_returnflag = 'R'
        and d.l_orderkey = t.l_orderkey and d.l_linenumber = t.l_linenumber)""",
)
def self_join_merge(spark, d):
    lines = table(spark, d, "lineitem")
    return joins.anti_join(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"),
        lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber").distinct(),
        ["l_orderkey", "l_linenumber"],
    )


AFFECTED = f"""with lines as ({LATEST_LINES}), affected as (
        select o_orderkey as k from orders where o_orderdate >= timestamp '1998-06-01'
        union select l_orderkey from lines where l_shipdate >= timestamp '1998-06-01')
    select o_orderkey, o_orderdate, l_linenumber, l_shipdate from orders
    left join lines on o_orderkey = l_orderkey where o_orderkey in (select k from affected)"""


def header_and_detail(spark, d):
    header = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    detail = stored_lines(spark, d).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    late = [header.where("o_orderdate >= timestamp_ntz'1998-06-01'"), detail.where("l_shipdate >= timestamp_ntz'1998-06-01'")]
    return header, detail, late


@query("affected_key_join", AFFECTED)
def affected_key_join(spark, d):
    header, detail, late = header_and_detail(spark, d)
    return harmonize.affected_key_join(header, [(detail, ["o_orderkey"])], ["o_orderkey"], late)


@query("affected_key_join_buckets", AFFECTED)
def affected_key_join_buckets(spark, d):
    """Both sides are stored in buckets of the order; only those of changed orders are read."""
    header, detail, late = header_and_detail(spark, d)
    headers = SnapshotTable(spark, shared_dir(spark, "headers"), ["o_orderkey"], buckets=32)
    details = SnapshotTable(spark, shared_dir(spark, "details"), ["o_orderkey", "l_linenumber"], buckets=32, bucket_by=["o_orderkey"])
    headers.merge(header)
    details.merge(detail)
    return harmonize.affected_key_join(headers, [(details, ["o_orderkey"])], ["o_orderkey"], late)


@query(
    "order_rollup",
    """select 'O' || l_orderkey as order_nr, o_orderdate as ordered_at, 'C' || o_custkey as customer_number,
        o_orderpriority as payment_method, count(*) as OrderDistinctProductCount,
        cast(sum(cast(l_quantity as bigint)) as bigint) as OrderTotalAmount,
        cast(sum(cast(l_extendedprice as decimal(18,2)) * cast(l_quantity as bigint)) as double) as OrderTotalPayableAmount,
        cast(sum(cast(l_discount as decimal(18,2)) * cast(l_quantity as bigint)) as double) as OrderTotalPayableAmountWithoutVAT
    from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3, 4""",
)
def order_rollup(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("ordered_at"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_number"), F.col("o_orderpriority").alias("payment_method"),
    )
    priced = table(spark, d, "lineitem").join(orders, ["l_orderkey"]).select(
        F.concat(F.lit("O"), "l_orderkey").alias("order_nr"), "ordered_at", "customer_number", "payment_method",
        F.col("l_partkey").alias("product_nr"), F.col("l_quantity").cast("bigint").alias("amount"),
        money("l_extendedprice").alias("price"), money("l_discount").alias("priceWithoutVAT"),
    )
    rolled = sales.order_rollup(priced)
    amounts = ("OrderTotalPayableAmount", "OrderTotalPayableAmountWithoutVAT")
    return rolled.withColumns({c: name(c).cast("double") for c in amounts})


@query(
    "group_count",
    """select year(day) as year, count(*) as nr_of_rows from (
        select unnest(generate_series(make_date(a, 1, 1), make_date(b, 12, 31), interval 1 day)) as day
        from (select year(min(o_orderdate)) as a, year(max(o_orderdate)) as b from orders)) group by 1""",
)
def group_count(spark, d):
    days = date_dimension_of(table(spark, d, "orders"), "o_orderdate")
    return days.groupBy("year").agg(F.count(F.lit(1)).alias("nr_of_rows"))


@query(
    "minmax_distinct",
    """select min(o_orderdate) as min_date, max(o_orderdate) as max_date, count(distinct year(o_orderdate)) as nr_of_years,
        count(distinct o_custkey) as nr_of_customers from orders""",
)
def minmax_distinct(spark, d):
    return table(spark, d, "orders").agg(
        F.min("o_orderdate").alias("min_date"), F.max("o_orderdate").alias("max_date"),
        F.countDistinct(F.year("o_orderdate")).alias("nr_of_years"), F.countDistinct("o_custkey").alias("nr_of_customers"),
    )


def whole_seconds(column):
    """Amounts as whole cents, so that sums and averages are exact in any order."""
    return F.round(name(column) * 100).cast("bigint")


@query(
    "run_stats",
    """select event_type, date_trunc('day', ts) as day, max(value) as max_exec_min, min(value) as min_exec_min,
        round(cast(sum(cast(round(value * 100) as bigint)) as double) / count(*), 6) as avg_exec_min, count(*) as n_exec
    from events group by 1, 2""",
)
def run_stats(spark, d):
    events = table(spark, d, "events").withColumn("cents", whole_seconds("value"))
    by = ["event_type", F.date_trunc("day", "ts").alias("day")]
    stats = reports.run_stats(events, by, F.col("cents"))
    return stats.withColumns(
        {
            "max_exec_min": F.col("max_exec_min") / 100, "min_exec_min": F.col("min_exec_min") / 100,
            "avg_exec_min": F.round("avg_exec_min", 6),
        }
    )


@query(
    "run_report",
    """with runs as (
        select o_orderkey, o_custkey as invocation_id, o_orderstatus as name, cast(floor(o_totalprice) as bigint) as seconds
        from orders where o_orderpriority <> '5-LOW'),
    invocations as (
        select c_custkey as invocation_id, 'Test performance. ' || c_mktsegment || ' 2nd run. ' || c_name as vars
        from customer where c_acctbal >= 0)
    select substr(vars, instr(substr(vars, 4), 'run') + 3 - 4, 7) as run_type, name,
        max(seconds / 60) as max_exec_min, min(seconds / 60) as min_exec_min,
        round(cast(sum(seconds) as double) / count(*) / 60, 6) as avg_exec_min, count(*) as n_exec
    from runs join invocations using (invocation_id) group by 1, 2""",
)
def run_report(spark, d):
    runs = table(spark, d, "orders").select(
        F.col("o_custkey").alias("invocation_id"), F.col("o_orderstatus").alias("name"),
        F.col("o_totalprice").cast("bigint").alias("execution_time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "error").otherwise("success").alias("status"),
    )
    started = F.when(F.col("c_acctbal") >= 0, "Test performance. ").otherwise("Other. ")
    invocations = table(spark, d, "customer").select(
        F.col("c_custkey").alias("invocation_id"),
        F.concat(started, "c_mktsegment", F.lit(" 2nd run. "), "c_name").alias("invocation_vars"),
    )
    return reports.run_report(runs, invocations).withColumn("avg_exec_min", F.round("avg_exec_min", 6))


@query(
    "avg_success",
    """select o_custkey, o_orderpriority, round(cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / count(*), 4)
        as avg_duration, count(*) as nr_of_runs from orders where o_orderstatus = 'F' group by 1, 2""",
)
def avg_success(spark, d):
    orders = table(spark, d, "orders").withColumn("cents", whole_seconds("o_totalprice"))
    done = reports.avg_success(orders, ["o_custkey", "o_orderpriority"], "cents", "o_orderstatus", "F")
    return done.withColumn("avg_duration", F.round("avg_duration", 4))


PIVOTED = ("click", "view", "purchase", "signup", "error")


@query(
    "conditional_pivot",
    "select date_trunc('day', ts) as day, "
    + ", ".join(
        f"round(cast(sum(cast(round(value * 100) as bigint)) filter (event_type = '{t}') as double)"
        f" / count(*) filter (event_type = '{t}'), 6) as avg_{t}"
        for t in PIVOTED
    )
    + " from events group by 1",
)
def conditional_pivot(spark, d):
    events = table(spark, d, "events").select(
        F.date_trunc("day", "ts").alias("day"), "event_type", whole_seconds("value").alias("cents")
    )
    wide = reports.conditional_pivot(events, ["day"], "event_type", "cents", {t: f"avg_{t}" for t in PIVOTED})
    return wide.withColumns({f"avg_{t}": F.round(f"avg_{t}", 6) for t in PIVOTED})


@query(
    "collect_label",
    """select c_nationkey, string_agg(distinct c_mktsegment, ' / ' order by c_mktsegment) as label
    from customer group by 1""",
)
def collect_label(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey").agg(
        reports.collect_label(F.col("c_mktsegment")).alias("label")
    )


@query("global_max", "select max(ts) as last_ts, max(event_id) as last_version from events")
def global_max(spark, d):
    return table(spark, d, "events").agg(F.max("ts").alias("last_ts"), F.max("event_id").alias("last_version"))


@query(
    "max_business_key",
    "select coalesce(max(cast(substr(c_name, 10) as bigint)), 0) as max_business_key from customer",
)
def max_business_key(spark, d):
    return sales.max_business_key(table(spark, d, "customer"), "c_name", leading=9)


BENCHMARK = """
    with cases as (
        select c_custkey as id, 'case_' || c_nationkey as use_case from customer),
    configs as (
        select p_partkey as id, p_size as use_case_id, case when p_size > 25 then 'DLT' else 'DBT' end as run_type,
            p_size > 40 as photon, p_size < 10 as serverless, p_size as workers,
            case when p_size < 15 then 'Small' else 'Large' end as size from part),
    log as (
        select l_partkey as config_id, cast(l_quantity as bigint) as duration from lineitem where l_returnflag <> 'R'),
    averages as (
        select use_case, configs.id as config_id, run_type, photon, serverless, workers, size,
            cast(sum(duration) as double) / count(*) as avg_duration
        from log join configs on config_id = configs.id join cases on use_case_id = cases.id group by all)
    select use_case,
        case when run_type = 'DLT' then (workers + 1) * case when photon then 5 else 1 end
            when size = 'Small' then 12 else 40 end as dbu,
        string_agg(distinct case when run_type = 'DLT' then workers || ' worker(s)' ||
            case when photon then ' (photon)' else ' (no photon)' end else lower(size) end, ' / '
            order by case when run_type = 'DLT' then workers || ' worker(s)' ||
            case when photon then ' (photon)' else ' (no photon)' end else lower(size) end) as config,
        round(avg(avg_duration) filter (run_type = 'DBT' and not serverless), 6) as dbt_server_based,
        round(avg(avg_duration) filter (run_type = 'DBT' and serverless), 6) as dbt_serverless,
        round(avg(avg_duration) filter (run_type = 'DLT' and not photon), 6) as dlt_no_photon,
        round(avg(avg_duration) filter (run_type = 'DLT' and photon), 6) as dlt_photon
    from averages group by 1, 2
"""


@query("benchmark_report", BENCHMARK)
def benchmark_report(spark, d):
    cases = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("case_"), "c_nationkey").alias("use_case")
    )
    size = F.col("p_size")
    configs = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), size.cast("bigint").alias("use_case_id"),
        F.when(size > 25, "DLT").otherwise("DBT").alias("run_type"),
        (size > 40).alias("dlt_photon"), (size < 10).alias("dbt_sql_serverless"), size.alias("dlt_nr_of_workers"),
        F.when(size < 15, "Small").otherwise("Large").alias("dbt_sql_cluster_size"),
    )
    log = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("benchmark_run_config_id"), F.col("l_shipdate").alias("start_time"),
        F.col("l_shipdate").alias("end_time"), F.col("l_quantity").cast("int").alias("duration"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("status"),
    )
    report = reports.benchmark_report(cases, configs, log)
    columns = ("dbt_server_based", "dbt_serverless", "dlt_no_photon", "dlt_photon")
    return report.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "benchmark_grid",
    """with existing as (select o_custkey, o_orderpriority from orders)
    select c_custkey as use_case_id, c_mktsegment as use_case, size, 'DBT' as run_type, 5 as nr_of_runs
    from customer, (values ('1-URGENT', []), ('2-HIGH', []), ('3-MEDIUM', ['BUILDING'])) s(size, excluded)
    where not list_contains(excluded, c_mktsegment)
        and not exists (select 1 from existing where o_custkey = c_custkey and o_orderpriority = size)""",
)
def benchmark_grid(spark, d):
    cases = table(spark, d, "customer").select(
        F.col("c_custkey").alias("use_case_id"), F.col("c_mktsegment").alias("use_case")
    )
    existing = table(spark, d, "orders").select(
        F.col("o_custkey").alias("use_case_id"), F.col("o_orderpriority").alias("size")
    )
    return reports.benchmark_grid(
        cases, {"size": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}, {"3-MEDIUM": ["BUILDING"]}, "size",
        constants={"run_type": "DBT", "nr_of_runs": 5}, existing=existing, keys=["use_case_id", "size"],
    )
