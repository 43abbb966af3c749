"""Streams run to the end over whole tables."""

from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.registry.base import query, table
from tidemark.session import shared_dir
from tidemark.sources import tables as io
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming import ingest


def event_stream(spark, d, max_files=None):
    schema = table(spark, d, "events").schema
    return ingest.scan_parquet_stream(spark, f"{d}/events*.parquet", schema, max_files)


@query("scan_json_stream", "select event_id, ts, user_id, event_type, value, props, true as has_path from events")
def scan_json_stream(spark, d):
    folder, target = shared_dir(spark, "landing"), shared_dir(spark, "stream")
    table(spark, d, "events").write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(folder)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    stream = ingest.scan_json_stream(spark, folder, schema, max_files=4)
    ingest.stream_file_ingest(stream, target, shared_dir(spark, "progress")).awaitTermination()
    return io.read_df(spark, target).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", F.col("file_path").endswith(".json").alias("has_path")
    )


@query("stream_file_ingest", "select event_id, user_id, event_type, ts, value, props from events")
def stream_file_ingest(spark, d):
    target = shared_dir(spark, "stream")
    ingest.stream_file_ingest(event_stream(spark, d), target, shared_dir(spark, "progress")).awaitTermination()
    return io.read_df(spark, target)


LATEST = """
    select user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc) = 1
"""
KEYS = ["user_id", "event_type"]


def day_files(spark, d):
    """Events as several files, in no particular order of time."""
    folder = shared_dir(spark, "landing")
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    events.repartition(3, "event_type").write.parquet(folder)
    return folder, events.schema


@query("stream_upsert", LATEST)
def stream_upsert(spark, d):
    folder, schema = day_files(spark, d)
    target = SnapshotTable(spark, shared_dir(spark, "latest"), KEYS, buckets=8)
    stream = ingest.scan_parquet_stream(spark, folder, schema, max_files=1)
    ingest.stream_upsert(stream, target, ["ts"], shared_dir(spark, "progress")).awaitTermination()
    return target.read()


@query("stream_continuous_refresh", LATEST)
def stream_continuous_refresh(spark, d):
    """Two refreshes; the second finds the files that came after the first."""
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    folder, progress = shared_dir(spark, "landing"), shared_dir(spark, "progress")
    target = SnapshotTable(spark, shared_dir(spark, "latest"), KEYS, buckets=8)
    arrivals = ["event_type in ('view', 'click')", "event_type not in ('view', 'click')"]

    def refresh(run):
        events.where(arrivals[run]).write.mode("append").parquet(folder)
        stream = ingest.scan_parquet_stream(spark, folder, events.schema)
        ingest.stream_upsert(stream, target, ["ts"], progress).awaitTermination()

    ingest.stream_continuous_refresh(refresh, finish_after_runs=len(arrivals))
    return target.read()


@query(
    "stream_upsert_deletes",
    """select user_id, event_type, ts, value from events
    qualify row_number() over (partition by user_id order by ts desc) = 1 and event_type is distinct from 'error'""",
)
def stream_upsert_deletes(spark, d):
    """Errors delete their user. The newest third of the events arrives first, the oldest
    last: what comes late stays deleted."""
    events = table(spark, d, "events").select("user_id", "event_type", "ts", "value")
    rows = events.withColumn("deleted", F.when(F.col("event_type") == "error", "D"))
    folder = shared_dir(spark, "landing")
    ends = events.agg(F.expr("approx_percentile(ts, array(0.33, 0.66))").alias("t")).first()["t"]
    early, middle = [F.coalesce(F.col("ts") < F.lit(t), F.lit(True)) for t in ends or [None, None]]
    for part in (~middle, middle & ~early, early):
        rows.where(part).coalesce(1).write.mode("append").parquet(folder)
    target = SnapshotTable(spark, shared_dir(spark, "users"), ["user_id"], buckets=8)
    stream = ingest.scan_parquet_stream(spark, folder, rows.schema, max_files=1)
    progress = shared_dir(spark, "progress")
    ingest.stream_upsert(stream, target, ["ts"], progress, "deleted", horizon="3650 days").awaitTermination()
    return ingest.live_rows(target, "deleted").drop("deleted")


@query(
    "stream_microbatch_append",
    "select 'O' || o_orderkey as order_nr, o_orderstatus, o_totalprice from orders",
)
def stream_microbatch_append(spark, d):
    """Batch numbers meet the orders that hash to them; all orders are in after all batches,
    although the stream stops and goes on in between."""
    batches = 6
    orders = table(spark, d, "orders").select(
        F.concat(F.lit("O"), "o_orderkey").alias("order_nr"), "o_orderstatus", "o_totalprice",
        F.pmod(F.xxhash64("o_orderkey"), F.lit(batches)).alias("value"),
    )
    target, progress = shared_dir(spark, "orders"), shared_dir(spark, "progress")
    for some in (2, batches - 2):
        ingest.stream_microbatch_append(
            spark, lambda numbers: orders.join(numbers, "value").drop("value"), target, progress,
            rows_per_batch=1, number_of_batches=some, partitions=1,
        )
    return io.read_df(spark, target).drop(ingest.APPENDED)


@query("stream_scd2", "select user_id, count(*) as versions, count(*) filter (next_ts is null) as current_versions from ("
    "select *, lead(ts) over (partition by user_id order by ts) as next_ts from ("
    "select *, lag(event_type) over (partition by user_id order by ts) as previous from events)"
    " where previous is distinct from event_type) group by 1")
def stream_scd2(spark, d):
    """Append-only ingest by stream, history as a view over it."""
    target = shared_dir(spark, "stream")
    ingest.stream_file_ingest(
        event_stream(spark, d).select("user_id", "event_type", "ts"), target, shared_dir(spark, "progress")
    ).awaitTermination()
    versions = history.scd2_history(io.read_df(spark, target), ["user_id"], "ts")
    return versions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("versions"), F.count_if(F.col("is_current")).alias("current_versions")
    )
