"""Streams: landing folders, upserts per micro-batch, limited appends."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.keys import name
from tidemark.operators.history import dedup_latest
from tidemark.session import stored
from tidemark.sources.snapshots import SnapshotTable

# Partition column of tables that are appended to batch by batch.
APPENDED = "append_batch"


def scan_json_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Landing folder as a stream: each file is read once, with its path."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def scan_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_file_ingest(stream: DataFrame, path: str, checkpoint: str, processing_time: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row once; what is there, then stop,
    unless a ``processing_time`` keeps it running."""
    return _trigger(
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint),
        processing_time,
    ).start()


def stream_upsert(
    stream: DataFrame,
    table: SnapshotTable,
    order_by: Sequence[str],
    checkpoint: str,
    purge: str | None = None,
    processing_time: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    horizon: str | int | None = None,
) -> StreamingQuery:
    """Merge the latest row per key of each micro-batch into a table.

    Each merge carries the checkpoint and the batch number, so a batch that is replayed
    after a failure is recognised and not merged twice. A row older than the stored one
    loses.

    ``purge`` names a delete column. Without a ``horizon`` its rows leave the table at once,
    and an older row of the key that comes later brings it back. With a horizon (an interval,
    or a number where the first ``order_by`` column is one) they stay as tombstones, which
    :func:`live_rows` hides. The watermark is the latest time seen less the horizon; it is
    committed with the rows. What is older is too late to make a new key, so tombstones
    behind the watermark are dropped, when a merge next touches their bucket.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        latest = dedup_latest(rows, table.keys, order_by)
        token = f"{checkpoint}#{batch_id}"
        if horizon is None or purge is None:
            table.merge(latest, token, apply=lambda t, s: _newest(t, s, table.keys, order_by), purge=purge)
            return
        latest = stored(latest, "batch")
        time, kind = name(order_by[0]), latest.schema[order_by[0]].dataType
        before = F.lit(table.notes().get("watermark")).cast(kind)
        reach = F.expr(f"INTERVAL {horizon}") if isinstance(horizon, str) else F.lit(horizon)
        seen = latest.agg(F.greatest(before, (F.max(time) - reach).cast(kind)).cast("string")).first()[0]
        watermark = F.lit(seen).cast(kind)

        def apply(target: DataFrame, source: DataFrame) -> DataFrame:
            both = target.withColumn("__new", F.lit(0)).unionByName(source.withColumn("__new", F.lit(1)))
            order = F.struct(*[name(c).alias(f"o{i}") for i, c in enumerate(order_by)], F.col("__new").alias("new"))
            row = F.struct(*[name(c) for c in target.columns])
            newest = both.groupBy(*[name(k).alias(f"__k{i}") for i, k in enumerate(table.keys)]).agg(
                F.max_by(row, order).alias("row"), F.min("__new").alias("new")
            )
            late = (F.col("new") == 1) & F.coalesce(F.col("row")[order_by[0]] < before, F.lit(False))
            expired = F.col("row")[purge].isNotNull() & F.coalesce(F.col("row")[order_by[0]] < watermark, F.lit(False))
            return newest.where(~late & ~expired).select("row.*")

        table.merge(latest, token, apply=apply, notes={"watermark": seen})

    return _trigger(
        stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint), processing_time
    ).start()


def live_rows(table: SnapshotTable, purge: str) -> DataFrame:
    """A table that keeps tombstones, without them."""
    return table.read().where(name(purge).isNull())


def _newest(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return dedup_latest(target.unionByName(source, allowMissingColumns=True), keys, order_by)


class Limit:
    """Stop after a number of runs and/or seconds; ``None`` or 0 means no limit."""

    def __init__(self, runs: int | None = None, seconds: float | None = None):
        self.runs, self.seconds = runs or None, seconds or None
        self.done, self.started = 0, time.monotonic()

    def reached(self) -> bool:
        over_runs = self.runs is not None and self.done >= self.runs
        over_time = self.seconds is not None and time.monotonic() - self.started >= self.seconds
        return over_runs or over_time


def stream_microbatch_append(
    spark: SparkSession,
    make_rows: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    rows_per_batch: int,
    number_of_batches: int = 0,
    number_of_seconds: float = 0,
    partitions: int | None = None,
) -> int:
    """Append batch after batch until a limit is reached; returns the number of batches.

    ``make_rows`` turns running numbers (column ``value``, from 0, ``rows_per_batch`` of them
    in each batch) into rows, and must give the same rows for the same numbers. The numbers
    come from a stream whose checkpoint says which batches are in: a later call goes on
    behind the last one, and a batch that was lost half way is made again first, replaces what
    it had left, and is not counted. Each batch is one folder of the Parquet table at ``path``.
    """
    if not number_of_batches and not number_of_seconds:
        raise ValueError("set number_of_batches, number_of_seconds or both")
    numbers = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    stream = numbers.option("numPartitions", partitions or spark.sparkContext.defaultParallelism).load().select("value")

    def append(batch: DataFrame, batch_id: int) -> None:
        make_rows(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{APPENDED}={batch_id}")

    limit = Limit(number_of_batches, number_of_seconds)
    while not limit.reached():
        # The source has one batch available at a time.
        writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        limit.done += 1
    return limit.done


def stream_continuous_refresh(
    refresh: Callable[[int], None],
    finish_after_runs: int | None = None,
    finish_after_seconds: float | None = None,
) -> int:
    """Repeat an incremental refresh until a limit is reached; returns the number of runs.

    ``refresh`` is typically a stream started with everything available and awaited, so
    progress is kept in its checkpoint and a restart goes on where it stopped.
    """
    limit = Limit(finish_after_runs, finish_after_seconds)
    while not limit.reached():
        refresh(limit.done)
        limit.done += 1
    return limit.done


def _trigger(writer, processing_time):
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
