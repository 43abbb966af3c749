"""Registration of queries, and frames that several queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import dedup_latest
from tidemark.session import shared_dir
from tidemark.sources.tables import read_df, scan_table, write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query; ``sql`` is what another engine runs on the same tables."""

    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return scan_table(spark, name, directory)


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def latest_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Line items with one row per order and line number."""
    return dedup_latest(table(spark, directory, "lineitem"), LINE_KEYS, LINE_ORDER)


def stored_lines(spark: SparkSession, directory: str) -> DataFrame:
    """The same as a table of its own, as a layer would store it for the layers above."""
    path = shared_dir(spark, "lines")
    write_table(latest_lines(spark, directory), path)
    return read_df(spark, path)


LATEST_LINES = f"""
    select * from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in LINE_ORDER)}) = 1
"""


def event_feed(spark: SparkSession, directory: str) -> DataFrame:
    """Events read as a change feed of users, one version per day."""
    events = table(spark, directory, "events")
    kind = (
        F.when(F.col("event_type") == "signup", "insert")
        .when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "view", "update_preimage")
        .otherwise("update_postimage")
    )
    return events.select(
        "event_id", "user_id", "ts", "value",
        kind.alias("_change_type"),
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long").alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"),
    )


EVENT_FEED = """
    select event_id, user_id, ts, value,
        case event_type when 'signup' then 'insert' when 'error' then 'delete'
            when 'view' then 'update_preimage' else 'update_postimage' end as _change_type,
        date_diff('day', date '2024-01-01', cast(ts as date)) as _commit_version,
        ts as _commit_timestamp
    from events
"""


def money(column) -> F.Column:
    """Exact sum base for amounts with two decimals."""
    return F.col(column).cast("decimal(18,2)") if isinstance(column, str) else column.cast("decimal(18,2)")
