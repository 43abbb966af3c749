"""Data-quality checks and anomaly monitors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import name, names
from tidemark.operators.ordered import KeyedOrder
from tidemark.session import stored

DIRECTIONS = ("both", "spike", "drop")


def test_valid_range(df: DataFrame, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Rows whose validity ends before it starts; no rows means the check passes."""
    return df.where(name(valid_from) > name(valid_to))


test_valid_range.__test__ = False  # a check for users, not a test case of this package


def schema_changes(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Added, removed and retyped columns between two ``(column, type)`` listings."""
    on = [*keys, "column"]
    old = before.select(*names(on), F.col("type").alias("old_type"))
    new = after.select(*names(on), F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "column_added")
        .when(F.col("new_type").isNull(), "column_removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    return old.join(new, on, "full").withColumn("change", change).where(F.col("change").isNotNull())


def schema_listing(df: DataFrame) -> DataFrame:
    """``(column, type)`` rows of a frame."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def volume_anomalies(
    df: DataFrame,
    timestamp: str,
    bucket: str = "day",
    days_back: int = 14,
    sensitivity: float = 3,
    direction: str = "both",
) -> DataFrame:
    """Rows per time bucket against the buckets before; buckets without rows count 0.

    Rows without a time come as one row without a bucket, which is anomalous.
    """
    counts = df.groupBy(F.date_trunc(bucket, name(timestamp)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    counts = stored(counts, "buckets")
    filled = _all_buckets(counts, bucket).withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    judged = _judged(filled, [], "row_count", days_back, sensitivity, direction)
    untimed = counts.where("bucket is null").withColumn("is_anomalous", F.lit(True))
    return judged.unionByName(untimed, allowMissingColumns=True)


def freshness_anomalies(
    df: DataFrame,
    timestamp: str,
    bucket: str = "day",
    days_back: int = 14,
    sensitivity: float = 3,
    direction: str = "spike",
) -> DataFrame:
    """Seconds from the latest row to the end of each bucket, against the buckets before.
    Rows without a time are in no bucket; ``volume_anomalies`` counts them."""
    latest = stored(
        df.groupBy(F.date_trunc(bucket, name(timestamp)).alias("bucket")).agg(F.max(name(timestamp)).alias("latest")),
        "buckets",
    )
    every = _all_buckets(latest, bucket)
    time = KeyedOrder(every, [], ["bucket"])
    known = time.plain(time.latest(time.sliced(every), "latest", "__known").withColumn("latest", F.col("__known")).drop("__known"))
    end = F.col("bucket") + F.expr(f"INTERVAL 1 {bucket}")
    delay = F.unix_micros(end.cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))
    return _judged(
        known.withColumn("delay_seconds", delay / F.lit(1_000_000)),
        [], "delay_seconds", days_back, sensitivity, direction,
    )


def column_anomalies(
    df: DataFrame,
    timestamp: str,
    columns: Sequence[str] | None = None,
    metrics: Sequence[str] = ("null_count", "null_percent", "missing_count"),
    bucket: str = "day",
    days_back: int = 14,
    sensitivity: float = 3,
    direction: str = "both",
    where: Column | None = None,
) -> DataFrame:
    """Null and missing values per column and bucket, against the buckets before.

    All columns are counted in one aggregation and only its few rows are unpivoted, so the
    table is read once and never multiplied.
    """
    rows = df if where is None else df.where(where)
    columns = [c for c in (columns or df.columns) if c != timestamp]
    measures = []
    for i, column in enumerate(columns):
        value = name(column)
        missing = value.isNull()
        if df.schema[column].dataType.typeName() == "string":
            missing = missing | F.lower(F.trim(value)).isin("", "null")
        measures += [
            F.count_if(value.isNull()).alias(f"nulls{i}"),
            F.count_if(missing).alias(f"missing{i}"),
        ]
    counted = rows.groupBy(F.date_trunc(bucket, name(timestamp)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *measures
    )
    forms = {
        "null_count": lambda i: F.col(f"nulls{i}").cast("double"),
        "null_percent": lambda i: F.col(f"nulls{i}") * F.lit(100.0) / F.col("n"),
        "missing_count": lambda i: F.col(f"missing{i}").cast("double"),
    }
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), forms[m](i).alias("metric_value"))
        for i, c in enumerate(columns)
        for m in metrics
    ]
    long = counted.select("bucket", F.explode(F.array(*cells)).alias("cell")).select("bucket", "cell.*")
    return _judged(long, ["column_name", "metric"], "metric_value", days_back, sensitivity, direction)


# Seconds of the buckets that are equally long; the others are counted in months.
LENGTHS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 7 * 86_400}
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _all_buckets(df: DataFrame, bucket: str) -> DataFrame:
    """Add the buckets between the first and the last that have no row. They are numbered
    in a range that Spark spreads over its tasks; only its two ends are looked up."""
    kind, unit = df.schema["bucket"].dataType, bucket.lower()
    if unit not in LENGTHS and unit not in MONTHS:
        raise ValueError(f"bucket must be one of {[*LENGTHS, *MONTHS]}")
    text = df.agg(F.min("bucket").cast("string").alias("a"), F.max("bucket").cast("string").alias("b")).first()
    if text["a"] is None:
        return df.where(F.lit(False))
    a, b = F.lit(text["a"]).cast(kind), F.lit(text["b"]).cast(kind)
    if unit in MONTHS:
        n = F.round(F.months_between(b, a) / MONTHS[unit])
        at = F.add_months(a, (F.col("id") * MONTHS[unit]).cast("int")).cast(kind)
    elif LENGTHS[unit] < 86_400:
        n = (F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))) / LENGTHS[unit]
        at = F.timestamp_seconds(F.unix_seconds(a.cast("timestamp")) + F.col("id") * LENGTHS[unit]).cast(kind)
    else:
        n = F.datediff(b, a) * 86_400 / LENGTHS[unit]
        at = F.date_add(a.cast("date"), (F.col("id") * (LENGTHS[unit] // 86_400)).cast("int")).cast(kind)
    spark = df.sparkSession
    last = spark.range(1).select(n.cast("long")).first()[0]
    return spark.range(last + 1).select(at.alias("bucket")).join(df, ["bucket"], "left")


def _judged(df, by, metric, days_back, sensitivity, direction):
    """Compare with mean and deviation of the buckets that began in the ``days_back`` days
    before, however many of them had rows.

    Works on one row per bucket and metric. Two earlier buckets are the least to judge by.
    Time is cut into slices as long as those days. What a bucket is compared with lies in its
    slice or the one before, so every bucket also goes, to be looked at only, to the slice
    behind its own, and no task sees more than two slices of one metric.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    seconds = F.unix_seconds(F.col("bucket").cast("timestamp"))
    length = max(days_back, 1) * 86_400
    w = Window.partitionBy(*names(by), "__slice").orderBy("__seconds").rangeBetween(-days_back * 86_400, -1)
    own = F.floor(seconds / length)
    df = df.where(F.col("bucket").isNotNull()).withColumn("__seconds", seconds).withColumn("__own", own)
    df = df.withColumn("__slice", F.explode(F.array(F.col("__own"), F.col("__own") + 1)))
    value, mean, deviation = name(metric), F.col("training_avg"), F.col("training_stddev")
    over = value > mean + F.lit(sensitivity) * deviation
    under = value < mean - F.lit(sensitivity) * deviation
    outside = {"both": over | under, "spike": over, "drop": under}[direction]
    return (
        df.withColumn("training_avg", F.avg(value).over(w))
        .withColumn("training_stddev", F.stddev_samp(value).over(w))
        .withColumn("is_anomalous", F.coalesce(outside, F.lit(False)))
        .where(F.col("__slice") == F.col("__own"))
        .drop("__seconds", "__own", "__slice")
    )
