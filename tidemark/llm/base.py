"""Registration of queries and small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def query(key: str, sql: str | None = None):
    """Register a query; ``sql`` is what another engine runs on the same tables."""

    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null becomes ''."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def text_key(text: Column) -> Column:
    """128 bits of hashes that stand for a text; null and '' have different ones."""
    return F.struct(F.xxhash64(text, text.isNull()).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def either(patterns: Sequence[str]) -> str:
    return "(?:" + "|".join(patterns) + ")"


class Scratch:
    """Stored tables in a folder of their own, which are deleted together when nothing reads
    them any more."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.number = spark, shared_dir(spark, purpose), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.number}"
        self.number += 1
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def delete(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


# Bytes of rows that go to a Python worker at once. They are held several times over: on both
# sides of the pipe, as Arrow columns and as Python values.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand whole texts to Python ``BATCH_BYTES`` at a time (a longer text by
    itself), where it would be 10,000 of them or 64 MB. The session's setting comes back after."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    What follows starts from files that every executor can reach, so a lost executor costs a
    few tasks and nothing above ``df`` runs twice.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
