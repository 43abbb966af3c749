"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on: adaptive execution splits skewed join partitions,
# sizes shuffles and drops branches that turn out empty.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}


def sized_for(input_bytes: int) -> dict[str, str]:
    """Settings for a job that reads and shuffles about so many bytes.

    Adaptive execution merges small shuffle partitions but never makes more of them, so the
    number to start from has to fit the input: half a gigabyte each.
    """
    start = max(input_bytes // (512 << 20), 200)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(start),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "512m" if input_bytes > 1 << 40 else "128m",
    }


def configure(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    settings = RECOMMENDED | (sized_for(input_bytes) if input_bytes else {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach, below ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: what follows does not run it
    again, and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
