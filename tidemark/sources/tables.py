"""Scans and writers for tables, files and landing folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import anti_join, insert_select_where_new
from tidemark.sources.landing import BATCH, FILE_PATH, LandingLedger


@dataclass(frozen=True)
class Dataset:
    """A registered raw table: where it is, its unique key and what orders its versions."""

    name: str
    path: str
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()


def scan_table(spark: SparkSession, table: str | Dataset, directory: str | None = None) -> DataFrame:
    """A registered dataset, a Parquet file of a directory, or a catalog table."""
    if isinstance(table, Dataset):
        return spark.read.parquet(table.path)
    if directory is not None:
        return spark.read.parquet(f"{directory.rstrip('/')}/{table}.parquet")
    return spark.table(table)


def scan_json_landing(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON files of a folder with the path of the file each row came from.

    Pass a ``schema`` on large folders: without one Spark reads all files twice.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("file_path"))


def scan_json_new_files(
    spark: SparkSession,
    path: str,
    loaded: DataFrame | LandingLedger | None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Landing rows of files that were not loaded before.

    With a table of rows that carry their ``file_path``, files it has no row of are new; all
    files are read to tell. With a :class:`LandingLedger` only new files are opened; confirm
    there what has been loaded.
    """
    if isinstance(loaded, LandingLedger):
        loaded.discover()
        return loaded.pending().drop(BATCH)
    landing = scan_json_landing(spark, path, schema)
    return landing if loaded is None else anti_join(landing, loaded, [FILE_PATH])


def scan_csv_seed(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column a string; a UTF-8 byte-order mark is dropped."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_table(df: DataFrame, path: str) -> None:
    """Full replace."""
    df.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_df(df: DataFrame, path: str, mode: str) -> None:
    """Overwrite or append; files may have different columns, see :func:`read_df`."""
    df.write.mode(mode.lower()).option("mergeSchema", "true").parquet(path)


def read_df(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all files, whenever they were added."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """One folder per partition value.

    Rows are brought together by partition value first, or every task would write a file
    into every folder; adaptive execution splits the large ones again.
    """
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_external(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """Catalog table whose files live at ``path``."""
    df.write.mode(mode).option("path", path).format("parquet").saveAsTable(table)


def publish_view(df: DataFrame, view: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df.sparkSession.table(view)


def write_where_new(spark: SparkSession, candidates: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the candidates whose key the table at ``path`` does not hold yet."""
    write_append(insert_select_where_new(spark.read.parquet(path), candidates, keys), path)
