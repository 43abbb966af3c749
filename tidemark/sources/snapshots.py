"""Parquet tables that are merged into without touching what readers see.

Rows live in hash buckets of their key. A merge reads the buckets the increment touches,
writes those into a new folder next to the old ones, and then adds one row per bucket to a
small commit table. Readers follow the commit table, so a merge shows up whole or not at
all, and a job that is lost before the commit leaves nothing behind that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import key_bucket, name
from tidemark.operators import merge as merges
from tidemark.session import stored

BUCKET = "__bucket"
# What a merge does about columns that only the table or only the increment has.
IGNORE, FAIL, APPEND, SYNC = SCHEMA_CHANGES = ("ignore", "fail", "append_new_columns", "sync_all_columns")
COMMIT_SCHEMA = "version long, bucket int, folder string, operation string, operationParameters string"
STATE_SCHEMA = "source string, last_version long"
ALL_BUCKETS = -1


@dataclass(frozen=True)
class _Layout:
    """Columns of a commit. A column keeps its id when it is retyped; one that is dropped and
    added again is another column."""

    schema: T.StructType
    ids: dict[str, int]

    @classmethod
    def of(cls, parameters: dict) -> _Layout:
        schema = T.StructType.fromJson(parameters["schema"])
        return cls(schema, parameters.get("ids") or {f.name: i for i, f in enumerate(schema)})

    def changed_to(self, schema: T.StructType, next_id: int) -> _Layout:
        known = {n.lower(): i for n, i in self.ids.items()}
        ids = {}
        for f in schema:
            ids[f.name] = known.get(f.name.lower(), next_id)
            next_id = max(next_id, ids[f.name] + 1)
        return _Layout(schema, ids)

    def cast(self, df: DataFrame, to: _Layout) -> DataFrame:
        """Rows of this layout with the columns of another: by id, null where there was none."""
        mine = {i: n for n, i in self.ids.items()}
        return df.select(*[
            (name(mine[to.ids[f.name]]) if to.ids[f.name] in mine else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in to.schema
        ])


@dataclass(frozen=True)
class _Committed:
    """What the commit table says: latest version, its columns, bucket -> folder to read, and
    the columns of folders that were written before columns changed."""

    version: int
    layout: _Layout | None
    live: dict[int, str]
    done: bool
    next_id: int = 0
    notes: dict = field(default_factory=dict)
    earlier: dict[int, _Layout] = field(default_factory=dict)
    altered: bool = False

    def layout_of(self, folder: str) -> _Layout:
        return self.earlier.get(int(folder.split("-")[0]), self.layout)


class SnapshotTable:
    """A keyed table in ``buckets`` hash buckets below ``root``.

    Choose ``buckets`` so that one bucket is what a few tasks write in a minute; a merge
    rewrites whole buckets. The number is stored with the first commit and holds from then
    on, whatever a later caller asks for; other keys than the stored ones are refused. One
    writer at a time: a commit that meets another of the same version fails.

    ``bucket_by`` names the key columns that decide the bucket, all of them by default. Lines
    put into buckets by their document are read bucket by bucket when documents change.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64, bucket_by: Sequence[str] | None = None):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self.bucket_by = list(bucket_by or keys)
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError(f"buckets are made of key columns: {self.bucket_by}")

    def history(self) -> DataFrame:
        """Commits so far, one row per version."""
        return self._commits().where(F.col("bucket") == ALL_BUCKETS).select(
            "version", "operation", "operationParameters"
        )

    def version(self) -> int:
        """Latest committed version, -1 before the first."""
        return self._committed().version

    def exists(self) -> bool:
        return self.version() >= 0

    def read(self) -> DataFrame:
        committed = self._committed()
        if committed.layout is None:
            raise FileNotFoundError(f"nothing was committed to {self.root} yet")
        return self._read(committed, committed.live)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Rows of the buckets that the ``keys`` (a stored frame with the key columns) fall
        into: all rows of these keys, some others, and no file of the other buckets."""
        committed = self._committed()
        if committed.layout is None:
            raise FileNotFoundError(f"nothing was committed to {self.root} yet")
        return self._read(committed, self._touched(committed, keys))

    def notes(self) -> dict:
        """What merges noted: one value per name, the latest."""
        return self._committed().notes

    def loaded_version(self, source: str) -> int | None:
        """The version of ``source`` that the rows of this table stand for."""
        return self.notes().get("loaded", {}).get(source)

    def overwrite(self, df: DataFrame, token: str | None = None, loaded: dict[str, int] | None = None) -> int:
        """Replace all rows, whatever columns there were."""
        committed = self._committed(token)
        if committed.done:
            return committed.version
        notes = _noted(committed.notes, None, loaded)
        return self._commit(committed, df, range(self.buckets), token, "CREATE OR REPLACE TABLE AS SELECT", notes)

    def merge(
        self,
        source: DataFrame,
        token: str | None = None,
        apply: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        purge: str | None = None,
        schema_change: str = IGNORE,
        notes: dict | None = None,
        loaded: dict[str, int] | None = None,
    ) -> int:
        """Upsert ``source``; only buckets that hold one of its keys are read and written.

        ``apply(target, source)`` replaces the default upsert; it must leave other keys
        alone. ``purge`` names a delete column whose rows are removed afterwards. A
        ``token`` that was committed before is not merged again, so a repeated call with
        the same one changes nothing. Returns the version the table is at.

        ``schema_change`` says what becomes of columns that differ: ``ignore`` keeps the
        table's, ``fail`` raises, ``append_new_columns`` adds those of the increment,
        ``sync_all_columns`` takes over its columns and types. Files are not rewritten for
        that: each commit knows its columns, and older files are cast when they are read.

        ``notes`` and ``loaded`` (source -> version) are committed together with the rows, so
        a failure leaves both as they were or both as they should be.
        """
        if schema_change not in SCHEMA_CHANGES:
            raise ValueError(f"schema_change must be one of {SCHEMA_CHANGES}")
        committed = self._committed(token)
        if committed.done:
            return committed.version
        notes = _noted(committed.notes, notes, loaded)
        if committed.layout is None:
            rows = merges.reject_duplicate_keys(source, self.keys)
            rows = merges.delete_flagged(rows, purge) if purge else rows
            return self._commit(committed, rows, range(self.buckets), token, "CREATE TABLE AS SELECT", notes)
        layout = self._changed_layout(committed, source.schema, schema_change)
        fitted = _Layout(source.schema, {
            f.name: next((i for n, i in layout.ids.items() if n.lower() == f.name.lower()), -1 - k) for k, f in enumerate(source.schema)
        })
        # Stored first: what is written must be what the touched buckets were taken from.
        source = stored(fitted.cast(source, layout), "merge-source")
        live = self._touched(committed, source)
        target = committed.layout.cast(self._read(committed, live), layout)
        merged = apply(target, source) if apply else merges.upsert(target, source, self.keys)
        if purge:
            merged = merges.delete_flagged(merged, purge)
        return self._commit(committed, merged, self._buckets_of(source), token, "MERGE", notes, layout)

    def _changed_layout(self, committed: _Committed, schema: T.StructType, schema_change: str) -> _Layout:
        now = committed.layout
        known, given = ({f.name.lower(): f for f in x} for x in (now.schema, schema))
        if missing := [k for k in self.keys if k.lower() not in given]:
            raise ValueError(f"the increment lacks key columns: {missing}")
        if schema_change == FAIL and {n: f.dataType for n, f in known.items()} != {n: f.dataType for n, f in given.items()}:
            raise ValueError(f"columns differ from those of {self.root}")
        if schema_change == APPEND:
            schema = T.StructType([*now.schema, *[T.StructField(f.name, f.dataType) for n, f in given.items() if n not in known]])
        elif schema_change != SYNC:
            schema = now.schema
        return now.changed_to(schema, committed.next_id)

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        # At most ``buckets`` numbers reach the driver.
        return [r[0] for r in rows.select(key_bucket(self.bucket_by, self.buckets)).distinct().collect()]

    def _touched(self, committed: _Committed, rows: DataFrame) -> dict[int, str]:
        touched = set(self._buckets_of(rows))
        return {b: folder for b, folder in committed.live.items() if b in touched}

    def _commit(self, committed, df, touched, token, operation, notes=None, layout=None) -> int:
        version, touched = committed.version + 1, list(touched)
        if layout is None:  # all columns are new
            layout = _Layout(df.schema, {f.name: committed.next_id + i for i, f in enumerate(df.schema)})
        else:
            df = df.select(*[name(f.name).cast(f.dataType).alias(f.name) for f in layout.schema])
        # A folder of its own for every attempt: leftovers of a lost one are never read.
        folder = f"{version}-{uuid.uuid4().hex[:12]}"
        written: set[int] = set()
        if touched:
            rows = df.withColumn(BUCKET, key_bucket(self.bucket_by, self.buckets))
            rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
            found = self.spark.read.schema(rows.schema).parquet(f"{self.root}/data/{folder}")
            written = {r[0] for r in found.select(BUCKET).distinct().collect()}
            if not written <= set(touched):
                raise RuntimeError(f"rows of other buckets than those read were written: {sorted(written - set(touched))}")
        changed = committed.layout is not None and (layout.ids, layout.schema) != (committed.layout.ids, committed.layout.schema)
        parameters = json.dumps({
            "token": token, "schema": layout.schema.jsonValue(), "ids": layout.ids, "buckets": self.buckets, "keys": self.keys,
            "bucket_by": self.bucket_by,
            "next_id": max([committed.next_id - 1, *layout.ids.values()], default=-1) + 1, "notes": notes or {},
            "altered": operation == "MERGE" and (committed.altered or changed),
        })
        commits = [(version, ALL_BUCKETS, folder, operation, parameters)]
        commits += [(version, b, folder if b in written else None, None, None) for b in touched]
        (
            self.spark.createDataFrame(commits, COMMIT_SCHEMA)
            .coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        )
        heads = self._commits().where((F.col("version") == version) & (F.col("bucket") == ALL_BUCKETS)).count()
        if heads > 1:
            raise RuntimeError(f"another writer committed version {version} of {self.root} at the same time")
        return version

    def _commits(self) -> DataFrame:
        return _read_or_empty(self.spark, f"{self.root}/commits", COMMIT_SCHEMA)

    def _committed(self, token: str | None = None) -> _Committed:
        same_token = F.get_json_object("operationParameters", "$.token") == F.lit(token)
        latest = self._commits().groupBy("bucket").agg(
            F.max("version").alias("version"),
            F.max_by("folder", "version").alias("folder"),
            F.max_by("operationParameters", "version").alias("parameters"),
            F.coalesce(F.bool_or(same_token), F.lit(False)).alias("done"),
        )
        rows = {r["bucket"]: r for r in latest.collect()}  # one row per bucket
        head = rows.pop(ALL_BUCKETS, None)
        if head is None:
            return _Committed(-1, None, {}, False)
        parameters = json.loads(head["parameters"])
        layout = _Layout.of(parameters)
        self.buckets = parameters.get("buckets", self.buckets)
        if parameters.get("keys", self.keys) != self.keys:
            raise ValueError(f"{self.root} is keyed by {parameters['keys']}, not by {self.keys}")
        self.bucket_by = parameters.get("bucket_by", self.bucket_by)
        live = {b: r["folder"] for b, r in rows.items() if r["folder"]}
        altered, earlier = parameters.get("altered", False), {}
        if altered:  # one row per folder that is read, at most
            versions = sorted({int(f.split("-")[0]) for f in live.values()})
            heads = self._commits().where((F.col("bucket") == ALL_BUCKETS) & F.col("version").isin(versions))
            earlier = {r["version"]: _Layout.of(json.loads(r["operationParameters"])) for r in heads.collect()}
        next_id = parameters.get("next_id", len(layout.ids))
        return _Committed(head["version"], layout, live, head["done"], next_id, parameters.get("notes", {}), earlier, altered)

    def _read(self, committed: _Committed, live: dict[int, str]) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], committed.layout.schema)
        # Folders of the same columns are read together; there are as many reads as column sets.
        groups: list[tuple[_Layout, list[str]]] = []
        for b, folder in sorted(live.items()):
            layout = committed.layout_of(folder)
            paths = next((p for known, p in groups if known == layout), None)
            if paths is None:
                groups.append((layout, paths := []))
            paths.append(f"{self.root}/data/{folder}/{BUCKET}={b}")
        # The schema is known, so no file has to be opened to find it.
        reads = [(layout, self.spark.read.schema(layout.schema).parquet(*paths)) for layout, paths in groups]
        return reduce(DataFrame.unionByName, [df if layout == committed.layout else layout.cast(df, committed.layout) for layout, df in reads])


def _noted(before: dict, notes: dict | None, loaded: dict[str, int] | None) -> dict:
    after = {**before, **(notes or {})}
    if loaded:
        after["loaded"] = {**before.get("loaded", {}), **loaded}
    return after


def save_load_version(spark: SparkSession, path: str, source: str, version: int | None) -> None:
    """Remember what was loaded from a source. Call it after the target is written; a failure
    between the two repeats the load. ``SnapshotTable.merge(loaded=...)`` does both at once."""
    if version is not None:
        spark.createDataFrame([(source, version)], STATE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """One row per source with the version loaded last."""
    return (
        _read_or_empty(spark, path, STATE_SCHEMA).groupBy("source").agg(F.max("last_version").alias("last_version"))
    )


def last_loaded_version(spark: SparkSession, path: str, source: str) -> int | None:
    row = load_state(spark, path).where(F.col("source") == source).first()
    return None if row is None else row["last_version"]


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
