"""Neighbour values, running values and positions in an order, safe against hot keys.

A plain window puts all rows of a key into one task. Keys with more rows than a task can sort
are found first, by a count that is combined in the map tasks. If there are none, the plan is
the plain window. Otherwise the rows of the hot keys are dealt out by range of the whole order
and stored, each with the number of its range: its slice. Windows then run per (key, slice),
and what a slice needs from its neighbours comes from one summary row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import name, names
from tidemark.operators.skew import HOT_ROWS, ROWS, hot_keys, match, row_hash, rows_besides, rows_of
from tidemark.session import stored

SLICE = "__slice"
# No slice is planned smaller than this: with tiny limits, as in tests, a task per few rows
# would cost more to start than to run.
LEAST_SLICE = 1000
# So many slices are planned at most, as long as none then holds more rows than a task sorts
# well. Every slice costs sampled rows on the driver, a task and a file.
MOST_SLICES = 400


class KeyedOrder:
    """The order of rows within ``keys`` and the slices of hot keys.

    A slice holds about ``hot_rows`` rows; where that made more than MOST_SLICES slices, as many
    more as keep to that number, up to HOT_ROWS. Rows that share all ``order`` values are split as
    well, by a hash of the row; only rows that are the same in every column stay together.
    ``df`` is counted when the object is made. Without ``keys`` the whole table is one key and
    always sliced. ``hot_rows=None`` takes it for granted that no key is hot.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot_rows: int | None = HOT_ROWS,
        descending: bool = False,
    ):
        self.keys, self.order, self.descending = list(keys), list(order), descending
        self.hot = hot_keys(df, self.keys, hot_rows) if self.keys else None
        self.slices = None
        if self.hot is not None:
            rows = self.hot.agg(F.sum(ROWS)).first()[0]
            size = max(hot_rows, LEAST_SLICE, min(HOT_ROWS, -(-rows // MOST_SLICES)))
            self.slices = -(-rows // size) + 1
        self.sliced_at_all = self.hot is not None or (not self.keys and hot_rows is not None)

    def sliced(self, df: DataFrame) -> DataFrame:
        """``df`` with its slice number: null for ordinary keys, rising with the order for
        hot ones. Unchanged when there are no hot keys."""
        if not self.sliced_at_all:
            return df
        heavy = df if self.hot is None else rows_of(df, self.hot, self.keys)
        by = [*names(self.keys), *[name(c) for c in self.order], row_hash(df)]
        dealt = heavy.repartitionByRange(*by) if self.slices is None else heavy.repartitionByRange(self.slices, *by)
        number = F.spark_partition_id() if not self.descending else -F.spark_partition_id()
        heavy = stored(dealt.withColumn(SLICE, number), "slices")
        if self.hot is None:
            return heavy
        ordinary = rows_besides(df, self.hot, self.keys).withColumn(SLICE, F.lit(None).cast("int"))
        return ordinary.unionByName(heavy)

    def plain(self, df: DataFrame) -> DataFrame:
        return df.drop(SLICE)

    def previous(self, sliced: DataFrame, value: str, out: str) -> DataFrame:
        """``lag(value)`` per key."""
        return self._neighbour(sliced, value, out, F.lag, F.max_by)

    def next(self, sliced: DataFrame, value: str, out: str) -> DataFrame:
        """``lead(value)`` per key."""
        return self._neighbour(sliced, value, out, F.lead, F.min_by)

    def latest(self, sliced: DataFrame, value: str, out: str) -> DataFrame:
        """Last non-null ``value`` up to and including the row."""
        w = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = sliced.withColumn(out, F.last(name(value), ignorenulls=True).over(w))
        if not self.sliced_at_all:
            return local
        where = F.when(name(value).isNotNull(), _position(self.order))
        ends = self._per_slice(sliced, F.max_by(name(value), where).alias("__end"))
        before = self._slices().rowsBetween(Window.unboundedPreceding, -1)
        carried = self._summary(ends, F.last("__end", ignorenulls=True).over(before).alias("__carried"))
        joined = match(local, carried, [*self.keys, SLICE], "left")
        return joined.withColumn(out, F.coalesce(name(out), F.col("__carried"))).drop("__carried")

    def number(self, sliced: DataFrame, out: str) -> DataFrame:
        """``row_number()`` per key, from 1 and without gaps."""
        local = sliced.withColumn(out, F.row_number().over(self._window()).cast("long"))
        if not self.sliced_at_all:
            return local
        sizes = self._per_slice(sliced, F.count(F.lit(1)).alias("__size"))
        before = self._slices().rowsBetween(Window.unboundedPreceding, -1)
        offsets = self._summary(sizes, F.sum("__size").over(before).alias("__offset"))
        joined = match(local, offsets, [*self.keys, SLICE], "left")
        return joined.withColumn(out, name(out) + F.coalesce("__offset", F.lit(0))).drop("__offset")

    def _neighbour(self, sliced, value, out, step, edge):
        w = self._window()
        local = sliced.withColumn(out, step(name(value), 1).over(w))
        if not self.sliced_at_all:
            return local
        local = local.withColumn("__inside", step(F.lit(True), 1, False).over(w))
        edges = self._per_slice(sliced, edge(name(value), _position(self.order)).alias("__edge"))
        reached = self._summary(edges, step(F.col("__edge"), 1).over(self._slices()).alias("__reached"))
        joined = match(local, reached, [*self.keys, SLICE], "left")
        return joined.withColumn(
            out, F.when(F.col("__inside"), name(out)).otherwise(F.col("__reached"))
        ).drop("__inside", "__reached")

    def _window(self):
        by = [*names(self.keys), F.col(SLICE)] if self.sliced_at_all else names(self.keys)
        return Window.partitionBy(*by).orderBy(
            *[name(c).desc() if self.descending else name(c).asc() for c in self.order]
        )

    def _slices(self):
        return Window.partitionBy(*names(self.keys)).orderBy(SLICE)

    def _per_slice(self, sliced, measure):
        return sliced.where(F.col(SLICE).isNotNull()).groupBy(*names(self.keys), F.col(SLICE)).agg(measure)

    def _summary(self, per_slice, measure):
        return per_slice.select(*names(self.keys), F.col(SLICE), measure)


def _position(order):
    # A struct is never null, so rows with null order values take part, as the smallest.
    return F.struct(*[name(c).alias(f"o{i}") for i, c in enumerate(order)])
