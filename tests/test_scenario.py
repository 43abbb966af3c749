"""Type-1, type-2 and joined tables through four steps of changes in their sources."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import changes, history, merge
from tidemark.operators.shape import union_soft_deletes
from tidemark.plans import harmonize

BASE = "id int, name string, email string, raw_insert_date timestamp"
CHILD = "id int, country string, raw_insert_date timestamp"
DELETED = "id int, operation string, raw_insert_date timestamp"
T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))


class Source:
    """A raw table with its change feed."""

    def __init__(self, spark, schema, order=("raw_insert_date",)):
        self.rows = spark.createDataFrame([], schema)
        self.feed, self.version = None, -1
        self.identity, self.order = ["id", *order], list(order)

    def set(self, df, at):
        self.version += 1
        feed = changes.change_feed(self.rows, df, self.identity, self.version, at)
        self.feed = feed if self.feed is None else self.feed.unionByName(feed)
        self.rows = df

    def read(self, loaded, keyed=True, **options):
        keys = ["id"] if keyed else None
        return changes.plan_increment(
            self.rows, self.feed, changes.SourceState(self.version), loaded, keys, self.order, **options
        )


@pytest.fixture
def world(spark):
    base, child = Source(spark, BASE), Source(spark, CHILD)
    base_del, child_del = Source(spark, DELETED), Source(spark, DELETED)
    base.set(spark.createDataFrame([(1, "Ana", "ana@x", T1), (2, "Maria", "maria@x", T1), (3, "John", "paul@x", T1), (4, "Sarah", "sarah@x", T1)], BASE), T1)
    child.set(spark.createDataFrame([(1, "NL", T1), (2, "IT", T1), (3, "NL", T1), (10, "BR", T1)], CHILD), T1)
    base_del.set(spark.createDataFrame([(2, "D", T1), (5, "D", T1)], DELETED), T1)
    child_del.set(spark.createDataFrame([(3, "D", T1), (6, "D", T1)], DELETED), T1)

    def step3():
        base.set(base.rows.union(spark.createDataFrame([(3, "John", "john@x", T2), (5, "Paul", "paul@x", T2)], BASE)), T2)
        child.set(child.rows.union(spark.createDataFrame([(4, "NL", T2)], CHILD)), T2)
        base_del.set(base_del.rows.union(spark.createDataFrame([(3, "D", T2)], DELETED)), T2)
        child_del.set(child_del.rows.union(spark.createDataFrame([(2, "D", T2)], DELETED)), T2)

    def step4():
        df = base.rows.union(spark.createDataFrame([(6, "Nina", "nina@x", T3)], BASE))
        df = merge.update_where(df, F.col("id") == 1, {"email": F.lit("ana.ana@x")})
        base.set(merge.delete_where(df, F.col("id") == 4), T3)

    return base, child, base_del, child_del, step3, step4


def emails(df):
    return rows(df.select("id", "email"))


def test_scd1(world):
    base, *_, step3, step4 = world
    target, loaded = base.read(None)
    target = merge.upsert(target.where("false"), target, ["id"])
    step3()
    rows_now, loaded = base.read(loaded)
    target = merge.upsert(target, rows_now, ["id"])
    assert emails(target) == [(1, "ana@x"), (2, "maria@x"), (3, "john@x"), (4, "sarah@x"), (5, "paul@x")]
    step4()
    rows_now, loaded = base.read(loaded)
    target = merge.upsert(target, rows_now, ["id"])
    # A delete in the source is not passed on.
    assert emails(target) == [(1, "ana.ana@x"), (2, "maria@x"), (3, "john@x"), (4, "sarah@x"), (5, "paul@x"), (6, "nina@x")]
    assert base.read(loaded)[0].count() == 0
    # A full read now holds id 3 twice and must be refused.
    with pytest.raises(Exception, match="more than one row"):
        merge.upsert(target, base.read(None)[0], ["id"]).collect()


def test_scd1_with_deletes_from_source(world):
    base, *_, step3, step4 = world
    target, loaded = base.read(None, append_delete=True)
    for step in (step3, step4):
        step()
        rows_now, loaded = base.read(loaded, append_delete=True)
        target = merge.delete_flagged(merge.upsert(target, rows_now, ["id"]), "deleted_date")
    assert emails(target) == [(1, "ana.ana@x"), (2, "maria@x"), (3, "john@x"), (5, "paul@x"), (6, "nina@x")]


def test_scd1_with_delete_feed_and_joins(world):
    base, child, base_del, child_del, step3, step4 = world

    def load(live, gone, target, state):
        a, state[0] = live.read(state[0])
        b, state[1] = gone.read(state[1])
        return merge.scd1_with_delete_feed(target, a, b, ["id"], ["raw_insert_date", "operation"])

    def versions(state):
        return [s if s is not None else old for s, old in state]

    base_state, child_state = [None, None], [None, None]
    a = load(base, base_del, None, base_state)
    b = load(child, child_del, None, child_state)
    assert emails(a) == [(1, "ana@x"), (3, "paul@x"), (4, "sarah@x")]
    assert rows(b.select("id", "country")) == [(1, "NL"), (10, "BR"), (2, "IT")]
    joined = harmonize.scd1_join(None, a, b, ["id"])
    step3()
    a2 = load(base, base_del, a, base_state)
    b2 = load(child, child_del, b, child_state)
    # Row and delete of id 3 carry the same time; the delete wins.
    assert emails(a2) == [(1, "ana@x"), (4, "sarah@x"), (5, "paul@x")]
    assert rows(b2.select("id", "country")) == [(1, "NL"), (10, "BR"), (4, "NL")]
    view = harmonize.join_view(a2, b2.select("id", "country"), ["id"])
    assert rows(view.select("id", "country")) == [(1, "NL"), (4, "NL"), (5, None)]
    increment = harmonize.affected_key_join(a2, [(b2.select("id", "country"), ["id"])], ["id"], [b2.where("id = 4")])
    assert rows(increment.select("id", "country")) == [(4, "NL")]


def test_scd2_without_and_with_deletes(world):
    base, _, base_del, _, step3, step4 = world
    loaded_a = loaded_d = None
    plain = with_deletes = None
    for step in (None, step3, step4):
        if step:
            step()
        a, new_a = base.read(loaded_a, keyed=False)
        d, new_d = base_del.read(loaded_d, keyed=False)
        loaded_a, loaded_d = new_a if new_a is not None else loaded_a, new_d if new_d is not None else loaded_d
        both = union_soft_deletes(a, d)
        plain = a if plain is None else merge.append_history(plain, a)
        with_deletes = both if with_deletes is None else merge.append_history(with_deletes, both)
    scd2 = history.scd2_history(plain, ["id"], "raw_insert_date")
    versions = rows(scd2.where("id = 3").select("email", "is_current"))
    assert versions == [("john@x", True), ("paul@x", False)]
    current = history.current_only(history.scd2_history(with_deletes, ["id"], "raw_insert_date"))
    assert current.groupBy("id").count().where("count > 1").count() == 0
    assert {r["id"] for r in current.where("operation = 'D'").collect()} == {2, 3}


def test_join_with_deletes(world, spark):
    base, child, base_del, child_del, step3, _ = world
    both = union_soft_deletes(base.rows, base_del.rows)
    left = history.current_only(history.scd2_history(both, ["id"], "raw_insert_date")).select("id", "name", "email", "operation")
    right = merge.scd1_with_delete_feed(None, child.rows, child_del.rows, ["id"], ["raw_insert_date", "operation"]).select("id", "country")
    target = harmonize.scd1_join_with_delete(None, left, right, ["id"], [left, right], "operation")
    assert rows(target.select("id", "country")) == [(1, "NL"), (3, None), (4, None)]
    step3()
    both = union_soft_deletes(base.rows, base_del.rows)
    left2 = history.current_only(history.scd2_history(both, ["id"], "raw_insert_date")).select("id", "name", "email", "operation")
    changed = left2.join(left, left2.columns, "left_anti")
    target = harmonize.scd1_join_with_delete(target, left2, right, ["id"], [changed], "operation")
    assert {r["id"] for r in target.collect()} == {1, 4, 5}
