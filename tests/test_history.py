import random
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import history, ordered, skew
from tidemark.plans.quality import test_valid_range as valid_range

# Change rows (id, country, update_date) and the history they must give.
CHANGES = [
    (1, "BE", "2023-01-01 00:00:00.000"), (1, "NL", "2023-01-01 20:00:00.000"), (1, "ES", "2023-01-20 00:00:00.000"),
    (2, "FR", "2023-01-01"), (2, "FR", "2023-01-10"), (3, "PT", "2023-01-01"), (4, "PT", "2023-01-01"),
    (5, None, "2023-01-01"), (5, None, "2023-01-10"), (5, "IT", "2023-01-20"),
]
END = datetime(9999, 12, 31)
HISTORY = [
    (1, "BE", "2023-01-01 00:00:00.000", datetime(2023, 1, 1), datetime(2023, 1, 1, 19, 59, 59, 999000), False),
    (1, "NL", "2023-01-01 20:00:00.000", datetime(2023, 1, 1, 20), datetime(2023, 1, 19, 23, 59, 59, 999000), False),
    (1, "ES", "2023-01-20 00:00:00.000", datetime(2023, 1, 20), END, True),
    (2, "FR", "2023-01-01", datetime(2023, 1, 1), END, True),
    (3, "PT", "2023-01-01", datetime(2023, 1, 1), END, True),
    (4, "PT", "2023-01-01", datetime(2023, 1, 1), END, True),
    (5, None, "2023-01-01", datetime(2023, 1, 1), datetime(2023, 1, 19, 23, 59, 59, 999000), False),
    (5, "IT", "2023-01-20", datetime(2023, 1, 20), END, True),
]
SCHEMA = "id int, country string, update_date string"


@pytest.mark.parametrize("hot_rows", [None, 1, 2, 1_000_000])
def test_scd2_golden(spark, hot_rows):
    found = history.scd2_history(spark.createDataFrame(CHANGES, SCHEMA), ["id"], "update_date", hot_rows=hot_rows)
    assert found.columns == ["id", "country", "update_date", "valid_from", "valid_to", "is_current"]
    assert rows(found) == rows(spark.createDataFrame(HISTORY, found.schema))
    assert valid_range(found).count() == 0


def test_scd2_first_valid_from_and_exclude(spark):
    df = spark.createDataFrame([(1, "a", "x", "2023-01-02"), (1, "a", "y", "2023-01-03"), (1, "b", "y", "2023-01-04")],
                               "id int, v string, note string, at string")
    found = history.scd2_history(df, ["id"], "at", exclude_from_check=["note"], first_valid_from="1900-01-01")
    assert [(r["v"], r["note"], r["valid_from"]) for r in found.orderBy("valid_from").collect()] == [
        ("a", "x", datetime(1900, 1, 1)), ("b", "y", datetime(2023, 1, 4)),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 1, 2, None]), st.sampled_from(["a", "b", None])), min_size=1, max_size=40))
def test_scd2_properties(spark, states):
    """Whatever the slicing: no overlap, one current row per key, same rows as brute force."""
    data = [(k, v, datetime(2024, 1, 1, 0, i)) for i, (k, v) in enumerate(states)]
    df = spark.createDataFrame(data, "k int, v string, at timestamp")
    expected = []
    for key in {k for k, _, _ in data}:
        kept = []
        for _, v, at in [d for d in data if d[0] == key]:
            if not kept or (kept[-1][0] or "") != (v or ""):
                kept.append((v, at))
        expected += [
            (key, v, at, i == len(kept) - 1, None if i == len(kept) - 1 else kept[i + 1][1]) for i, (v, at) in enumerate(kept)
        ]
    for hot_rows in (None, 1):
        found = history.scd2_history(df, ["k"], "at", hot_rows=hot_rows)
        next_start = F.when(~F.col("is_current"), F.col("valid_to") + F.expr("interval '0.001' second"))
        assert rows(found.select("k", "v", "valid_from", "is_current", next_start)) == sorted(
            expected, key=lambda r: tuple((x is None, str(x)) for x in r)
        )


@pytest.fixture
def hot(spark):
    """One key with two thirds of the rows, some null order values, many ties of the value."""
    return spark.range(3000).selectExpr(
        "if(id % 3 = 0, id % 50, 1000) as k", "if(id % 97 = 0, null, (id * 7919) % 3001) as at", "id",
        "if(id % 5 = 0, id, null) as v",
    )


def test_slices_cover_a_hot_key_evenly(spark, hot):
    order = ordered.KeyedOrder(hot, ["k"], ["at"], hot_rows=500)
    sizes = order.sliced(hot).groupBy("k", ordered.SLICE).count()
    assert {r["k"] for r in sizes.where(f"{ordered.SLICE} is not null").collect()} == {1000}
    assert sizes.where("k = 1000").count() >= 3
    assert sizes.agg(F.max("count")).first()[0] < 1000


def test_the_number_of_slices_is_bounded(spark):
    """The driver samples rows for every slice: their number must not grow with the rows."""
    df = spark.range(1_000_000).selectExpr("id % 1000 as k", "id as at")
    order = ordered.KeyedOrder(df, ["k"], ["at"], hot_rows=5)
    assert order.slices <= ordered.MOST_SLICES + 1
    sizes = [r["count"] for r in order.sliced(df).groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) > 100 and max(sizes) < 3 * 1_000_000 / ordered.MOST_SLICES


def test_rows_of_one_moment_are_sliced_too(spark):
    df = spark.range(2000).selectExpr("1 as k", "date'2024-01-01' as at", "id")
    tied = ordered.KeyedOrder(df, ["k"], ["at"], hot_rows=500)  # nothing but the row itself tells them apart
    assert tied.sliced(df).groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0] < 1000
    order = ordered.KeyedOrder(df, ["k"], ["at", "id"], hot_rows=500)
    assert order.sliced(df).groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0] < 1000
    numbered = order.number(order.sliced(df), "i")
    assert numbered.where("i <> id + 1").count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
def test_hot_windows_equal_plain_windows(spark, hot, keys):
    by = [F.col(k) for k in keys]
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy("at", "id")
    plain = hot.select(
        "id", F.lag("v").over(w).alias("p"), F.lead("id").over(w).alias("n"), F.row_number().over(w).cast("long").alias("i"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("l"),
    )
    order = ordered.KeyedOrder(hot, keys, ["at", "id"], hot_rows=500)
    assert order.sliced_at_all
    df = order.sliced(hot)
    df = order.previous(df, "v", "p")
    df = order.next(df, "id", "n")
    df = order.number(df, "i")
    df = order.latest(df, "v", "l")
    assert rows(df.select("id", "p", "n", "i", "l")) == rows(plain)


def test_descending_numbers(spark, hot):
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy(F.desc("at"), F.desc("id"))
    plain = hot.select("id", F.row_number().over(w).cast("long").alias("i"))
    found = history.row_number_per_header(hot, ["k"], ["at", "id"], "i", hot_rows=500)
    assert rows(found.select("id", "i")) == rows(plain)


def test_dedup_limits_before_the_shuffle(spark, hot):
    plan = history.dedup_latest(hot, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_latest_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (None, 1, "q")], "k int, o int, v string")
    assert rows(history.dedup_latest(df, ["k"], ["o"])) == rows(
        spark.createDataFrame([(1, 5, "b"), (None, 1, "q")], df.schema)
    )


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_range_join_validity(spark, hot_rows):
    versions = spark.createDataFrame([(1, 0, 10, "a"), (1, 10, 20, "b"), (1, 30, 40, "c"), (2, 0, 5, "d"), (1, 20, 20, "empty")],
                                     "k int, valid_from int, valid_to int, v string")
    facts = spark.createDataFrame([(1, t, i) for i, t in enumerate([-1, 0, 9, 10, 19, 20, 25, 30, 39, 40])] + [(2, 3, 100), (3, 1, 101), (1, None, 102)],
                                  "k int, at int, id int")
    found = history.range_join_validity(facts, versions, ["k"], "at", hot_rows=hot_rows)
    brute = facts.join(versions, ["k"]).where("at >= valid_from and at < valid_to").select(*found.columns)
    assert rows(found) == rows(brute) and found.count() == 7


def test_hot_keys_bound(spark, hot):
    assert skew.hot_keys(hot, ["k"], 10_000) is None
    assert {r["k"] for r in skew.hot_keys(hot, ["k"], 500).collect()} == {1000}
    assert skew.hot_keys(hot, ["k"], None) is None
    # A small share of the rows is no reason to leave a key whole.
    assert skew.hot_keys(hot, ["k"], 19).count() > 1


def test_facts_of_one_moment_are_split(spark):
    """Many facts of one key at one time: they go into several slices, each with its version."""
    facts = spark.range(3000).selectExpr("1 as k", "timestamp'2024-01-02' as at", "id as f")
    versions = spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (1, "2024-01-03", "c")], "k int, valid_from string, v string")
    versions = versions.withColumn("valid_from", F.col("valid_from").cast("timestamp"))
    ended = history.with_version_end(versions, ["k"], "valid_from")
    found = history.range_join_validity(facts, ended, ["k"], "at", hot_rows=200)
    assert found.count() == 3000 and {r.v for r in found.select("v").distinct().collect()} == {"b"}


def test_planning_does_not_grow_with_slices(spark):
    import time

    df = spark.range(4000).selectExpr("id % 2 as k", "id as at", "id % 7 as v")
    start = time.time()
    history.scd2_history(df, ["k"], "at", hot_rows=40)._jdf.queryExecution().executedPlan()
    assert time.time() - start < 60


def overlapping_case(spark, facts, versions):
    f = spark.createDataFrame(facts, "k int, at int, fact int")
    v = spark.createDataFrame(versions, "k int, valid_from int, valid_to int, version int")
    plain = [(k, at, n, a, b, m) for k, at, n in facts for j, a, b, m in versions
             if None not in (k, at, j, a, b) and k == j and a <= at < b]
    return f, v, sorted(plain)


@pytest.mark.parametrize("hot_rows,slice_facts", [(None, 512), (40, 7), (None, 1)])
def test_range_join_of_overlapping_versions(spark, monkeypatch, hot_rows, slice_facts):
    """Equal to the plain range join: ties, empty and endless intervals, nulls, a hot key."""
    monkeypatch.setattr(history, "SLICE_FACTS", slice_facts)
    rng = random.Random(slice_facts)
    key = lambda: 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, None])
    facts = [(key(), rng.choice([None, *range(40)]), i) for i in range(150)] + [(9, 5, -1)]
    versions = []
    for i in range(120):
        start = rng.choice([None, *range(-5, 45)])
        length = rng.choice([-1, 0, 1, 3, 20, 1000])
        versions.append((key(), start, None if start is None else start + length, i))
    f, v, want = overlapping_case(spark, facts, versions)
    got = history.range_join_validity(f, v, ["k"], "at", hot_rows=hot_rows, overlapping=True)
    assert got.columns == ["k", "at", "fact", "valid_from", "valid_to", "version"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert history.range_join_validity(f.limit(0), v, ["k"], "at", hot_rows=hot_rows, overlapping=True).count() == 0
    assert history.range_join_validity(f, v.limit(0), ["k"], "at", hot_rows=hot_rows, overlapping=True).count() == 0


def test_a_hot_key_is_spread_over_its_slices(spark, monkeypatch):
    monkeypatch.setattr(history, "SLICE_FACTS", 100)
    facts = spark.range(10_000).selectExpr("1 as k", "cast(id as int) as at")
    versions = spark.range(50).selectExpr("1 as k", "cast(id * 100 as int) as valid_from", "cast(id * 100 + 250 as int) as valid_to")
    found = history.range_join_validity(facts, versions, ["k"], "at", overlapping=True)
    assert found.count() == 50 * 250
    # What the join shuffles by: (key, slice), each slice holding 100 facts.
    assert "__slice_nr" in found._jdf.queryExecution().executedPlan().toString()


def test_overlap_check(spark):
    versions = spark.createDataFrame([(1, 0, 5, 0), (1, 5, 9, 1), (1, 8, 10, 2), (2, 0, 3, 3), (2, 3, 3, 4), (None, 0, 9, 5)], "k int, valid_from int, valid_to int, version int")
    for hot_rows in (None, 1):
        assert [(r["version"], r["next_from"]) for r in history.overlapping_versions(versions, ["k"], hot_rows=hot_rows).collect()] == [(1, 8)]
    with pytest.raises(ValueError):
        history.range_join_validity(versions, versions, ["k"], "valid_from", valid_to=None, overlapping=True)
