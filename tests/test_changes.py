from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import changes, merge

AT = datetime(2024, 1, 1)
FEED = "id int, v string, ord int, _change_type string, _commit_version long, _commit_timestamp timestamp"


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [
            (1, "a", 1, "insert", 1, AT), (2, "b", 1, "insert", 1, AT),
            (1, "a", 1, "update_preimage", 2, AT), (1, "a2", 2, "update_postimage", 2, AT),
            (1, "a3", 3, "update_postimage", 3, AT), (2, "b", 1, "delete", 3, AT), (3, "c", 1, "insert", 4, AT),
        ],
        FEED,
    )


def plan(source, feed, last, loaded, **options):
    state = options.pop("state", changes.SourceState(last))
    return changes.plan_increment(source, feed, state, loaded, ["id"], ["ord"], **options)


def test_plan_increment_situations(spark, feed, caplog):
    source = spark.createDataFrame([(1, "a3", 3), (3, "c", 1)], "id int, v string, ord int")
    off, version = plan(source, feed, 4, 2, state=changes.SourceState(4, feed_enabled=False))
    assert rows(off) == rows(source) and version == 4 and "change feed is off" in caplog.text
    unknown, version = plan(source, feed, 4, None)
    assert rows(unknown) == rows(source) and version == 4 and "unknown" in caplog.text
    assert plan(source, feed, 4, -1)[1] == 4
    same, version = plan(source, feed, 4, 4)
    assert same.count() == 0 and version is None and same.columns == source.columns
    newer, version = plan(source, feed, 4, 1)
    assert rows(newer) == [(1, "a3", 3), (3, "c", 1)] and version == 4
    with pytest.raises(changes.SourceBehindTarget):
        plan(source, feed, 3, 4)
    skipped, version = plan(source, feed, 4, 1, incremental=False)
    assert rows(skipped) == rows(source) and version is None


def test_plan_increment_starts_after_a_destructive_change(spark, feed):
    source = feed.drop(*changes.FEED_COLUMNS)
    found, _ = plan(source, feed, 4, 1, state=changes.SourceState(4, 4))
    assert rows(found) == [(3, "c", 1)]


def test_version_zero_is_a_version(spark, feed):
    source = feed.drop(*changes.FEED_COLUMNS)
    assert plan(source, feed, 0, 0)[0].count() == 0


def test_deletes_only_on_request_and_column_always_there(spark, feed):
    assert rows(changes.latest_changes(feed, 2, ["id"], ["ord"])) == [(1, "a3", 3), (3, "c", 1)]
    with_deletes = changes.latest_changes(feed, 2, ["id"], ["ord"], append_delete=True)
    assert rows(with_deletes) == [(1, "a3", 3, None), (2, "b", 1, AT), (3, "c", 1, None)]
    source = spark.createDataFrame([(1, "a", 1)], "id int, v string, ord int")
    for loaded in (None, 4):
        full, _ = plan(source, feed, 4, loaded, append_delete=True)
        assert full.columns == with_deletes.columns and full.schema["deleted_date"].dataType == with_deletes.schema["deleted_date"].dataType


def test_order_falls_back_to_the_commit_version_and_all_columns_descend(spark):
    feed = spark.createDataFrame(
        [(1, "new", 2, "insert", 5, AT), (1, "old", 9, "insert", 4, AT), (2, "x", 1, "insert", 4, AT), (2, "y", 1, "insert", 5, AT)], FEED
    )
    assert rows(changes.latest_changes(feed, 0, ["id"]).select("id", "v")) == [(1, "new"), (2, "y")]
    assert rows(changes.latest_changes(feed, 0, ["id"], ["ord"]).select("id", "v")) == [(1, "old"), (2, "y")]
    assert changes.latest_changes(feed, 0).count() == 4


def test_scan_history_and_start_version(spark):
    enabled = '{"properties":"{\\"delta.enableChangeDataFeed":"true\\"}"}'
    history = spark.createDataFrame(
        [(0, "CREATE OR REPLACE TABLE AS SELECT", "{}"), (1, "WRITE", "{}"), (2, "SET TBLPROPERTIES", enabled), (3, "MERGE", None), (4, "WRITE", "{}")],
        "version long, operation string, operationParameters string",
    )
    assert tuple(changes.scan_history(history).first()) == (4, 2)
    found = spark.range(1).select(changes.start_version(0, 2), changes.start_version(3, 2)).first()
    assert tuple(found) == (2, 4)


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, at int")
    empty = df.where("at > 99")
    assert rows(changes.high_water_mark(df, "at", None)) == rows(df)
    assert rows(changes.high_water_mark(df, "at", empty)) == rows(df)
    assert rows(changes.high_water_mark(df, "at", df.where("id = 3"))) == rows(df)
    assert rows(changes.high_water_mark(df, "at", df.where("id = 1"))) == [(2, 20)]
    assert changes.high_water_mark(df, "at", df).count() == 0


def test_coalesce_with_target(spark):
    source = spark.createDataFrame([(1, None, "s"), (2, "n2", "s"), (3, None, "s")], "id int, name string, x string")
    target = spark.createDataFrame([(1, "t1"), (2, "t2")], "id int, full_name string")
    found = changes.coalesce_with_target(source, target, ["id"], {"name": "full_name"})
    assert found.columns == ["id", "x", "full_name"]
    assert rows(found) == [(1, "s", "t1"), (2, "s", "n2"), (3, "s", None)]
    assert rows(changes.coalesce_with_target(source, None, ["id"], {"name": "full_name"})) == [(1, "s", None), (2, "s", "n2"), (3, "s", None)]


snapshot = st.dictionaries(st.integers(0, 8) | st.none(), st.sampled_from(["a", "b", "", None]), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshot, snapshot)
def test_feed_of_two_snapshots_replays_to_the_second(spark, before, after):
    schema = "id int, v string"
    old, new = spark.createDataFrame(list(before.items()), schema), spark.createDataFrame(list(after.items()), schema)
    feed = changes.change_feed(old, new, ["id"], 3, AT)
    kinds = [r["_change_type"] for r in feed.collect()]
    assert kinds.count("insert") == len(after.keys() - before.keys())
    assert kinds.count("delete") == len(before.keys() - after.keys())
    updated = [k for k in before.keys() & after.keys() if before[k] != after[k]]
    assert kinds.count("update_preimage") == kinds.count("update_postimage") == len(updated)
    loaded = changes.latest_changes(feed, 3, ["id"], append_delete=True)
    target = merge.alter_columns(old, add={"deleted_date": "timestamp"})
    once = merge.upsert(target, loaded, ["id"])
    assert rows(merge.delete_flagged(once, "deleted_date").select("id", "v")) == rows(new)
    assert rows(merge.upsert(once, loaded, ["id"])) == rows(once)  # a repeated load changes nothing


def digest_case(spark, changed):
    old = [(i, f"v{i}", None if i % 7 else i) for i in range(500)]
    new = [(i, "x" if i in changed else v, n) for i, v, n in old if i not in (3, 400)] + [(900, None, 1)]
    schema = "id int, v string, n int"
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


@pytest.mark.parametrize("buckets", [1, 16, 5000])
def test_digests_give_the_same_feed(spark, buckets):
    old, new = digest_case(spark, {5, 77})
    at = datetime(2024, 1, 1)
    plain = rows(changes.change_feed(old, new, ["id"], 2, at))
    assert rows(changes.change_feed(old, new, ["id"], 2, at, buckets)) == plain and len(plain) == 2 * 2 + 2 + 1
    assert changes.change_feed(old, old, ["id"], 2, at, buckets).count() == 0
    assert rows(changes.change_feed(old.limit(0), new, ["id"], 2, at, buckets)) == rows(changes.change_feed(old.limit(0), new, ["id"], 2, at))


def test_equal_buckets_are_not_joined(spark):
    old, new = digest_case(spark, {5})
    unlike = changes.unlike_buckets(old, new, ["id"], 5000)
    assert unlike.count() <= 4
    assert changes._of_buckets(new, unlike, ["id"], 5000).count() <= 8
    # Nulls that change places, and values that do.
    a = spark.createDataFrame([(1, "x", None), (2, "p", "q")], "id int, v string, w string")
    b = spark.createDataFrame([(1, None, "x"), (2, "q", "p")], "id int, v string, w string")
    assert changes.unlike_buckets(a, b, ["id"], 64).count() == 2
    assert changes.unlike_buckets(a, a.select("w", "id", "v"), ["id"], 64).count() == 0
    with pytest.raises(ValueError):
        changes.unlike_buckets(a, b, ["id"], 0)
    with pytest.raises(ValueError):
        changes.unlike_buckets(a, b.drop("w"), ["id"], 4)
