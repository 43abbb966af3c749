import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import merge, shape
from tidemark.session import stored
from tidemark.plans import harmonize


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")


def test_upsert_updates_inserts_and_never_deletes(spark, target):
    source = spark.createDataFrame([(2, "B"), (3, "c")], target.schema)
    assert rows(merge.upsert(target, source, ["id"])) == rows(
        spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (None, "n")], target.schema)
    )


def test_upsert_rejects_duplicate_keys(spark, target):
    source = spark.createDataFrame([(3, "x"), (3, "y")], target.schema)
    with pytest.raises(Exception, match="more than one row"):
        merge.upsert(target, source, ["id"]).collect()
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], target.schema)
    with pytest.raises(Exception, match="more than one row"):
        merge.upsert(target, nulls, ["id"]).count()


def test_upsert_null_keys(spark, target):
    source = spark.createDataFrame([(None, "N")], target.schema)
    assert merge.upsert(target, source, ["id"]).where("id is null").collect()[0]["v"] == "N"
    assert merge.upsert(target, source, ["id"], null_safe=False).where("id is null").count() == 2


def test_upsert_schema_change(spark, target):
    source = spark.createDataFrame([(3, 9)], "ID int, extra int")
    kept = merge.upsert(target, source, ["id"])
    assert kept.columns == ["id", "v"] and kept.where("id = 3").first()["v"] is None
    synced = merge.upsert(target, source, ["ID"], schema_change="sync_all_columns")
    assert synced.columns == ["ID", "extra"] and synced.count() == 4
    with pytest.raises(ValueError):
        merge.upsert(target, source, ["id"], schema_change="fail")


def test_append_history_widens(spark, target):
    more = spark.createDataFrame([(1, "a", 5)], "id int, v string, extra int")
    assert merge.append_history(target, more).columns == ["id", "v", "extra"]
    assert merge.append_history(target, more, sync=False).columns == ["id", "v"]
    assert merge.append_history(target, more).count() == 4


def test_deletes(spark):
    df = spark.createDataFrame([(1, None), (2, "D"), (3, "I")], "id int, OPFLAG string")
    assert [r[0] for r in merge.delete_opflag(df).collect()] == [1, 3]
    assert [r[0] for r in merge.delete_flagged(df, "opflag").collect()] == [1]
    assert merge.delete_flagged(df, "deleted_date").count() == 3
    assert [r[0] for r in merge.delete_where(df, F.col("OPFLAG") == "D").collect()] == [1, 3]


def test_update_where_sees_old_values_and_keeps_types(spark):
    df = spark.createDataFrame([(1, 10), (2, None)], "a int, b int")
    found = merge.update_where(df, F.col("b") > 5, {"a": F.col("b"), "b": F.col("a")})
    assert rows(found) == rows(spark.createDataFrame([(10, 1), (2, None)], df.schema))
    assert found.schema == df.schema


LINES = "doc int, item int, at int, OPFLAG string"


def test_document_prune_modes(spark):
    lines = spark.createDataFrame(
        [(1, 1, 5, "I"), (1, 2, 5, "I"), (2, 1, 4, "I"), (2, 1, 5, "I"), (2, 2, 4, "I"), (3, 1, 1, "I"), (3, 2, 1, "D")], LINES
    )
    target = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 1)], "doc int, item int")

    def prune(mode, order):
        return rows(merge.document_prune(target, lines, ["doc"], ["doc", "item"], order, mode))

    # Latest version of each document stays, flagged lines go, unknown documents stay.
    assert prune("dense_rank", ["at"]) == [(1, 1), (1, 2), (2, 1), (3, 1), (4, 1)]
    # As is: one newest line per document, unless its key has an older row (2, 1) or is flagged (3, 2).
    assert prune("row_number", ["at", "item"]) == [(1, 2), (4, 1)]
    with pytest.raises(ValueError):
        prune("rank", ["at"])


def test_prune_by_row_number_ranks_in_a_step_of_its_own(spark):
    """The join with the target does not hold the ranking and counting of lines as well."""
    lines = spark.createDataFrame([(1, 1, 5, "I"), (1, 2, 7, "I"), (2, 1, 5, "D")], "doc int, item int, at int, OPFLAG string")
    target = lines.drop("OPFLAG")
    found = merge.document_prune(target, lines, ["doc"], ["doc", "item"], ["at"], mode="row_number")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "bool_or" not in plan and "count(" not in plan
    assert rows(found) == [(1, 2, 7)]


def test_document_replace_and_load(spark):
    target = spark.createDataFrame([(1, 1, "old"), (1, 2, "old"), (2, 1, "old")], "doc int, item int, v string")
    increment = spark.createDataFrame([(1, 1, "new"), (3, 1, "new")], target.schema)
    assert rows(merge.document_replace(target, increment, ["doc"])) == [(2, 1, "old")]
    assert rows(merge.document_load(target, increment, ["doc"], ["doc", "item"])) == [(1, 1, "new"), (2, 1, "old"), (3, 1, "new")]


@pytest.mark.parametrize("hot_rows", [10, 10_000])
def test_identity_key_is_dense_and_continues(spark, hot_rows):
    df = spark.range(500).selectExpr("(id * 37) % 500 as k")
    existing = spark.createDataFrame([(7,), (41,)], "id long")
    found = merge.identity_key(df, "id", ["k"], existing, hot_rows=hot_rows)
    assert rows(found.selectExpr("id - k")) == [(42,)] * 500
    assert merge.identity_key(df, "id", ["k"], hot_rows=hot_rows).agg(F.max("id")).first()[0] == 500


def test_two_feeds_meet_by_name(spark):
    first = spark.createDataFrame([(1, "x"), (1, "x")], "id int, v string")
    second = spark.createDataFrame([("D", "y", 2, "t"), ("I", "z", 3, None), ("I", "w", 4, "t")], "OPFLAG string, v string, id int, AEDATTM string")
    found = shape.union_two_feeds(first, second, "MAIN", "OTHER", "AEDATTM", ("v", 3))
    assert rows(found.select("id", "v", "OPFLAG", "_dbt_source_relation", "partition_key")) == [
        (1, "x", "", "MAIN", "x"), (2, "y", "D", "OTHER", "y"), (4, "w", "I", "OTHER", "w"),
    ]
    loaded = harmonize.load_two_feeds(None, first, second, ("MAIN", "OTHER"), ["id"], ["AEDATTM"], "AEDATTM")
    assert rows(loaded.select("id")) == [(1,), (4,)]
    again = harmonize.load_two_feeds(
        loaded, first.where("id = 9"), spark.createDataFrame([("D", "x", 1, "u")], second.schema),
        ("MAIN", "OTHER"), ["id"], ["AEDATTM"], "AEDATTM",
    )
    assert rows(again.select("id")) == [(4,)]


def test_sample_month_prunes(spark):
    df = spark.sql("select explode(sequence(timestamp_ntz'2021-12-31', timestamp_ntz'2022-03-02', interval 12 hour)) t")
    assert shape.sample_month(df, "t", 2022, 2).count() == 56


def test_flatten_orders(spark):
    orders = spark.sql(
        "select 'O1' order_nr, 'h' hash_key, timestamp'2022-03-05' ordered_at,"
        " array(named_struct('order_detail_nr', 1L, 'amount', 2), named_struct('order_detail_nr', 2L, 'amount', 3)) order_details"
    )
    found = shape.flatten_orders(orders, rename={"amount": "qty"})
    expected = spark.sql("select md5('h1') a, 2 b union all select md5('h2'), 3")
    assert rows(found.select("new_hash_key", "qty")) == rows(expected)
    assert set(rows(found.select("year", "month", "day"))) == {(2022, 3, 5)}


def test_document_prune_splits_a_hot_document(spark):
    """A third of all lines are one document: the join that finds its latest lines splits it."""
    size = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    lines = spark.range(60_000).select(size.alias("doc"), F.col("id").alias("line"), (F.col("id") % 2).alias("at"), F.lit("I").alias("OPFLAG"))
    lines = stored(lines, "lines")
    target = lines.select("doc", "line")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept = merge.document_prune(target, lines, ["doc"], ["doc", "line"], ["at"])
        # Latest of document 0: lines with an odd number; of all others: their only line.
        assert len(kept.collect()) == 10_000 + 40_000
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_document_prune_nulls_and_flags(spark):
    lines = spark.createDataFrame(
        [(1, 1, 1, "I"), (1, 2, 2, "I"), (1, 3, 2, "D"), (None, 4, 1, "I"), (None, 5, 2, None), (2, 6, None, "I")],
        "doc int, line int, at int, OPFLAG string",
    )
    target = lines.select("doc", "line").unionByName(spark.createDataFrame([(7, 7)], "doc int, line int"))
    kept = merge.document_prune(target, lines, ["doc"], ["line"], ["at"]).select("doc", "line")
    assert rows(kept) == [(1, 2), (2, 6), (7, 7), (None, 5)]
