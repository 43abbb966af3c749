import pytest
from conftest import rows

from tidemark.operators import joins, skew
from tidemark.plans.harmonize import affected_key_join, leaves


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, l string")
    right = spark.range(120).selectExpr("cast(if(id < 100, 1, if(id < 110, 2, if(id < 115, 9, null))) as int) k", "id r")
    return left, right


@pytest.mark.parametrize("hot_rows", [None, 5, 50, 1000])
def test_left_join_many(spark, sides, hot_rows):
    left, right = sides
    assert rows(joins.left_join_many(left, right, ["k"], hot_rows)) == rows(left.join(right, ["k"], "left"))


def test_left_join_many_when_both_sides_are_hot(spark, sides):
    left, right = sides
    many = left
    for _ in range(5):
        many = many.unionByName(many)
    joined = joins.left_join_many(many, right, ["k"], 5)
    assert rows(joined) == rows(many.join(right, ["k"], "left"))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_affected_key_join_reads_full_sides(spark, hot_rows):
    header = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "k int, h string")
    detail = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 100)], "k int, d int")
    changed_detail = detail.where("d = 7")
    found = affected_key_join(header, [(detail, ["k"])], ["k"], [header.where("k = 3"), changed_detail], hot_rows)
    expected = [(1, "h1", i) for i in range(20)] + [(3, "h3", None)]
    assert rows(found) == rows(spark.createDataFrame(expected, found.schema))


def test_inner_join_keys_with_hot_keys(spark, sides):
    _, right = sides
    affected = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int")
    hot = skew.hot_keys(right, ["k"], 50)
    assert hot is not None
    assert rows(joins.inner_join_keys(right, affected, ["k"], hot)) == rows(joins.inner_join_keys(right, affected, ["k"]))
    assert joins.inner_join_keys(right, affected, ["k"]).count() == 105


def test_anti_join_and_nulls(spark, sides):
    left, right = sides
    assert rows(joins.anti_join(left, right, ["k"]).select("l")) == [("c",), ("n",)]
    assert rows(joins.anti_join(left, right, ["k"], null_safe=True).select("l")) == [("c",)]


@pytest.mark.parametrize("listed", [[], [1], [1, None], [None]])
def test_not_in_equals_sql(spark, sides, listed):
    left, _ = sides
    other = spark.createDataFrame([(v,) for v in listed], "x int")
    left.createOrReplaceTempView("not_in_left")
    other.createOrReplaceTempView("not_in_other")
    expected = spark.sql("select * from not_in_left where k not in (select x from not_in_other)")
    assert rows(joins.not_in(left, "k", other, "x")) == rows(expected)


def test_key_join_rejects_unknown_null_safe_kind_gracefully(spark, sides):
    left, right = sides
    assert joins.key_join(left, right, ["k"], "left_semi", null_safe=True).count() == 3


def test_leaves(spark):
    tree = spark.createDataFrame([("A1", None), ("A2", "A1"), ("A3", "A2"), ("A4", "A1")], "nr string, parent string")
    assert sorted(r["nr"] for r in leaves(tree, "nr", "parent").collect()) == ["A3", "A4"]


def test_left_join_counts(spark):
    planned = spark.createDataFrame([(1, 5), (2, 2), (3, 1)], "id int, nr_of_runs int")
    done = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,)], "cfg int")
    found = joins.left_join_counts(planned, done, "id", "cfg")
    assert rows(found.select("id", "nr_runs_to_go")) == [(1, 3), (3, 1)]


def test_insert_select_where_new_treats_null_as_a_key(spark):
    existing = spark.createDataFrame([(1,), (None,)], "k int")
    candidates = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(joins.insert_select_where_new(existing, candidates, ["k"])) == [(2,)]
