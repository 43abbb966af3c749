import random
import statistics
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import quality, reports, tags
from tidemark.plans.harmonize import Feed, harmonize_balance, harmonize_fact, harmonize_master3, load_keyed
from tidemark.operators.merge import upsert

NOW = datetime(2024, 5, 1)


def feeds(spark, headers, lines):
    header = Feed(
        spark.createDataFrame(headers, "MANDT string, BELNR int, AMT int, ingested_at int"),
        {"MANDT": "Client", "BELNR": "Document", "AMT": "Amount", "ingested_at": "Header_Loaded"}, ("MANDT", "280"), "Header_Loaded",
    )
    detail = Feed(
        spark.createDataFrame(lines, "BELNR int, BUZEI int, ingested_at int"),
        {"BELNR": "Document", "BUZEI": "Item", "ingested_at": "Detail_Loaded"}, None, "Detail_Loaded",
    )
    return header, detail


def test_fact_increments_equal_a_full_load(spark):
    headers = [("280", 1, 10, 1), ("280", 2, 20, 1), ("480", 3, 30, 1), ("280", 4, 40, 1)]
    lines = [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1)]
    options = {"system_id": "D80", "client": "Client", "now": NOW}
    keys = ["Source_ID", "Document", "Item"]
    target = harmonize_fact(*feeds(spark, headers, lines), ["Document"], **options)
    assert rows(target.select("Document", "Item", "Source_ID")) == [
        (1, 1, "D80_280"), (1, 2, "D80_280"), (2, 1, "D80_280"), (4, None, "D80_280"),
    ]
    headers2 = [("280", 1, 11, 2)] + headers[1:] + [("280", 5, 50, 2)]
    lines2 = lines + [(2, 2, 3)]
    both = feeds(spark, headers2, lines2)
    increment = harmonize_fact(*both, ["Document"], target=target, **options)
    # A changed header brings its unchanged lines, a changed line its unchanged header.
    assert rows(increment.select("Document", "Item")) == [(1, 1), (1, 2), (2, 1), (2, 2), (5, None)]
    full = harmonize_fact(*both, ["Document"], **options)
    merged = upsert(target, increment, keys)
    assert rows(merged) == rows(full)
    again = harmonize_fact(*both, ["Document"], target=merged, **options)
    assert again.count() == 0
    # Null key parts match, so a repeated merge adds nothing.
    assert rows(upsert(merged, increment, keys)) == rows(full)


def test_master3_multiplies_only_by_its_listed_keys(spark):
    account = Feed(spark.createDataFrame([("280", "CH", 1)], "MANDT string, KTOPL string, SAKNR int"), {"MANDT": "Client", "KTOPL": "Chart", "SAKNR": "Account"})
    company = Feed(spark.createDataFrame([(1, "c1"), (1, "c2"), (2, "c3")], "SAKNR int, BUKRS string"), {"SAKNR": "Account", "BUKRS": "Company"})
    text = Feed(spark.createDataFrame([(1, "CH", "t"), (1, "XX", "u")], "SAKNR int, KTOPL string, TXT string"), {"SAKNR": "Account", "KTOPL": "Chart", "TXT": "Text"})
    found = harmonize_master3(account, company, text, ["Account"], ["Account", "Chart"], system_id="P80", client="Client", now=NOW)
    assert rows(found.select("Account", "Company", "Text", "Source_ID")) == [(1, "c1", "t", "P80_280"), (1, "c2", "t", "P80_280")]


def test_balance_keeps_source_time_and_loads_all_into_an_empty_target(spark):
    df = spark.createDataFrame([("280", 1, 5), ("280", 2, 6)], "RCLNT string, DOC int, ingested_at int")
    feed = Feed(df, {"RCLNT": "Client", "DOC": "Doc", "ingested_at": "Loaded"}, ("RCLNT", "280"), "Loaded")
    first = harmonize_balance(feed, "D80", "Client", now=NOW)
    assert harmonize_balance(feed, "D80", "Client", first.where("false"), NOW).count() == 2
    assert rows(harmonize_balance(feed, "D80", "Client", first.where("Doc = 1"), NOW).select("Doc")) == [(2,)]


def test_load_keyed(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string")
    target = load_keyed(None, df, ["k"], ["at"])
    assert rows(target.select("k", "v")) == [(1, "b"), (2, "c")]
    newer = df.union(spark.createDataFrame([(2, 5, "C"), (3, 6, "d"), (1, 0, "late")], df.schema))
    assert rows(load_keyed(target, newer, ["k"], ["at"], "at").select("k", "v")) == [(1, "b"), (2, "C"), (3, "d")]


@pytest.fixture
def daily(spark):
    """Ten rows a day for 20 days, none on day 15, a hundred on day 18."""
    data = []
    for day in range(20):
        n = {15: 0, 18: 100}.get(day, 10 + day % 2)
        for i in range(n):
            data.append((datetime(2024, 1, 1) + timedelta(days=day, hours=i % 24), None if day == 18 or i == 0 else "x", "NULL" if i == 1 else " " if i == 2 else "y"))
    return spark.createDataFrame(data, "at timestamp, a string, b string")


def flagged(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.where("is_anomalous").collect()}


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def test_volume_anomalies(daily):
    found = quality.volume_anomalies(daily, "at", sensitivity=3)
    assert found.count() == 20
    assert flagged(found, "bucket") == {(day(15),), (day(18),)}
    assert flagged(quality.volume_anomalies(daily, "at", direction="spike"), "bucket") == {(day(18),)}
    assert flagged(quality.volume_anomalies(daily, "at", direction="drop"), "bucket") == {(day(15),)}
    with pytest.raises(ValueError):
        quality.volume_anomalies(daily, "at", direction="up")
    assert quality.volume_anomalies(daily.where("false"), "at").count() == 0


def test_freshness_anomalies(daily):
    found = quality.freshness_anomalies(daily, "at", sensitivity=3)
    assert (day(15),) in flagged(found, "bucket")
    late = found.where("bucket = timestamp'2024-01-16'").first()
    assert late["delay_seconds"] == 2 * 86400 - 9 * 3600  # latest row: the day before at nine


def test_column_anomalies(daily):
    found = quality.column_anomalies(daily, "at", ["a", "b"], sensitivity=3, days_back=14)
    # Day 18 stands out; day 19 is judged by days that include it.
    assert {(day(18), "a", "null_count"), (day(18), "a", "null_percent")} <= flagged(found, "bucket", "column_name", "metric")
    one = found.where("bucket = timestamp'2024-01-01' and column_name = 'b'").collect()
    assert {r["metric"]: r["metric_value"] for r in one} == {"null_count": 0, "null_percent": 0, "missing_count": 2}
    few = quality.column_anomalies(daily, "at", ["a"], metrics=["null_count"], where=F.col("at") < day(3))
    assert few.count() == 3


def test_schema_changes(spark):
    before = spark.createDataFrame([], "name string, code int, capital string")
    after = spark.createDataFrame([], "name string, code string, population bigint")
    found = quality.schema_changes(quality.schema_listing(before), quality.schema_listing(after))
    assert rows(found) == [
        ("capital", "string", None, "column_removed"), ("code", "int", "string", "type_changed"), ("population", None, "bigint", "column_added"),
    ]


TAGS = "table_name string, column_name string, tag string"


def test_tag_sync_plan(spark):
    current = spark.createDataFrame([("t", None, "keep"), ("t", None, "owner=a"), ("t", None, "secret"), ("t", "c", "old"), ("same", None, "x=1")], TAGS)
    declared = spark.createDataFrame([("t", None, "keep"), ("t", None, "owner=b"), ("same", None, "x=1"), ("new", "c", "pii"), ("t", None, "run")], TAGS)
    plan = tags.tag_sync_plan(current, declared, ["secret", "run"])
    assert rows(plan.select("table_name", "column_name", "step", "action", "tags")) == [
        ("new", "c", 3, "set_without_value", ["pii"]),
        ("t", "c", 1, "unset", ["old"]),
        ("t", None, 1, "unset", ["owner"]),
        ("t", None, 2, "set_with_value", ["owner=b"]),
        ("t", None, 3, "set_without_value", ["keep"]),
    ]


def test_tag_rollup_round_trip(spark):
    place = "catalog_name string, schema_name string, table_name string"
    columns = spark.createDataFrame([("c", "s", "t", "a", "pii", ""), ("c", "s", "t", "a", "unit", "kg"), ("c", "s", "u", "b", "x", None)], place + ", column_name string, tag_name string, tag_value string")
    tables = spark.createDataFrame([("c", "s", "t", "owner", "me"), ("c", "s", "v", "raw", "")], place + ", tag_name string, tag_value string")
    rolled = tags.tag_rollup(columns, tables)
    config = tags.config_of(F.col("config"))
    read = rolled.select("full_name", config["tags"].alias("tags"), tags.column_tags_of(config, "a").alias("a"))
    assert rows(read) == [("c.s.t", ["owner=me"], ["pii", "unit=kg"]), ("c.s.u", [], None), ("c.s.v", ["raw"], None)]


def test_model_table_match(spark):
    catalog = spark.createDataFrame(
        [("s", "a", "MANAGED"), ("s", "b", "VIEW"), ("s", "c", "EXTERNAL"), ("other", "d", "MANAGED"), ("s", "alembic_version", "MANAGED")],
        "table_schema string, table_name string, table_type string",
    )
    models = spark.createDataFrame([("s", "a", "incremental"), ("s", "b", "table")], "schema string, name string, materialized string")
    assert rows(tags.model_table_match(catalog, models, ignore_tables=["alembic_version"])) == [("s", "b", "view"), ("s", "c", "table")]
    assert rows(tags.model_table_match(catalog, models, prefix="c")) == [("s", "c", "table")]


def test_benchmark_report_names_photon_right(spark):
    cases = spark.createDataFrame([(1, "full_80m"), (2, "full_82m"), (3, "dropped")], "id long, use_case string")
    configs = spark.createDataFrame(
        [(10, 1, "DLT", None, None, 3, True), (11, 1, "DLT", None, None, 19, False), (12, 2, "DBT", True, "Small", None, None), (13, 1, "DBT", True, "Small", None, None), (14, 3, "DBT", True, "Small", None, None)],
        "id long, use_case_id long, run_type string, dbt_sql_serverless boolean, dbt_sql_cluster_size string, dlt_nr_of_workers int, dlt_photon boolean",
    )
    log = spark.createDataFrame(
        [(c, d, "SUCCESS") for c, d in [(10, 10), (10, 20), (11, 40), (12, 7), (13, 900), (14, 900)]] + [(12, 1000, "FAILED")],
        "benchmark_run_config_id long, duration int, status string",
    ).withColumns({"start_time": F.lit(NOW), "end_time": F.lit(NOW)})
    left_out = ((F.col("use_case") == "full_80m") & (F.col("run_type") == "DBT")) | (F.col("use_case") == "dropped")
    found = reports.benchmark_report(cases, configs, log, {"full_82m": "full_80m"}, left_out)
    columns = ["dbu", "config", "dbt_server_based", "dbt_serverless", "dlt_no_photon", "dlt_photon"]
    assert rows(found.select("use_case", *columns)) == [
        ("full_80m", 12, "small", None, 7.0, None, None),
        ("full_80m", 20, "19 worker(s) (no photon) / 3 worker(s) (photon)", None, None, 40.0, 15.0),
    ]


def test_benchmark_grid_inserts_new_only(spark):
    cases = spark.createDataFrame([(1, "full"), (2, "inc")], "use_case_id int, use_case string")
    options = dict(excluded={"Large": ["inc"]}, excluded_dimension="size", constants={"run_type": "DBT"})
    first = reports.benchmark_grid(cases, {"size": ["Small", "Large"], "serverless": [0, 1]}, **options)
    assert first.count() == 6
    again = reports.benchmark_grid(cases, {"size": ["Small", "Large", "X"], "serverless": [0, 1]}, existing=first, keys=["use_case_id", "size", "serverless"], **options)
    assert rows(again.select("use_case", "size").distinct()) == [("full", "X"), ("inc", "X")]


def test_run_report(spark):
    runs = spark.createDataFrame([("i1", "m", 120.0, "success"), ("i1", "m", 60.0, "success"), ("i1", "m", 999.0, "error"), ("i2", "m", 60.0, "success")],
                                 "invocation_id string, name string, execution_time double, status string")
    inv = spark.createDataFrame([("i1", "Test performance. 1st run. All"), ("i2", "other 2nd run.")], "invocation_id string, invocation_vars string")
    assert rows(reports.run_report(runs, inv)) == [("1st run", "m", 2.0, 1.0, 1.5, 2)]


def test_monitor_of_minutes_over_years(spark):
    """Buckets are numbered by a range and compared slice by slice, no window in one task."""

    def monitored(year):
        ends = [(datetime(year, 1, 1) - timedelta(days=60),), (datetime(2024, 1, 1, 0, 1),), (None,), (None,)]
        return quality.volume_anomalies(spark.createDataFrame(ends, "ts timestamp_ntz"), "ts", bucket="minute", days_back=1)

    # The last minute is like no other before it: their mean and deviation are 0.
    some = monitored(2024).where("is_anomalous").select("bucket", "row_count").collect()
    assert {tuple(r) for r in some} == {(datetime(2024, 1, 1, 0, 1), 1), (None, 2)}
    plan = monitored(1974)._jdf.queryExecution().executedPlan().toString()
    assert "Range (0, 26" in plan and "SinglePartition" not in plan and "__slice" in plan.split("Window")[1]


def test_monitor_slices_change_nothing(spark):
    """Equal to one window over all buckets, for every length of the days before."""
    rng = random.Random(3)
    times = [datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 60)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    for bucket, days in (("day", 1), ("day", 7), ("hour", 2), ("week", 14), ("month", 31)):
        got = {r["bucket"]: r for r in quality.volume_anomalies(df, "ts", bucket, days, 1).collect()}
        counts = {b: r["row_count"] for b, r in got.items()}
        assert sum(counts.values()) == 400
        for b, r in got.items():
            before = [n for a, n in counts.items() if timedelta(0) < b - a <= timedelta(days=days)]
            assert (r["training_avg"] is None) == (not before)
            if before:
                assert abs(r["training_avg"] - sum(before) / len(before)) < 1e-9
            if len(before) > 1:
                assert abs(r["training_stddev"] - statistics.stdev(before)) < 1e-9


def test_all_units_of_buckets(spark):
    df = spark.createDataFrame([(datetime(2023, 11, 30, 23, 59, 58),), (datetime(2024, 3, 1, 0, 0, 1),)], "ts timestamp_ntz")
    n = {u: quality.volume_anomalies(df, "ts", u).count() for u in ("day", "week", "month", "quarter", "year", "hour")}
    assert n == {"day": 93, "week": 14, "month": 5, "quarter": 2, "year": 2, "hour": 2186}
    with pytest.raises(ValueError):
        quality.volume_anomalies(df, "ts", "fortnight")
    assert quality.volume_anomalies(df.limit(0), "ts").count() == 0
    fresh = quality.freshness_anomalies(df, "ts", "day").orderBy("bucket").collect()
    assert [r["delay_seconds"] for r in fresh[:2]] == [2.0, 86402.0] and len(fresh) == 93
