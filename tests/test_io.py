from datetime import datetime

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.changes import SourceBehindTarget, SourceState
from tidemark.plans import sales
from tidemark.plans.loads import load_increment
from tidemark.session import shared_dir
from tidemark.sources import tables as io
from tidemark.sources.snapshots import SnapshotTable, last_loaded_version, load_state, save_load_version
from tidemark.streaming import ingest


def test_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "country.csv"
    path.write_bytes("﻿name,code,iso2,iso3\nAmerican Samoa,1-684,AS,ASM\nNamibia,264,NA,NAM\n".encode("utf-8"))
    seed = io.scan_csv_seed(spark, str(path))
    assert seed.columns == ["name", "code", "iso2", "iso3"] and set(dict(seed.dtypes).values()) == {"string"}
    assert rows(seed) == [("American Samoa", "1-684", "AS", "ASM"), ("Namibia", "264", "NA", "NAM")]


def test_json_new_files(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    loaded = spark.createDataFrame(io.scan_json_landing(spark, str(folder), "id int").collect())
    assert io.scan_json_new_files(spark, str(folder), loaded, "id int").count() == 0
    (folder / "b.json").write_text('{"id": 3}\n')
    assert rows(io.scan_json_new_files(spark, str(folder), loaded, "id int").select("id")) == [(3,)]
    assert io.scan_json_new_files(spark, str(folder), None, "id int").count() == 3


def test_write_df_merges_schemas_and_where_new(spark):
    path = shared_dir(spark, "t")
    io.write_df(spark.createDataFrame([(1, "a")], "id int, v string"), path, "Overwrite")
    io.write_where_new(spark, spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string"), path, ["id"])
    io.write_df(spark.createDataFrame([(3, 9)], "id int, extra int"), path, "Append")
    assert rows(io.read_df(spark, path).select("id", "v", "extra")) == [(1, "a", None), (2, "c", None), (3, None, 9)]


def test_partition_pruning_reaches_the_scan(spark):
    path = shared_dir(spark, "t")
    io.write_partitioned(spark.range(100).selectExpr("id", "id % 4 as p"), path, ["p"])
    df = spark.read.parquet(path).where("p = 3")
    assert df.count() == 25 and len(df.inputFiles()) < len(spark.read.parquet(path).inputFiles()) + 1
    assert "PartitionFilters: [isnotnull(p" in df._jdf.queryExecution().executedPlan().toString()


def test_load_state(spark):
    path = shared_dir(spark, "state")
    assert last_loaded_version(spark, path, "a") is None and load_state(spark, path).count() == 0
    save_load_version(spark, path, "a", 0)
    save_load_version(spark, path, "a", 4)
    save_load_version(spark, path, "b", 2)
    save_load_version(spark, path, "b", None)
    assert last_loaded_version(spark, path, "a") == 4 and last_loaded_version(spark, path, "b") == 2


def test_snapshot_table(spark):
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=4)
    schema = "id int, v string"
    assert table.version() == -1
    table.merge(spark.createDataFrame([(i, "a") for i in range(20)], schema))
    before = table.read()
    assert table.merge(spark.createDataFrame([(3, "b"), (99, "n")], schema), "load 5") == 1
    files = table.read().inputFiles()
    assert rows(before) == rows(spark.createDataFrame([(i, "a") for i in range(20)], schema))  # readers keep theirs
    expected = [(i, "b" if i == 3 else "a") for i in range(20)] + [(99, "n")]
    assert rows(table.read()) == rows(spark.createDataFrame(expected, schema))
    # The same token again changes nothing, whatever comes with it.
    assert table.merge(spark.createDataFrame([(3, "zzz")], schema), "load 5") == 1
    assert table.read().inputFiles() == files
    # Untouched buckets stay where they are.
    assert 0 < sum("/data/1-" in f for f in files) < len(files)
    assert [r["version"] for r in table.history().orderBy("version").collect()] == [0, 1]


def test_snapshot_table_keeps_its_buckets_and_keys(spark):
    root, schema = shared_dir(spark, "snap"), "id int, v string"
    SnapshotTable(spark, root, ["id"], buckets=8).merge(spark.createDataFrame([(i, "a") for i in range(100)], schema))
    again = SnapshotTable(spark, root, ["id"])  # another number of buckets by default
    again.merge(spark.createDataFrame([(i, "b") for i in range(10)], schema))
    assert again.read().count() == again.read().select("id").distinct().count() == 100
    assert again.read().where("v = 'b'").count() == 10
    with pytest.raises(ValueError, match="keyed by"):
        SnapshotTable(spark, root, ["v"]).read()


def test_snapshot_table_refuses_a_second_writer(spark):
    root, schema = shared_dir(spark, "snap"), "id int, v string"
    one, two = (SnapshotTable(spark, root, ["id"], buckets=2) for _ in range(2))
    one.merge(spark.createDataFrame([(1, "a")], schema))
    seen = two._committed()
    one.merge(spark.createDataFrame([(2, "b")], schema))
    with pytest.raises(RuntimeError, match="another writer"):
        two._commit(seen, spark.createDataFrame([(3, "c")], schema), [0, 1], None, "MERGE")


def test_snapshot_table_purges_and_empties(spark):
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=2)
    schema = "id int, v string, gone string"
    table.merge(spark.createDataFrame([(1, "a", None), (2, "b", None)], schema), purge="gone")
    table.merge(spark.createDataFrame([(1, None, "D"), (2, None, "D")], schema), purge="gone")
    assert table.read().count() == 0 and table.read().columns == ["id", "v", "gone"]
    table.merge(spark.createDataFrame([(3, "c", None)], schema), purge="gone")
    assert rows(table.read().select("id")) == [(3,)]
    table.merge(spark.createDataFrame([], schema))
    assert table.version() == 3 and table.read().count() == 1
    with pytest.raises(Exception, match="more than one row"):
        table.merge(spark.createDataFrame([(4, "x", None), (4, "y", None)], schema))
    assert table.version() == 3 and table.read().count() == 1  # a failed merge leaves no trace


def test_snapshot_merge_failing_before_commit_is_invisible(spark, monkeypatch):
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=2)
    schema = "id int, v string"
    table.merge(spark.createDataFrame([(1, "a"), (2, "b")], schema))
    from tidemark.sources import snapshots

    committed = table._committed()
    monkeypatch.setattr(table, "_committed", lambda token=None: committed)
    monkeypatch.setattr(snapshots, "COMMIT_SCHEMA", "no schema at all")
    with pytest.raises(Exception):
        table.merge(spark.createDataFrame([(1, "A"), (2, "B"), (5, "x")], schema), "t")
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    table.merge(spark.createDataFrame([(1, "A")], schema), "t")
    assert rows(table.read()) == [(1, "A"), (2, "b")]


def test_stream_upsert_equals_batch_and_survives_a_replay(spark, tmp_path):
    schema = "id int, v string, at int"
    landing = str(tmp_path / "in")
    for batch in ([(1, "a", 1), (2, "b", 1)], [(1, "late", 0), (2, "B", 2), (2, "B2", 3)], [(3, "c", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(landing)
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=2)
    for checkpoint in ("one", "two"):  # a second, empty checkpoint replays every batch
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(landing)
        ingest.stream_upsert(stream, table, ["at"], str(tmp_path / checkpoint)).awaitTermination()
        assert rows(table.read()) == [(1, "a", 1), (2, "B2", 3), (3, "c", 1)]


def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").json(landing)
        stream = ingest.scan_json_stream(spark, landing, "id long")
        ingest.stream_file_ingest(stream, out, progress).awaitTermination()
    found = spark.read.parquet(out)
    assert found.count() == 20 and found.where("file_path like '%.json'").count() == 20


def test_limits():
    runs = []
    assert ingest.stream_continuous_refresh(runs.append, finish_after_runs=2, finish_after_seconds=0) == 2 and runs == [0, 1]
    with pytest.raises(ValueError):
        ingest.stream_microbatch_append(None, None, "", "", 1)


def test_microbatch_append_goes_on_and_repeats_a_lost_batch(spark, tmp_path):
    path, progress = str(tmp_path / "orders"), str(tmp_path / "progress")
    attempts = []

    def make(numbers):
        attempts.append(1)
        return numbers.select(F.concat(F.lit("O"), F.col("value")).alias("order_nr"), F.xxhash64("value").alias("drawn"))

    def lost(numbers):
        made = make(numbers)
        if len(attempts) == 3:  # rows are there, the stream does not know it yet
            made.write.mode("overwrite").parquet(f"{path}/{ingest.APPENDED}=2")
            raise RuntimeError("killed")
        return made

    with pytest.raises(Exception, match="killed"):
        ingest.stream_microbatch_append(spark, lost, path, progress, 4, number_of_batches=5)
    before = rows(spark.read.parquet(path).select("order_nr", "drawn"))
    assert len(before) == 12
    assert ingest.stream_microbatch_append(spark, make, path, progress, 4, number_of_batches=2) == 2
    found = spark.read.parquet(path)
    assert sorted(int(r["order_nr"][1:]) for r in found.collect()) == list(range(20))  # the lost batch and two more
    assert set(before) <= set(rows(found.select("order_nr", "drawn")))
    assert ingest.stream_microbatch_append(spark, make, path, progress, 4, number_of_seconds=0.01) == 1
    assert spark.read.parquet(path).count() == 24


UPDATES = "id int, v string, gone string, at timestamp"


def updates(spark, tmp_path, batches):
    """Batches of (id, v, gone, day of January), one file each, in this order."""
    for batch in batches:
        data = [(i, v, g, datetime(2024, 1, day)) for i, v, g, day in batch]
        spark.createDataFrame(data, UPDATES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return ingest.scan_parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], UPDATES).schema, max_files=1)


def test_late_rows_do_not_bring_back_what_was_deleted(spark, tmp_path):
    batches = [[(1, "a", None, 2), (2, "b", None, 2)], [(1, None, "D", 10)], [(1, "late", None, 9), (3, "c", None, 11)], [(2, "late", None, 1)]]
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=2)
    for checkpoint in ("one", "two"):  # the second replays everything
        stream = updates(spark, tmp_path, batches if checkpoint == "one" else [])
        ingest.stream_upsert(stream, table, ["at"], str(tmp_path / checkpoint), "gone", horizon="20 days").awaitTermination()
        assert rows(ingest.live_rows(table, "gone").select("id", "v")) == [(2, "b"), (3, "c")]
    assert table.read().where("gone = 'D'").count() == 1
    again = updates(spark, tmp_path, [[(1, "newer", None, 12)]])  # a later row does
    ingest.stream_upsert(again, table, ["at"], str(tmp_path / "one"), "gone", horizon="20 days").awaitTermination()
    assert rows(ingest.live_rows(table, "gone").select("id", "v")) == [(1, "newer"), (2, "b"), (3, "c")]


def test_tombstones_end_at_the_horizon(spark, tmp_path):
    batches = [
        [(1, "a", None, 1)], [(1, None, "D", 2)], [(2, "b", None, 20)],  # the watermark is the 15th
        [(1, "too late", None, 1), (3, "too late", None, 14), (4, "in time", None, 16), (2, "older", None, 3)],
    ]
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=1)
    stream = updates(spark, tmp_path, batches)
    ingest.stream_upsert(stream, table, ["at"], str(tmp_path / "progress"), "gone", horizon="5 days").awaitTermination()
    assert rows(table.read().select("id", "v")) == [(2, "b"), (4, "in time")]
    assert table.notes()["watermark"].startswith("2024-01-15")


def test_columns_of_a_stored_table_change(spark):
    """Add, drop, retype and add again over merges that touch one bucket or none."""
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=8)

    def merge(data, schema, how):
        table.merge(spark.createDataFrame(data, schema), schema_change=how)

    merge([(i, "a", i) for i in range(20)], "id int, v string, n int", "ignore")
    merge([(0, "b", 1.5)], "id int, v string, more double", "append_new_columns")
    assert table.read().dtypes == [("id", "int"), ("v", "string"), ("n", "int"), ("more", "double")]
    assert rows(table.read().where("id < 2")) == [(0, "b", None, 1.5), (1, "a", 1, None)]
    merge([(1, 7, "x")], "id int, N bigint, more string", "sync_all_columns")
    assert table.read().dtypes == [("id", "int"), ("N", "bigint"), ("more", "string")]
    assert rows(table.read().where("id < 3")) == [(0, None, "1.5"), (1, 7, "x"), (2, 2, None)]
    merge([(2, "new")], "id int, v string", "append_new_columns")  # the old v is gone for good
    assert rows(table.read().where("id < 4")) == [(0, None, "1.5", None), (1, 7, "x", None), (2, None, None, "new"), (3, 3, None, None)]
    merge([(3, 9, "cut")], "id int, N int, other string", "ignore")
    assert rows(table.read().where("id = 3")) == [(3, 9, None, None)]
    assert table.read().count() == 20
    with pytest.raises(ValueError, match="columns differ"):
        merge([(3, 9)], "id int, N int", "fail")
    with pytest.raises(ValueError, match="key columns"):
        merge([(3,)], "N int", "sync_all_columns")
    with pytest.raises(ValueError, match="schema_change"):
        merge([(3,)], "id int", "other")
    table.overwrite(spark.createDataFrame([(1, "z")], "id int, w string"))
    assert rows(table.read()) == [(1, "z")] and table.read().columns == ["id", "w"]


def feed_of(spark, changes_):
    return spark.createDataFrame(changes_, "id int, v string, _change_type string, _commit_version long, _commit_timestamp timestamp")


@pytest.mark.parametrize("lost", [None, "before", "after"])
def test_rows_and_load_state_are_one_commit(spark, monkeypatch, lost):
    """All five situations of an increment; a load is lost before its commit or right after."""
    day = datetime(2024, 1, 1)
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=2)
    versions = {
        1: ([(1, "a"), (2, "b")], []),
        3: ([(1, "A"), (3, "c")], [(1, "A", "update_postimage", 2, day), (3, "c", "insert", 3, day), (2, "b", "delete", 3, day)]),
    }

    def load(version, feed_enabled=True):
        data, feed = versions[version]
        source = spark.createDataFrame(data, "id int, v string")
        state = SourceState(version, feed_enabled=feed_enabled)
        return load_increment(table, "src", source, feed_of(spark, feed), state, delete_column="deleted_date")

    def tried(*args, **options):
        if lost:
            commit = table._commit

            def failing(*a, **k):
                if lost == "after":
                    commit(*a, **k)
                raise RuntimeError("killed")

            monkeypatch.setattr(table, "_commit", failing)
            with pytest.raises(RuntimeError, match="killed"):
                load(*args, **options)
            monkeypatch.undo()
        return load(*args, **options)

    assert table.loaded_version("src") is None
    assert tried(1) == 0 and table.loaded_version("src") == 1  # version unknown: all rows
    assert load(1) == 0  # nothing new
    assert tried(3) == 1 and table.loaded_version("src") == 3  # newer: changes only
    assert rows(table.read().select("id", "v")) == [(1, "A"), (3, "c")]
    with pytest.raises(SourceBehindTarget):
        load(1)
    assert load(3, feed_enabled=False) == 1  # no feed: the full read of a version that is in
    assert table.notes() == {"loaded": {"src": 3}} and rows(table.history().select("version")) == [(0,), (1,)]


def test_reading_only_buckets_of_keys(spark):
    table = SnapshotTable(spark, shared_dir(spark, "snap"), ["id"], buckets=16)
    table.merge(spark.range(1000).selectExpr("cast(id as int) as id", "id * 2 as v"))
    some = spark.createDataFrame([(5,), (6,), (-1,)], "id int")
    found = table.read_keys(some)
    assert found.where("id in (5, 6)").count() == 2 and found.count() < 300
    assert len(found.inputFiles()) < len(table.read().inputFiles())


def test_sales_load(spark):
    root = shared_dir(spark, "sales")
    sales.load_initial(spark, root, 2023, sales.Sizes(30, 6, 12, 25))
    sales.load_more(spark, root, 2024, sales.Sizes(10, 4, 5, 15))
    customer, category, product, order = (spark.read.parquet(p) for p in sales.paths(root).values())
    assert customer.select("customer_nr").distinct().count() == 40 and 40 < customer.count() < 70
    assert sales.last_business_key(order, "order_nr") == 1000040 and order.count() == 40
    assert category.where("parent_nr is null").count() == 1 and category.count() == 10
    parents = [r[0] for r in category.select("parent_nr").distinct().collect() if r[0]]
    assert product.where(F.col("product_category_nr").isin(parents)).count() == 0
    assert product.groupBy("product_nr", "modified_at").count().where("count > 1").count() == 0
    assert product.where("abs(price - priceWithoutVAT * 1.21) > 0.01").count() == 0
    flat = order.select("*", F.explode("order_details").alias("d"))
    sums = flat.groupBy("order_nr", "OrderTotalPayableAmount").agg(F.sum(F.expr("d.price * d.amount")).alias("s"))
    assert sums.where("s <> OrderTotalPayableAmount").count() == 0
    assert sales.last_business_key(order.where("false"), "order_nr") == 0
    batch = sales.order_batch(spark, root, 2024, 5, 1000041)
    assert batch.count() == 5 and batch.columns == order.columns


def test_order_details_are_drawn_once(spark):
    """No filter draws a time or a product again to see that it is not null."""
    details = sales.gen_order_details(sales.numbers(spark, 10), 2023, 1000010, 1000010)
    products = sales.gen_products(sales.numbers(spark, 10), 2023, spark.createDataFrame([("A1",)], "product_category_nr string"))
    versions = spark.createDataFrame(products.collect(), products.schema)
    plan = sales.price_details(details, versions)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" in plan and not [x for x in plan.split("\n") if "Filter" in x and "md5(" in x]


def test_prices_follow_the_order_time(spark):
    products = spark.createDataFrame([("P1", datetime(2023, 1, 1), 10), ("P1", datetime(2023, 6, 1), 20), ("P2", datetime(2023, 1, 1), 5)], "product_nr string, modified_at timestamp, p int")
    products = products.selectExpr("product_nr", "modified_at", "cast(p as decimal(18,2)) price", "cast(p as decimal(18,2)) priceWithoutVAT")
    details = spark.createDataFrame(
        [("O1", datetime(2023, 5, 31), "C1", "Cash", 1, "P1", 2), ("O1", datetime(2023, 5, 31), "C1", "Cash", 2, "P2", 1), ("O2", datetime(2023, 6, 1), "C1", "Cash", 1, "P1", 1), ("O3", datetime(2022, 1, 1), "C1", "Cash", 1, "P1", 1)],
        "order_nr string, ordered_at timestamp, customer_number string, payment_method string, order_detail_nr long, product_nr string, amount long",
    )
    for hot_rows in (None, 1):
        found = sales.build_orders(details, products, hot_rows)
        assert rows(found.selectExpr("order_nr", "cast(OrderTotalPayableAmount as int)", "OrderTotalAmount", "size(order_details)")) == [("O1", 25, 3, 2), ("O2", 20, 1, 1)]


def test_mutate_orders(spark):
    orders = io.scan_table(spark, "orders", SF).selectExpr(
        "o_orderkey order_nr", "o_custkey customer_number", "o_orderdate ordered_at", "md5(cast(o_orderkey as string)) hash_key"
    )
    sizes = {run: sales.mutate_orders(orders, run, 1997, 3).count() for run in ("first", "update", "insert", "update_insert", "do_nothing")}
    assert sizes["first"] == orders.count() and sizes["update"] == sizes["insert"] > 0
    assert sizes["update_insert"] == 2 * sizes["update"] and sizes["do_nothing"] == 0
    once, twice = (rows(sales.mutate_orders(orders, "insert", 1997, 3)) for _ in range(2))
    assert once == twice


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_alter_columns(spark):
    df = merge.alter_columns(spark.createDataFrame([(1, 2)], "a int, b int"), {"c": "decimal(10,2)"}, ["b"])
    assert df.dtypes == [("a", "int"), ("c", "decimal(10,2)")]
