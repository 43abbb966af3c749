import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources import tables as io
from tidemark.sources.landing import BATCH, LandingLedger

SCHEMA = "id int"


def ledger(spark, folder, at, **options):
    return LandingLedger(spark, str(folder), str(at), SCHEMA, **options)


def ids(df):
    return [r[0] for r in rows(df.select("id"))]


def test_each_file_once_until_it_is_confirmed(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    book = ledger(spark, folder, tmp_path / "book")
    assert book.pending().count() == 0
    assert ids(io.scan_json_new_files(spark, str(folder), book)) == [1, 2]
    assert ids(io.scan_json_new_files(spark, str(folder), book)) == [1, 2]  # not confirmed: still pending
    book.confirm()
    (folder / "b.json").write_text('{"id": 3}\n')
    (folder / "empty.json").write_text("")
    again = ledger(spark, folder, tmp_path / "book")  # another session, the same ledger
    new = io.scan_json_new_files(spark, str(folder), again)
    assert ids(new) == [3] and new.columns == ["id", "file_path"] and new.first()["file_path"].endswith("/b.json")
    again.confirm()
    assert again.discover() == 0 and again.pending().count() == 0 and again.pending().columns == ["id", "file_path", BATCH]


def test_batches_are_bounded_and_confirmed_apart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.json").write_text(f'{{"id": {i}}}\n')
    book = ledger(spark, folder, tmp_path / "book", max_files=2)
    assert book.discover() == 3
    assert [r["n"] for r in book.pending().groupBy(BATCH).agg(F.count("*").alias("n")).orderBy(BATCH).collect()] == [2, 2, 1]
    book.confirm(0)
    assert book.pending().count() == 3


def test_newest_files_first(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.json").write_text(f'{{"id": {i}}}\n')
        os.utime(folder / f"{i}.json", (1000 + i, 1000 + i))
    book = ledger(spark, folder, tmp_path / "book", max_files=1, latest_first=True)
    book.discover()
    assert [r["id"] for r in book.pending().orderBy(BATCH).collect()] == [2, 1, 0]


def test_a_lost_batch_is_repeated_alike(spark, tmp_path, monkeypatch):
    """Fails after the rows of a batch are staged and before the stream knows it."""
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(4):
        (folder / f"{i}.json").write_text(f'{{"id": {i}}}\n')
    book = ledger(spark, folder, tmp_path / "book", max_files=2)
    note = book._note
    monkeypatch.setattr(book, "_note", lambda batch, confirmed: 1 / 0 if batch == 1 else note(batch, confirmed))
    with pytest.raises(Exception):
        book.discover()
    monkeypatch.undo()
    (folder / "late.json").write_text('{"id": 9}\n')
    assert len(ids(book.pending())) == 2  # the first batch only
    book.discover()
    assert ids(book.pending()) == [0, 1, 2, 3, 9]


def test_many_files(spark, tmp_path):
    """No path passes through this process; the second call opens one file. The number of
    files is set by LANDING_FILES; 100000 take some minutes."""
    folder = tmp_path / "in"
    folder.mkdir()
    n = int(os.environ.get("LANDING_FILES", 3000))
    for i in range(n):
        (folder / f"{i}.json").write_bytes(b'{"id":%d}' % i)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "16k")
    try:
        book = ledger(spark, folder, shared_dir(spark, "book"), max_files=n // 2)
        assert book.discover() == 2
        found = book.pending().agg(F.count("id"), F.countDistinct("id"), F.countDistinct("file_path"), F.sum("id")).first()
        assert tuple(found) == (n, n, n, n * (n - 1) // 2)
        book.confirm()
        (folder / "new.json").write_text('{"id": -1}')
        assert book.discover() == 1 and ids(book.pending()) == [-1]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
