import odd
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import licenses
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op1_license_scan", "op3_url_filter", "op9_quality_rules"])
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None


def scan(spark, texts):
    df = odd.documents(spark, texts)
    found = licenses.scan_licenses(df)
    assert set(found.columns) == {*df.columns, "licenses"}
    return {r.doc_id: r.licenses for r in found.collect()}


def test_places_and_labels(spark):
    got = scan(spark, [
        "Released under the MIT License. Later: UNDER THE MIT-LICENSE",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "under the mit", None, "", odd.LONG + " under the MIT license",
        "Permission is hereby granted, free of charge, to any person", "mit mit mit license under the the mit license",
    ])
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word) == (10, 2, 1, 6)
    assert got[0].base_labels == got[0].labels == "mit" and got[0].score == 1.0
    assert (got[1].labels, got[1].first_word) == ("cc-by-nc", 2)
    assert (got[2].base_labels, got[2].labels, got[2].n_base, got[2].first_word) == ("", "gpl-3", 0, None)
    assert got[3].labels == "" and got[3].score == 0.0
    assert got[4].n_words == got[5].n_words == 0 and got[4].labels == ""
    assert got[6].n_base == 1 and got[6].first_word == len(odd.LONG.split())
    assert got[7].labels == ""  # one of two key phrases is missing
    assert got[8].n_base == 0


def test_odd_texts(spark):
    got = scan(spark, odd.TEXTS)
    assert len(got) == len(odd.TEXTS) and got[7] == got[8]
    assert licenses.scan_licenses(odd.empty(spark)).count() == 0


def test_replaces_clashing_column(spark):
    df = odd.documents(spark, ["cc by nc"]).withColumn("licenses", F.lit(1))
    assert licenses.scan_licenses(df).first().licenses.labels == "cc-by-nc"
