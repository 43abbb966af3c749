import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import keys

STAMP = "2023-10-01 00:00:00.000"
# Input row (id, name, date, country) -> expected key.
GOLDEN = [
    ((1234, "abcdef", STAMP, "NL"), "7a9097f740fc1cc064fe8ecd322de78f"),
    ((1234, "abcdef ", STAMP, "NL"), "fa0009faca04052689bf3934a4e89530"),
    ((1234, "ABCDEF", STAMP, "NL"), "f66e02e75cc410e640cd7028950ea932"),
    ((1234, "abcdef", "2023-10-01 00:00:00", "NL"), "9588bcbdefcf4b6fe3e6d7d48df1924d"),
    ((1234, "abcdef", STAMP, None), "63df3eb6307634f5b20b3712b59bbdc7"),
    ((1234, "abcdef", None, "NL"), "072c0d7ae578e29ae83f490b4f5764a7"),
    ((1234, "Z&12$#A", STAMP, "NL"), "ae760ac420a9a055a2cd7e964e5ae278"),
    ((1234, None, STAMP, "NL"), "cddcfe4717ff8d9deb835872da0d7131"),
    ((None, "abcdef", STAMP, "NL"), "56a82bfbbb80dfe8b02ad2d4a36f55f8"),
    ((None, None, None, None), "577caa0f621ffaea57820ecb55fb94e5"),
]


def test_surrogate_key_golden(spark):
    df = spark.createDataFrame([g[0] for g in GOLDEN], "id int, name string, date string, country string")
    keyed = keys.with_surrogate_key(df, "unit_test_add_hash_key", ["id", "name", "date", "country"])
    found = {tuple(r)[:4]: r["unit_test_add_hash_key_sk"] for r in keyed.collect()}
    assert found == dict(GOLDEN)


def test_timestamp_in_a_key_prints_without_fraction(spark):
    df = spark.sql("select 1234 id, 'abcdef' name, timestamp'2023-10-01' date, 'NL' country")
    assert df.select(keys.surrogate_key(df.columns)).first()[0] == "9588bcbdefcf4b6fe3e6d7d48df1924d"


@pytest.mark.parametrize(
    "model, expected",
    [("euh__a", "a_sk"), ("cur__a", "a_sk"), ("dim__a", "a_sk"), ("fct__a", "a_sk"), ("eh__a", "a_sk"), ("raw__a", "raw__a_sk")],
)
def test_surrogate_key_name(model, expected):
    assert keys.surrogate_key_name(model) == expected


def test_row_checksum_default_is_lossy_and_options_are_not(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")], "p string, q string")
    lossy = [r[0] for r in df.select(keys.row_checksum(["p", "q"])).collect()]
    assert lossy[0] == lossy[1] and lossy[2] == lossy[3]
    exact = [r[0] for r in df.select(keys.row_checksum(["p", "q"], null_token="\\N", escape=True)).collect()]
    assert len(set(exact)) == 4


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1", "2", "3")], "`/BIC/ZCO_DOCNO` string, `1st` string, `a.b` string")
    one = df.select(keys.surrogate_key(["/BIC/ZCO_DOCNO", "1st", "a.b"]).alias("k"))
    two = spark.sql("select md5('1-2-3') k")
    assert rows(one) == rows(two)


def test_system_id_lookup(spark):
    df = spark.createDataFrame([("dev",), ("tst",), ("pre",), ("prd",), ("x",), (None,)], "e string")
    assert [r[0] for r in df.select(keys.system_id_lookup(F.col("e"))).collect()] == [
        "D80", "A80", "B80", "P80", "Unknown", "Unknown",
    ]


def test_source_id_has_no_blank_and_keeps_null(spark):
    df = spark.createDataFrame([("280",), (None,)], "client string")
    assert [r[0] for r in df.select(keys.source_id("D80", "client")).collect()] == ["D80_280", None]


def test_key_number(spark):
    df = spark.createDataFrame([("C1000001",), ("Cx",), (None,)], "k string")
    assert [r[0] for r in df.select(keys.key_number("k")).collect()] == [1000001, None, None]


def test_key_suffix_and_case_map(spark):
    df = spark.createDataFrame([("0001234",), ("12",)], "k string")
    assert [r[0] for r in df.select(keys.key_suffix("k")).collect()] == ["234", "12"]
    mapped = df.select(keys.case_map(F.col("k"), {"12": "twelve"}, F.lit("other")))
    assert [r[0] for r in mapped.collect()] == ["other", "twelve"]
    with pytest.raises(ValueError):
        keys.case_map(F.col("k"), {})
