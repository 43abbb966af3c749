import odd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
import corpus_pipeline as P
from conftest import SF


def test_run(spark):
    got = P.run(spark, SF).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {r.doc_id for r in got}
    assert ids < docs and len(ids) > 0.8 * len(docs)
    assert entries.queries()["pipeline"] is P.run


def test_operators_are_registered():
    names = [k for k in entries.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    docs = odd.documents(spark, odd.TEXTS, extra=False)
    docs = docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    out = stage(spark, docs, SF)
    if name != "best_fit_packing":
        assert out.columns == docs.columns
        assert out.count() <= docs.count()
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_decisions_take_effect(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    docs = odd.documents(spark, [item, "clean words stand here", f'token = "{key}" and words', "12 34"], extra=False)
    assert {r.doc_id for r in P.decontaminate(spark, docs, SF).collect()} == {1, 2, 3}
    assert key not in {r.doc_id: r.text for r in P.redact(spark, docs, SF).collect()}[2]
    assert 3 not in {r.doc_id for r in P.language(spark, docs, SF).collect()}
