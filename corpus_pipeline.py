"""A corpus pipeline: language, near copies, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns to the shared folder and hands it on, so a lost executor costs tasks of one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, langid, packing, secrets, simhash
from tidemark.llm.base import stored, table, text_key

# A text in which no language has this share of the words is rejected.
LEAST_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter and mere mixtures go.

    Null and empty texts go; long ones are judged whole. Equal texts are decided alike.
    """
    judged = langid.identify(docs, langid.fit(docs), out="__language")
    known = (F.col("__language.lang") != langid.UNKNOWN) & (F.col("__language.score") >= LEAST_SHARE)
    return judged.where(known).drop("__language")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, the one with the smallest id.

    Null texts count as empty; empty texts are copies of each other. Of documents that share
    text and id any one stays.
    """
    return simhash.drop_near_copies(docs, from_files=simhash.known_by_place(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; equal texts are decided together.

    Null and empty texts hold none and stay, whatever their id; long ones are searched whole.
    """
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    leaks = decontamination.find_leaks(keyed, table(spark, sf_dir, "benchmark"), keys=("__key",))
    leaks = stored(leaks.select("__key"), "leaks")
    return keyed.join(leaks, "__key", "left_anti").drop("__key")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark. Null and empty texts stay as they are."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; null and empty texts are a
    piece of one token, repeated rows are packed each for itself."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), special_as_text=False)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", redact),
    ("best_fit_packing", pack),
]

# Trained models and tokens: no SQL says what comes out. tests/llm holds the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
