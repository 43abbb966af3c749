"""One query per operator over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, divergence, importance, langid, licenses, neighbours, packing, quality, secrets, simhash, toxicity, url_filter
from tidemark.llm.base import LOWER, ORACLES, QUERIES, UPPER, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("op1_license_scan", licenses.oracle_sql())
def license_scan(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(documents)
    fields = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *[F.col(f"licenses.{f}") for f in fields])


@query("op2_secret_scan")
def secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, directory, "documents"))


# Rules of the query, and hosts whose pages make its list of blocked addresses.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
SPAM_HOST = r"(^|[.-])(casino|bets|pills)([.-]|$)"
_HOST = "case when contains(coalesce(url, ''), '://') then translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), '{u}', '{l}') else '' end".format(u=UPPER, l=LOWER)
_PATH = "case when contains(coalesce(url, ''), '://') then regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) else '' end"
_RULES = ", ".join(f"('{r}', '{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
OP3_SQL = f"""
    with parsed as (select row_number() over () as row, page_id, url, {_HOST} as host, {_PATH} as path from pages),
    forms as (
        select *, case when contains(url, '://') then
            regexp_replace(regexp_replace(host, '^[^@]*@|:\\d*$', '', 'g'), '^((www|m)\\.)+', '')
            || regexp_replace(path, '(/|/index\\.html?|\\.html?)$', '')
            || coalesce('?' || nullif(array_to_string(list_sort(list_filter(
                string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
                lambda x: x <> '' and not regexp_matches(x, '{url_filter.TRACKING}'))), '&'), ''), '') end as canonical
        from parsed),
    listed as (select distinct canonical from forms where regexp_matches(host, '{SPAM_HOST}')),
    rules(rule, verdict, rule_host, rule_path) as (values {_RULES}),
    fitting as (
        select row, rule, verdict from forms join rules
            on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        qualify row_number() over (partition by row order by length(rule) desc, rule) = 1)
    select page_id, host, path, rule,
        coalesce(verdict, case when canonical in (select canonical from listed where canonical is not null) then 'block' else 'allow' end) as verdict
    from forms left join fitting using (row)
"""


@query("op3_url_filter", OP3_SQL)
def url_filter_query(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(SPAM_HOST)).select("url")
    judged = url_filter.filter_urls(pages, listed, URL_RULES)
    return judged.select("page_id", *[F.col(f"filter.{f}") for f in ("host", "path", "rule", "verdict")])


def remainder(by: int):
    """crc32 of the document id as text, modulo ``by``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % by, F.lit(-1))


@query("op4_toxicity_cnn")
def toxicity_cnn(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").select("doc_id", "text")
    labels = table(spark, directory, "labels").select("doc_id", "toxic").where(remainder(4) != 2)
    model = toxicity.fit(documents, labels)
    scored = documents.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), toxicity.score_toxicity(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.DECISION).cast("int"))


@query("op5_language_crf")
def language_crf(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").select("doc_id", "text", "lang")
    model = langid.fit(documents.where(remainder(3) != 1))
    found = langid.identify(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.size("language.spans").alias("n_spans"),
    )


@query("op6_quotation_linking")
def quotation_linking(spark: SparkSession, directory: str) -> DataFrame:
    return chat.link_quotes(table(spark, directory, "conversations"))


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special_as_text=False)


@query("op8_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, directory, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op9_quality_rules", quality.oracle_sql())
def quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").select("doc_id", "text")
    ledger = quality.rule_ledger(documents)
    base = F.col("ledger.failed").bitwiseAND(F.lit(quality.BASE)) != 0
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return ledger.select(
        "doc_id", *[F.col(f"ledger.{f}") for f in fields], base.alias("base_failed"),
        (~base & quality.passes(F.col("ledger.failed"))).alias("kept"),
    )


@query("op10_template_decontamination")
def template_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").select("doc_id", "text")
    return decontamination.find_leaks(documents, table(spark, directory, "benchmark"))


@query("op12_source_divergence", divergence.oracle_sql())
def source_divergence(spark: SparkSession, directory: str) -> DataFrame:
    return divergence.source_divergence(table(spark, directory, "documents"))


@query("op13_importance_resampling", importance.oracle_sql())
def importance_resampling(spark: SparkSession, directory: str) -> DataFrame:
    return importance.resample(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


@query("op11_pruned_graph_search")
def pruned_graph_search(spark: SparkSession, directory: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, directory, "embeddings"))
