import odd  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import url_filter as U

RULES = (U.Rule("allow", "org", "/"), U.Rule("block", "example.org", "/es/"), U.Rule("block", "com", "/de/"))
URLS = [
    "http://Example.ORG/es/1", "http://a.example.org/en", "https://x.com/de/?q=1", "https://x.com/fr/a.html?utm_source=b&z=2&a=1#top",
    "http://www.x.com/fr/a?a=1&z=2", None, "", "no scheme", "http://", "http://badorg/", "://x", "http://user@y.com:80/p/", "http://y.com/p",
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string").withColumn("filter", F.lit(0))


def test_verdicts(spark):
    listed = spark.createDataFrame([("https://m.x.com/fr/a/?z=2&a=1&ref=me",), ("http://y.com/p#x",), (None,), ("junk",), ("http://y.com/p",)], "url string")
    got = {r.page_id: (r.filter.host, r.filter.path, r.filter.rule, r.filter.verdict) for r in U.filter_urls(frame(spark, URLS), listed, RULES).collect()}
    assert got[0] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("a.example.org", "/en", None, "allow") or got[1] == ("a.example.org", "/en", "org/", "allow")
    assert got[1][2] == "org/"
    assert got[2] == ("x.com", "/de/", "com/de/", "block")
    assert got[3] == ("x.com", "/fr/a.html", None, "block") and got[4][3] == "block"
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("", "", None, "allow") and got[9][2] is None
    assert got[11][3] == got[12][3] == "block"
    assert len(got) == len(URLS)


def test_empty_list_and_table(spark):
    none = spark.createDataFrame([], "url string")
    assert {r.filter.verdict for r in U.filter_urls(frame(spark, URLS[:5]), none).collect()} == {"allow"}
    assert U.filter_urls(frame(spark, URLS).limit(0), none, RULES).count() == 0


def test_filter_never_misses(spark):
    """Whatever the size of the filter: nothing listed is lost, nothing else is marked."""
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    listed = keys.where("cast(substr(k, 2) as int) % 3 = 0")
    for blocks in (1, 7, 200):
        bloom = U.bloom_filter(listed, "k", blocks)
        maybe = U.may_contain(keys, "k", bloom, blocks, "m").where("m")
        assert listed.join(maybe, "k", "left_anti").count() == 0
        if blocks == 200:
            assert maybe.count() < 1100
    marked = U.listed_marks(keys.union(keys), "k", listed.union(listed), "k", "is_listed")
    assert marked.where("is_listed").count() == 2000 and marked.count() == 6000
