"""Secret scans: candidates found by shape, false findings removed by a random forest.

The forest sees how long a candidate is, how its characters change between kinds, how much of
it is made of dictionary words, where the file lies and which words stand around it. It is
trained from labelled findings, in the DataFrame API of Spark's own library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, either, stored, text_key
from tidemark.llm.url_filter import MAX_BLOCKS, URLS_PER_BLOCK, bloom_filter, may_contain

AROUND = 80
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 20, 5, 7

# Words that make up names and placeholders rather than keys, and words that
# announce a credential.
DICTIONARY = (
    "example test demo dummy sample placeholder changeme default foo bar abc xyz user name admin "
    "password passwd secret token key api auth access client server service account config value "
    "string number version release build file path image page index data table report order item "
    "the and for with from that this not are was der die und ein mit von den das les des une est "
    "que los las del por para con"
).split()
CREDENTIAL = ("token", "secret", "password", "passwd", "pwd", "api[_-]?key", "access[_-]?key", "secret[_-]?key", "auth", "credential", "bearer", "private[_-]?key")
# What stands right before a value that is given to the name of a credential.
_NAMED = r"(?:" + either(CREDENTIAL) + r"[0-9_]{0,3}[\"'`]?\s{0,3}(?:[=:]|:=|=>)\s{0,3}|bearer\s{1,3})"
# How that ends. It follows from _NAMED and is far cheaper to look back for, so it comes first.
_GIVEN = r"(?:[=:>]\s{0,3}|r\s{1,3})"
# Such a value, whatever it is made of: up to the closing quotation mark, or without one up to
# white space. Anywhere else at least twelve characters of keys and codes, one of them a digit;
# '=' is part of them only as padding at the end.
CANDIDATE = (
    rf"(?i:(?<=[\"'`])(?<={_GIVEN}[\"'`])(?<={_NAMED}[\"'`]))[^\"'`\n]+(?=[\"'`])"
    rf"|(?i:(?<=[=:>\s\"'`])(?<={_GIVEN}[\"'`]?)(?<={_NAMED}[\"'`]?))(?![=:])[^\s\"'`,;&<>]*[^\s\"'`,;&<>.):]"
    r"|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=\-\"'`]))?"
)
# Keys that are known by their own shape.
KNOWN = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_\-]{20,}"
    r"|xox[abeoprs]-[A-Za-z0-9\-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_\-]{20,}|AIza[A-Za-z0-9_\-]{35}"
    r"|npm_[A-Za-z0-9]{36}|eyJ[A-Za-z0-9_\-]{10,})"
)
HARMLESS = ("sha1?", "sha256", "md5", "hash", "checksum", "commit", "uuid", "guid", "id", "phone", "tel", "order", "invoice", "isbn", "card")
TEST_PATH = ("test", "tests", "spec", "example", "examples", "fixture", "fixtures", "mock", "sample", "docs?")

FEATURES = (
    "f_length", "f_digits", "f_letter_digit", "f_case", "f_symbol", "f_distinct", "f_hex", "f_dictionary",
    "f_path_test", "f_path_depth", "f_announced", "f_assigned", "f_quoted", "f_harmless", "f_words_after", "f_known",
)


def candidates(df: DataFrame, text: str = "text", path: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per candidate: the ``keep`` columns, ``row`` (a number of the row of ``df``),
    ``nr`` within it, ``start`` (characters before it), ``candidate``, ``before`` and ``after``
    (80 characters, before it at most back to the second candidate before), ``path``.

    Null and empty texts have none. Each repeated row has its own candidates.
    """
    whole = F.coalesce(column(text), F.lit(""))
    found = df.select(
        *[column(k) for k in keep], F.monotonically_increasing_id().alias("row"),
        (F.lit(None).cast("string") if path is None else column(path).cast("string")).alias("path"),
        F.regexp_extract_all(whole, F.lit(CANDIDATE), 0).alias("found"), whole.alias("whole"),
    ).where(F.size("found") > 0)
    found = found.withColumn("between", F.split("whole", CANDIDATE, -1)).drop("whole")
    each = found.select(
        *[column(k) for k in keep], "row", "path",
        F.posexplode_outer(F.transform("found", lambda c, i: F.struct(
            c.alias("candidate"), F.length(F.get("between", i)).alias("gap"),
            F.right(F.concat(
                F.coalesce(F.get("between", i - 1), F.lit("")), F.coalesce(F.get("found", i - 1), F.lit("")), F.get("between", i),
            ), F.lit(AROUND)).alias("before"),
            F.substring(F.get("between", i + 1), 1, AROUND).alias("after"),
        ))).alias("nr", "c"),
    ).select(*[column(k) for k in keep], "row", "path", "nr", "c.*")
    # A row holds what one text holds, so sums within it are bounded by the text.
    so_far = Window.partitionBy("row").orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("gap") + F.length("candidate")).over(so_far), F.lit(0))
    return each.withColumn("start", (earlier + F.col("gap")).cast("long")).drop("gap")


def features(found: DataFrame) -> DataFrame:
    """``found`` with the columns FEATURES, all doubles and never null."""
    c, before, after = F.col("candidate"), F.lower("before"), F.lower("after")
    n = F.length(c)
    folder = F.lower(F.coalesce("path", F.lit("")))

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    words = either(sorted(DICTIONARY, key=len, reverse=True))
    values = {
        "f_length": n,
        "f_digits": share("[0-9]"),
        "f_letter_digit": share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "f_case": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "f_symbol": share(r"[+/_=\-]"),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "f_hex": F.lower(c).rlike("^[0-9a-f]+$"),
        "f_dictionary": (n - F.length(F.regexp_replace(F.lower(c), words, ""))) / n,
        "f_path_test": folder.rlike(r"(^|[/._-])" + either(TEST_PATH) + r"([/._-]|$)"),
        "f_path_depth": F.length(folder) - F.length(F.translate(folder, "/", "")),
        "f_announced": before.rlike(either(CREDENTIAL) + r"[^a-z\n]{0,6}$") | before.rlike(_NAMED + r"[\"'`]?$"),
        "f_assigned": before.rlike(r"[=:]\s*[\"'`]?$"),
        "f_quoted": before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]"),
        "f_harmless": before.rlike(r"(^|[^a-z])" + either(HARMLESS) + r"[^a-z\n]{0,6}$"),
        "f_words_after": F.regexp_count(after, F.lit(r"[\p{L}]+")),
        "f_known": c.rlike(KNOWN),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()})


def train(labelled: DataFrame, label: str = "label", max_labelled: int = MAX_LABELLED):
    """A forest fitted on at most ``max_labelled`` rows of ``labelled`` (candidates with their
    features and a label 0 or 1); None if one of the labels is missing. Those labelled 1 make
    up half of them at most, those labelled 0 the rest; either are drawn by hash.

    Rows without a label are left out, repeated findings count once per text and place.
    """
    drawn = labelled.where(column(label).isNotNull()).select(*FEATURES, column(label).cast("double").alias("label"), "candidate", "before")
    order = F.xxhash64("candidate", "before")
    secret = stored(drawn.where("label = 1").orderBy(order, "candidate").limit(max_labelled // 2), "findings")
    n = secret.count()
    harmless = stored(drawn.where("label = 0").orderBy(order, "candidate").limit(max_labelled - n), "findings")
    if not n or harmless.isEmpty():
        return None
    drawn = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(secret.unionByName(harmless))
    drawn = stored(drawn.select("features", "label"), "findings")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False)
    return forest.fit(drawn)


def judge(found: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """``found`` (with its features) with ``score`` and ``is_secret``. Without a model
    those that ``plain_label`` labels 1 are secrets, with score 1, and all others score 0."""
    if model is None:
        sure = F.coalesce(plain_label(found) == 1, F.lit(False))
        return found.withColumns({"score": sure.cast("double"), "is_secret": sure}).drop(*FEATURES)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    scored = model.transform(vectors).withColumn("score", F.get(vector_to_array("probability"), 1))
    return scored.drop(*FEATURES, "features", "rawPrediction", "probability", "prediction").withColumn(
        "is_secret", F.col("score") >= threshold
    )


def plain_label(found: DataFrame) -> Column:
    """Labels for tables without labelled findings: 1 for a key of a well-known shape and for
    a long value that is assigned to the name of a credential, 0 for what no such name
    announces; null in between."""
    announced, assigned = F.col("f_announced") > 0, F.col("f_assigned") > 0
    sure = (F.col("f_known") > 0) | announced & assigned & (F.col("f_length") >= 20)
    return F.when(sure, 1).when(~announced, 0)


def _judged(found: DataFrame, labelled: DataFrame | None) -> DataFrame:
    """``found`` as a forest judges it that ``labelled`` trained. Without that, plain labels
    train it, and a key of a well-known shape is a secret for certain."""
    if labelled is not None:
        return judge(found, train(labelled))
    known = found.withColumn("known", F.col("f_known") > 0)
    judged = judge(known, train(found.withColumn("label", plain_label(found))))
    score = F.when(F.col("known"), F.lit(1.0)).otherwise(F.col("score"))
    return judged.withColumns({"score": score, "is_secret": F.col("known") | F.col("is_secret")}).drop("known")


def scan_secrets(
    df: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text: str = "text", path: str | None = "source"
) -> DataFrame:
    """One row per candidate: the id, ``start``, ``length``, ``candidate``, ``score``,
    ``is_secret``.

    ``labelled`` has columns FEATURES, candidate, before and label (see ``candidates`` and
    ``features``); without it candidates are labelled by ``plain_label``. Null and empty
    texts, and an empty table, give no rows; null ids stay null.
    """
    found = stored(features(candidates(df.select(column(id_column).alias("id"), column(text).alias("text"), *(
        [column(path).alias("where")] if path else [])), "text", "where" if path else None, ["id"])), "candidates")
    return _judged(found, labelled).select(
        F.col("id").alias(id_column), "start", F.length("candidate").cast("long").alias("length"), "candidate", "score", "is_secret"
    )


def redact_secrets(
    df: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str | None = "source", mark: str = "<SECRET>"
) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``, all rows and columns kept.

    A string judged a secret in one place of a text is replaced wherever it stands in that
    text; one without a digit or of fewer than twelve characters only behind its name. Texts without secrets are passed on as they are. Null texts stay null; equal
    texts are treated alike.
    """
    rows = df.withColumn("__key", text_key(column(text)))
    found = stored(features(candidates(
        df.select(column(text).alias("text"), *([column(path).alias("where")] if path else []),
                  text_key(column(text)).alias("key")),
        "text", "where" if path else None, ["key"])), "candidates")
    # Common strings are secrets only where they are given to a name, so they go with it.
    common = (F.length("candidate") < 12) | ~F.col("candidate").rlike("[0-9]")
    name = F.when(common, F.regexp_extract("before", r"(?i)" + _NAMED + r"[\"'`]?$", 0)).otherwise(F.lit(""))
    given = F.struct(name.alias("name"), F.col("candidate").alias("value"))
    secrets = _judged(found, labelled).where("is_secret").groupBy("key").agg(F.collect_set(given).alias("__secrets"))
    # Longer ones first, so that none is torn by a shorter one inside it.
    ordered = F.array_sort(F.col("__secrets"), lambda a, b: F.length(b["value"]) - F.length(a["value"]))
    secrets = stored(secrets.select(F.col("key").alias("__key"), ordered.alias("__secrets")), "secrets")
    # Few texts hold a secret; a Bloom filter of their keys passes all others on unread.
    blocks = max(1, min(MAX_BLOCKS, -(-secrets.count() // URLS_PER_BLOCK)))
    marked = may_contain(rows, "__key", bloom_filter(secrets, "__key", blocks), blocks, "__maybe")
    joined = marked.where("__maybe").join(secrets, "__key", "left")
    cleaned = F.aggregate("__secrets", column(text), lambda t, s: F.replace(
        t, F.concat(s["name"], s["value"]), F.concat(s["name"], F.lit(mark))))
    cleaned = joined.withColumn(text, F.coalesce(cleaned, column(text)))
    columns = [column(c) for c in df.columns]
    return cleaned.select(*columns).unionByName(marked.where("not __maybe").select(*columns))
