"""Quality rules as a ledger of bits.

Every rule is evaluated once per text. The ledger keeps what was measured and one bit per
failed rule. A policy is a versioned mask of bits: applying it, comparing two versions, or
asking what one rule alone costs needs the bits only, not the texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import column

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
WINDOW = 5

# The rules, a bit each in this order.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 40 * n_words",
    "symbols": "2 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "no_letters": "2 * n_letters < word_chars",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
# Versioned policies: documents that fail any rule of the mask are dropped.
POLICIES = {
    "v1": BASE,
    "v2": BASE | BIT["word_length"] | BIT["no_letters"],
    "v3": BASE | BIT["word_length"] | BIT["no_letters"] | BIT["symbols"] | BIT["repeated_lines"],
}
CURRENT = "v3"


def measured(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct of measurements of the whole text; null texts have no words."""
    whole = F.coalesce(column(text), F.lit(""))
    words, lines = F.col("__tm_words"), F.col("__tm_lines")
    n = F.size(words)
    step = df.withColumn("__tm_words", F.regexp_extract_all(whole, F.lit(WORD), 0)).withColumn(
        "__tm_lines", F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    )
    # First by hashes: a text without two equal hashes has no repeated window. Only the
    # others are looked at by the words themselves.
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    suspect = F.when(n > WINDOW, F.size(F.array_distinct(hashes)) < n - (WINDOW - 1)).otherwise(F.lit(False))
    step = step.withColumn("__tm_suspect", suspect)
    windows = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("i")),
        )
    )
    step = step.withColumn("__tm_windows", F.when(F.col("__tm_suspect"), windows))
    near = F.col("__tm_windows")
    twice = F.array_sort(
        F.transform(
            F.filter(
                F.sequence(F.lit(0), F.size(near) - 1),
                lambda k: F.coalesce(F.get(near, k - 1)["w"] == F.get(near, k)["w"], F.lit(False))
                | F.coalesce(F.get(near, k + 1)["w"] == F.get(near, k)["w"], F.lit(False)),
            ),
            lambda k: F.get(near, k)["i"],
        )
    )
    step = step.withColumn("__tm_twice", F.when(F.col("__tm_suspect"), twice).otherwise(F.array().cast("array<int>")))
    starts = F.col("__tm_twice")
    # Words covered by those windows: each adds its five, less what the next one covers too.
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size(starts) - 1),
        F.lit(0).cast("long"),
        lambda acc, k: acc + F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - F.get(starts, k), F.lit(WINDOW))),
    )
    values = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.size(starts) > 0, covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"\p{L}+", ""))).cast("long").alias("n_letters"),
    )
    return step.withColumn(out, values).drop("__tm_words", "__tm_lines", "__tm_suspect", "__tm_windows", "__tm_twice")


def rule_ledger(df: DataFrame, text: str = "text", out: str = "ledger") -> DataFrame:
    """``df`` with a struct column ``out`` (an input column of that name is replaced).

    Its fields are the measurements (``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``n_lines``, ``n_letters``) and ``failed``, the bits
    of the failed rules. Null and empty texts have no words and fail ``few_words``. Repeated
    rows get a ledger each; an empty table gives an empty ledger.
    """
    rows = measured(df, text, "__tm_m")
    bits = [F.when(_rule(r), F.lit(BIT[name])).otherwise(F.lit(0)) for name, r in RULES.items()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return rows.withColumn(out, F.struct(F.col("__tm_m.*"), failed.cast("long").alias("failed"))).drop("__tm_m")


def _rule(condition: str) -> Column:
    for field in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters"):
        condition = condition.replace(field, f"__tm_m.{field}")
    return F.expr(condition)


def passes(failed: Column, policy: str | int = CURRENT) -> Column:
    """Whether no rule of the policy failed; a policy is a version or a mask of bits."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return failed.bitwiseAND(F.lit(mask)) == 0


def ablations(ledger: DataFrame, failed: Column, policies: Sequence[str] = tuple(POLICIES)) -> DataFrame:
    """Per policy and rule of it: documents in all, dropped by the policy, failing the rule,
    and failing the rule alone (what would come back without it).

    One pass: all counts are conditions on the bits, combined in the map tasks. Rows of an
    empty ledger are zero.
    """
    cells, sums = [], [F.count(F.lit(1)).alias("n")]
    for p in policies:
        mask = POLICIES[p]
        hit = failed.bitwiseAND(F.lit(mask))
        sums.append(F.count_if(hit != 0).alias(f"d_{p}"))
        for rule, bit in BIT.items():
            if mask & bit:
                sums += [
                    F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"f_{p}_{rule}"),
                    F.count_if(hit == bit).alias(f"o_{p}_{rule}"),
                ]
                cells.append((p, rule))
    counts = ledger.agg(*sums)
    rows = F.array(*[
        F.struct(
            F.lit(p).alias("policy"), F.lit(rule).alias("rule"), F.col("n").alias("n_documents"),
            F.col(f"d_{p}").alias("n_dropped"), F.col(f"f_{p}_{rule}").alias("n_failed"),
            F.col(f"o_{p}_{rule}").alias("n_only_this"),
        )
        for p, rule in cells
    ])
    return counts.select(F.inline(rows))


def oracle_sql() -> str:
    """Ledger and verdict of documents."""
    v = POLICIES[CURRENT]
    bits = " | ".join(f"(case when {r} then {BIT[name]} else 0 end)" for name, r in RULES.items() if v & BIT[name])
    return rf"""
    with texts as (
        select row_number() over () as row, doc_id, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
        from documents),
    windows as (
        select row, i, count(*) over (partition by row, win) as n
        from (select row, i, w[i:i+4] as win from (select row, w, unnest(range(1, len(w) - 3)) as i from texts))),
    repeated as (
        select row, cast(count(distinct i + k) as bigint) as n
        from windows, (select unnest(range(5)) as k) where n > 1 group by row),
    m as (
        select doc_id, cast(len(w) as bigint) as n_words,
            cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
            cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
            cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
            coalesce(repeated.n, 0) as n_repeat_words, len(l) as n_lines,
            length(t) - length(regexp_replace(t, '\p{{L}}+', '', 'g')) as n_letters
        from texts left join repeated using (row))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
        ({bits}) = 0 as kept
    from m
    """
