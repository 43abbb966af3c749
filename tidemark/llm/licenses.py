"""License scans by a positional index of rare words.

Every licence is a template: the words of its notice, and key phrases that must stand in a
file word by word. How rare a licence word is, is counted over all files. In a file, the two
rarest words of each phrase are looked up; what their places say about where the phrase
begins is intersected, and only there the phrase itself is compared. A phrase contains its
rare words, so no place of it is missed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import ascii_lower, column, strings

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence: label, notice as it is usually written, key phrases (all must be found).

    ``base`` phrases are those whose places are counted by ``n_base``.
    """

    label: str
    notice: str
    phrases: tuple[str, ...]
    base: bool = False


# Usual notices of public licences.
TEMPLATES = (
    Template("mit", "released under the mit license", ("under the mit license",), True),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",), True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",), True),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("permission is hereby granted free of charge", "obtaining a copy of this software"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("copy modify and or distribute this software", "with or without fee is hereby granted"),
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), 0)


def rarity(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of the vocabulary over all rows of ``words.__words``.

    One row per word comes to the driver; the vocabulary is that of the templates.
    """
    found = words.select(F.explode(F.array_intersect("__words", strings(vocabulary))).alias("w"))
    counts = dict(found.groupBy("w").count().collect())
    return {w: 1.0 / (1 + counts.get(w, 0)) for w in vocabulary}


def scan_licenses(
    df: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES, out: str = "licenses"
) -> DataFrame:
    """``df`` with a struct column ``out`` (an input column of that name is replaced).

    Fields: ``n_words``; ``n_base``, ``first_word``, ``last_word`` number of all places of
    base phrases, their smallest and largest first word (null if there are none);
    ``base_labels`` and ``labels``, sorted and comma-joined ('' if there are none);
    ``score``, the largest share of a found licence's notice that stands in place around its
    phrase (0 if there is none); ``places`` array of (label, phrase, start).

    Null and empty texts have no words. Repeated rows are scanned each for itself. The text
    is read twice: once to count how rare the licence words are, once to scan.
    """
    phrases = [(t, i, p.split()) for t in templates for i, p in enumerate(t.phrases)]
    vocabulary = sorted({w for _, _, p in phrases for w in p})
    idf = rarity(df.select(words_of(column(text)).alias("__words")), vocabulary)
    # The two rarest words of each phrase, the rarest first.
    anchors = [sorted(dict.fromkeys(p), key=lambda w: (-idf[w], p.index(w)))[:2] for _, _, p in phrases]
    seldom = sorted({a[0] for a in anchors})
    looked_up = sorted({w for a in anchors for w in a})

    words = F.col("__tm_words")
    hits = F.when(
        F.arrays_overlap(words, strings(seldom)),
        F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: F.array_contains(strings(looked_up), F.get(words, i)),
        ),
    ).otherwise(F.array().cast("array<int>"))
    scanned = df.withColumn("__tm_words", words_of(column(text))).withColumn("__tm_hits", hits)

    def starts(word: str, offset: int) -> Column:
        at = F.filter(F.col("__tm_hits"), lambda i: F.get(words, i) == F.lit(word))
        return F.transform(at, lambda i: i - F.lit(offset))

    def places(number: int) -> Column:
        template, index, phrase = phrases[number]
        common = F.array_distinct(starts(anchors[number][0], phrase.index(anchors[number][0])))
        for w in anchors[number][1:]:
            common = F.array_intersect(common, starts(w, phrase.index(w)))
        there = F.filter(
            common,
            lambda s: (s >= 0) & (F.slice(words, F.greatest(s, F.lit(0)) + 1, len(phrase)) == strings(phrase)),
        )
        notice = template.notice.split()
        before = next((i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase), 0)

        def share(s: Column) -> Column:
            same = [F.coalesce((F.get(words, s + (j - before)) == F.lit(w)).cast("int"), F.lit(0)) for j, w in enumerate(notice)]
            return sum(same[1:], same[0]) / F.lit(float(len(notice)))

        return F.transform(
            there,
            lambda s: F.struct(
                F.lit(template.label).alias("label"),
                F.lit(template.phrases[index]).alias("phrase"),
                s.cast("long").alias("start"),
                share(s).alias("share"),
                F.lit(template.base).alias("base"),
                F.lit(templates.index(template)).alias("template"),
            ),
        )

    found = F.when(
        F.size("__tm_hits") > 0, F.concat(*[places(n) for n in range(len(phrases))])
    ).otherwise(F.array().cast(_PLACES))
    scanned = scanned.withColumn("__tm_found", found)

    needed = {i: len(t.phrases) for i, t in enumerate(templates)}
    whole = F.filter(
        F.col("__tm_found"),
        lambda x: _per_template(x, needed),
    )
    base = F.filter(F.col("__tm_found"), lambda x: x["base"])
    scanned = scanned.withColumn("__tm_whole", whole).withColumn("__tm_base", base)
    result = F.struct(
        F.size("__tm_words").cast("long").alias("n_words"),
        F.size("__tm_base").cast("long").alias("n_base"),
        F.array_min(F.transform("__tm_base", lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform("__tm_base", lambda x: x["start"])).alias("last_word"),
        _joined("__tm_base").alias("base_labels"),
        _joined("__tm_whole").alias("labels"),
        F.coalesce(F.array_max(F.transform("__tm_whole", lambda x: x["share"])), F.lit(0.0)).alias("score"),
        F.transform(
            "__tm_whole", lambda x: F.struct(x["label"].alias("label"), x["phrase"].alias("phrase"), x["start"].alias("start"))
        ).alias("places"),
    )
    return scanned.withColumn(out, result).drop("__tm_words", "__tm_hits", "__tm_found", "__tm_whole", "__tm_base")


_PLACES = "array<struct<label:string,phrase:string,start:bigint,share:double,base:boolean,template:int>>"


def _joined(places: str) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")


def _per_template(place: Column, needed: dict[int, int]) -> Column:
    """Whether all key phrases of the place's template are in the file."""
    same = F.filter(F.col("__tm_found"), lambda y: y["template"] == place["template"])
    kinds = F.size(F.array_distinct(F.transform(same, lambda y: y["phrase"])))
    wanted = F.element_at(F.array(*[F.lit(needed[i]) for i in sorted(needed)]), place["template"] + 1)
    return kinds >= wanted


def oracle_sql(templates: Sequence[Template] = TEMPLATES) -> str:
    """The same columns for documents, by comparing every phrase at every word."""
    phrases = []
    for t in templates:
        for p in t.phrases:
            phrase, notice = p.split(), t.notice.split()
            before = next((i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase), 0)
            phrases.append((t, p, phrase, notice, before))
    parts = []
    for i, (t, p, phrase, notice, before) in enumerate(phrases):
        match = " and ".join(f"w[s + {j + 1}] = '{x}'" for j, x in enumerate(phrase))
        share = " + ".join(
            f"coalesce(cast(case when s + {j - before} >= 0 then w[s + {j - before + 1}] = '{x}' end as int), 0)"
            for j, x in enumerate(notice)
        )
        parts.append(
            f"select row, {templates.index(t)} as template, '{t.label}' as label, '{p}' as phrase, {str(t.base).lower()} as base,"
            f" s, ({share}) / cast({len(notice)} as double) as share from spots where {match}"
        )
    needed = ", ".join(f"({i}, {len(t.phrases)})" for i, t in enumerate(templates))
    return f"""
    with texts as (
        select row_number() over () as row, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER_SQL}', '{LOWER_SQL}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
        from documents),
    spots as (select row, w, unnest(range(len(w))) as s from texts),
    found as ({' union all '.join(parts)}),
    needed(template, n) as (values {needed}),
    whole as (
        select f.* from found f join needed using (template)
        where n = (select count(distinct g.phrase) from found g where g.row = f.row and g.template = f.template)),
    base as (
        select row, count(*) as n_base, min(s) as first_word, max(s) as last_word,
            string_agg(distinct label, ',' order by label) as base_labels
        from found where base group by row),
    labelled as (
        select row, string_agg(distinct label, ',' order by label) as labels, max(share) as score
        from whole group by row)
    select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
        coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
    from texts left join base using (row) left join labelled using (row)
    """


UPPER_SQL, LOWER_SQL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
