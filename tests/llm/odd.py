"""Small tables with every odd case: nulls, empty and long texts, repeats, clashing names."""

LONG = "the quick brown fox jumps over the lazy dog again and again until nobody counts " * 1500


def documents(spark, texts, extra=True):
    """doc_id, text, lang, source, n_chars and columns named like the operators' own."""
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F

        for name in ("words", "labels", "score", "ledger", "fp", "component", "part", "row", "id", "node", "t", "raw", "h"):
            df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return documents(spark, [None]).limit(0)


TEXTS = [None, "", "   ", "\n\n", "a", "Licensed under the Apache License, Version 2.0.", LONG, "same text here", "same text here",
         "¿Qué? ñandú — ünïcödé 日本語 🙂", "1234 5678", "!!! ??? ###"]
