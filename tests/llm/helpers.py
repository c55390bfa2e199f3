"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, extra=()):
    """Rows of (doc_id, text) as a documents table, with further columns named like results if asked for."""
    made = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    for name in extra:
        from pyspark.sql import functions as F

        made = made.withColumn(name, F.lit("own"))
    return made


def awkward(spark, extra=()):
    """NULLs, empty and blank texts, repeated rows, a repeated id, a very long text."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [
        (1, "One plain line of words here.\nAnother line."),
        (1, "One plain line of words here.\nAnother line."),
        (1, "The same id with another text."),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (None, "A row without an id, but with some words."),
        (None, None),
        (5, long),
        (6, "x" * 100_000),
    ]
    return documents(spark, rows, extra)
