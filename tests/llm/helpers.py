"""Small awkward inputs shared by the operator tests."""

from __future__ import annotations

CLASH = ("uid", "size", "kept", "component_id", "fp", "node", "hits", "part", "k", "positive", "score", "group_size", "batch", "start")


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977} tail{i % 13}," for i in range(30_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (None, "no id here at all", "en", "b", 17),
        (4, "one", "en", "b", 3), (5, "One", "en", "b", 3), (6, "the same text for two rows of the table", "de", "c", 39),
        (7, "the same text for two rows of the table", "de", "é", 39), (8, long, "en", "a", len(long)),
        (9, "token = abcdef123456", "fr", "c", 20), (9, "token = abcdef123456", "fr", "c", 20), (10, "ß É 漢字 🙂   x", "fr", None, 12),
    ]
    return rows + [(100 + i, f"plain sentence number {i} with words, ends here.", "en", f"s{i % 3}", 40) for i in range(30)]


def frame(spark, rows=None, clash: bool = True):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)])
    return df
