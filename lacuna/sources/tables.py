"""Readers for the parquet tables and the feature matrices derived from them.

Everything here is a lazy scan plus projections, so Catalyst prunes columns and
pushes filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        load(spark, sf_dir, t).createOrReplaceTempView(t)


# Text features of `documents`.  Counting characters by deleting them keeps the
# definitions identical in Spark SQL and DuckDB (both count code points).
DOC_FEATURES = ("n_chars", "n_words", "n_lines", "n_punct", "avg_word_len")
DOC_COUNT_FEATURES = ("n_chars", "n_words", "n_lines", "n_punct")
PUNCT = ".,;:!?"


def _count_removed(text: Column, chars: str) -> Column:
    # one character: replace() is about twice as fast as translate() on long texts
    gone = F.replace(text, F.lit(chars), F.lit("")) if len(chars) == 1 else F.translate(text, chars, "")
    return F.length(text) - F.length(gone)


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source + five double features of each document's text."""
    text = F.col("text")
    spaces = _count_removed(text, " ")
    return docs.select(
        "doc_id", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        (spaces + 1).cast("double").alias("n_words"),
        (_count_removed(text, "\n") + 1).cast("double").alias("n_lines"),
        _count_removed(text, PUNCT).cast("double").alias("n_punct"),
        ((F.length(text) - spaces) / (spaces + 1)).alias("avg_word_len"),
    )


def document_features_sql(alias: str = "documents") -> str:
    """The same projection as SQL text, for DuckDB oracles."""
    t = f"{alias}.text"
    sp = f"(length({t}) - length(replace({t}, ' ', '')))"
    nl = f"(length({t}) - length(replace({t}, chr(10), '')))"
    pu = f"(length({t}) - length(translate({t}, '{PUNCT}', '')))"
    return (f"SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, "
            f"CAST({sp} + 1 AS DOUBLE) AS n_words, CAST({nl} + 1 AS DOUBLE) AS n_lines, "
            f"CAST({pu} AS DOUBLE) AS n_punct, "
            f"CAST(length({t}) - {sp} AS DOUBLE) / ({sp} + 1) AS avg_word_len FROM {alias}")
