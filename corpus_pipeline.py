"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs, so a lost executor costs one stage at most.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lacuna.llm import mixing, packing, quality, simhash, substring
from lacuna.llm.common import table
from lacuna.llm.queries import tokenizer_path
from lacuna.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the rules reject go, and boilerplate lines of the others."""
    return quality.cleaned_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each component stays."""
    return simhash.one_per_group(docs, shingle=4, radius=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: words inside repeated 35-word windows go; no row does."""
    return substring.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: a row per copy that the mix takes."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every piece of every document in a sequence of 2,048 tokens at most."""
    return packing.pack(docs, tokenizer_path(), max_len=2048)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: near-duplicates, shared passages and token ids are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
