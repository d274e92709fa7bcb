"""Shared pieces: table reading, the word rule, written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.session import checkpoint_dir, delete_on_exit

#: one run of white space and one word, as regular expressions (fixed values of the contracts)
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: a table of at most this many rows is broadcast; a larger one is joined by a shuffle
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of repeating the work before
    them.  The folder goes when the session's file system closes.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder; it goes when the session's file system closes."""
    return delete_on_exit(spark, f"{checkpoint_dir(spark).rstrip('/')}/lacuna-llm/{uuid.uuid4().hex}")


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns that stays above them: pushed below, the planner would write
    their expressions into the condition once per mention and evaluate them as often."""
    return (df.withColumn("__row_number_in_part", F.monotonically_increasing_id())
            .filter(condition & (F.col("__row_number_in_part") >= 0)).drop("__row_number_in_part"))


#: keys that hold over one part in this many of all rows are joined by broadcast
HEAVY_KEYS = 10_000


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join of ``rows`` with a written ``table`` of unique keys and a few fixed-width columns.

    ``weight`` is the number of ``rows`` with the key.  A short table is broadcast.  Of a long one
    the keys that hold more than 1 / HEAVY_KEYS of the rows are, fewer than HEAVY_KEYS of them by
    that measure; the rest meet by a shuffle in which no key is large.
    """
    n, total = table.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table.drop(weight)), key, "left")
    heavy = table.filter(F.col(weight) * HEAVY_KEYS > total).drop(weight).withColumn("__heavy", F.lit(True))
    light = table.filter(F.col(weight) * HEAVY_KEYS <= total).drop(weight)
    met = rows.join(F.broadcast(heavy), key, "left")
    rest = met.filter(F.col("__heavy").isNull()).select(*rows.columns)
    return met.filter("__heavy").drop("__heavy").unionByName(rest.join(light, key, "left"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df

