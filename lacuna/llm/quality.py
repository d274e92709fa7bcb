"""Quality rules with cross-document line frequency (operator 6).

Two scans, no row of text shuffled.  The first hashes the normalised lines (ASCII lower case,
numbers as 0, white space runs as one space), long or short, of every text and counts, per host
and line, the distinct texts that hold it.  A line above the limit (``min_texts`` and ``share`` of the
host's texts) is boilerplate of that host.  The second scan measures each text less its
boilerplate lines (``cleaned_documents`` also returns it so) and rejects a document of which fewer than ``min_left`` words, or less than
``left_share`` of its words, remain.  Numbers that stand alone become 0; digits that touch a letter (w12,
3rd) are part of a word and stay, in lines of any length.  The host of a document is its ``source``.

Counting distinct texts, not rows, keeps a document that was merely copied many times.  The
frequent lines of a host are few by arithmetic: at most (lines per text / share).

Cases: a null or empty text has no words and fails the base rules; null is a host of its own;
ties and repeated rows count once per distinct text; empty tables give no rows; extra columns
pass through in ``kept_documents`` and ``cleaned_documents`` and are not read by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import WORD, ascii_lower, keep_where, let, small, stash, words

SYMBOLS = "[#*$%&|<>]"
#: white space inside a line that is not one space already
BLANK_RUN = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
#: digits between characters that are neither letters nor digits
NUMBER = r"[0-9](?<![\p{L}0-9][0-9])[0-9]*+(?!\p{L})"
WINDOW = 5
#: the frequent lines of all hosts are broadcast up to this size
BROADCAST_BYTES = 64 << 20


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD))


def window_hashes(ws: Column) -> Column:
    """A hash of each five-word window: of pairs, of pairs of pairs, and of those and one word."""
    def after(a, k):
        return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))

    pair = F.zip_with(ws, after(ws, 1), lambda x, y: F.xxhash64(x, y))
    four = let(pair, lambda p: F.zip_with(p, after(p, 2), lambda x, y: F.xxhash64(x, y)))
    five = F.zip_with(four, after(ws, WINDOW - 1), lambda x, y: F.xxhash64(x, y))
    return F.slice(five, 1, F.greatest(F.size(ws) - WINDOW + 1, F.lit(0)))  # beyond, there are padded ones


def repeated_words(grams: Column) -> Column:
    """Words covered by five-word windows found twice or more in the text, from their hashes.

    When none repeats (a set of longs tells) the answer is 0.  Else (hash, place) pairs are
    sorted, places of repeated hashes are kept, and each covers the words up to the next such
    place, five at most."""
    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    twice = let(pairs, lambda p: F.filter(p, lambda x, i: (F.get(p, i - 1)["g"] == x["g"]) | (F.get(p, i + 1)["g"] == x["g"])))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = let(places, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(covered)


def line_forms(text: Column) -> Column:
    """The normalised form of each line, whatever its length; blank lines as "".  White space,
    case and numbers are settled on the whole text, before one split."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_RUN, " ")
    flat = ascii_lower(F.regexp_replace(flat, NUMBER, "0"))
    return F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x))


def frequent_lines(docs: DataFrame, min_texts: int, share: float) -> DataFrame:
    """(host, array of line hashes) for the lines above the limits, marked for broadcast when its
    measured bytes are within the bound."""
    base = docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("t"),
                       F.array_distinct(F.transform(F.filter(line_forms(F.col("text")), lambda x: x != ""),
                                                    lambda x: F.xxhash64(x))).alias("hs"))
    lines = base.select("host", "t", F.explode("hs").alias("h"))
    # a text's lines are the same in each copy, so (host, line, text) repeats fold before the shuffle
    held = lines.groupBy("host", "h", "t").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count("*").alias("n"))
    texts = docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("t"))
    hosts = stash(texts.groupBy("host", "t").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts")))
    n = hosts.count()
    often = held.filter(F.col("n") >= min_texts)
    hosts = hosts.select(F.col("host").alias("__h"), "texts")
    over = (often.join(small(hosts, n), often.host.eqNullSafe(F.col("__h")))
            .filter(F.col("n") >= F.col("texts") * share))
    got = stash(over.groupBy("host").agg(F.sort_array(F.collect_list("h")).alias("frequent")))
    size = got.agg(F.sum(8 * F.size("frequent") + 64 + F.length(F.coalesce("host", F.lit(""))))).first()[0] or 0
    return F.broadcast(got) if size <= BROADCAST_BYTES else got


def measured(docs: DataFrame, frequent: DataFrame, min_left: int, left_share: float) -> DataFrame:
    """``docs`` (with source and text) plus one struct column __q of the counts and verdicts."""
    f = frequent.select(F.col("host").alias("__h"), F.col("frequent").alias("__f"))
    joined = (docs.join(f, docs["source"].eqNullSafe(F.col("__h")), "left")
              .withColumns({"__ws": words(F.col("text")), "__ls": lines_with_words(F.col("text"))})
              .withColumns({"__g": window_hashes(F.col("__ws")), "__n": F.size("__ws").cast("long"),
                            "__c": F.length(F.array_join("__ws", "")).cast("long")}))
    gone = F.when(F.col("__f").isNull(), F.lit(0)).otherwise(
        F.aggregate(F.filter(line_forms(F.col("text")), lambda x: F.array_contains(F.col("__f"), F.xxhash64(x))),
                    F.lit(0), lambda a, x: a + F.size(F.split(x, " ")))).cast("long")
    symbols = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("long")
    left = F.col("__n") - F.col("__gone")
    failed = (F.col("__n") < 10) | (100 * F.col("__r") > 20 * F.col("__n"))
    depleted = (F.col("__gone") > 0) & ((left < min_left) | (left < F.col("__n") * left_share))
    return (joined.withColumns({"__r": repeated_words(F.col("__g")), "__gone": gone})
            .withColumn("__q", F.struct(
                F.col("__n").alias("n_words"), F.col("__c").alias("word_chars"), symbols.alias("n_symbols"),
                (F.size("__ls") - F.size(F.array_distinct("__ls"))).cast("long").alias("n_dup_lines"),
                F.col("__r").alias("n_repeat_words"), failed.alias("base_failed"), (~failed & ~depleted).alias("kept")))
            .drop("__ws", "__ls", "__g", "__n", "__c", "__r", "__gone", "__h", "__f"))


def judge(docs: DataFrame, min_texts: int = 20, share: float = 0.02, min_left: int = 10, left_share: float = 0.3) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept."""
    frequent = frequent_lines(docs, min_texts, share)
    d = docs.select("doc_id", "source", "text")
    return measured(d, frequent, min_left, left_share).select("doc_id", "__q.*")


def kept_documents(docs: DataFrame, min_texts: int = 20, share: float = 0.02, min_left: int = 10,
                   left_share: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    frequent = frequent_lines(docs, min_texts, share)
    d = docs.select(F.struct("*").alias("__row"), "source", "text")
    return keep_where(measured(d, frequent, min_left, left_share), F.col("__q.kept")).select("__row.*")


def cleaned_documents(docs: DataFrame, min_texts: int = 20, share: float = 0.02, min_left: int = 10,
                      left_share: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are kept, their texts without the boilerplate lines of their host
    and ``n_chars`` counted anew where a line went; all other rows and columns as they were."""
    frequent = frequent_lines(docs, min_texts, share)
    d = docs.select(F.struct("*").alias("__row"), "source", "text")
    kept = keep_where(measured(d, frequent, min_left, left_share), F.col("__q.kept")).select("__row", "source", "text")
    f = frequent.select(F.col("host").alias("__h"), F.col("frequent").alias("__f"))
    lines = F.split("text", "\n", -1)
    rest = let(line_forms(F.col("text")), lambda k: F.filter(
        lines, lambda x, i: ~F.array_contains(F.col("__f"), F.xxhash64(F.get(k, i)))))
    out = (kept.join(f, kept["source"].eqNullSafe(F.col("__h")), "left")
           .withColumn("__rest", F.when(F.col("__f").isNotNull(), rest))
           .withColumn("__less", F.coalesce(F.size("__rest") < F.size(lines), F.lit(False)))
           .withColumn("__text", F.when(F.col("__less"), F.array_join("__rest", "\n")).otherwise(F.col("text"))))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = (F.when(F.col("__less"), F.length("__text").cast("long"))
                              .otherwise(F.col("__row.n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[changed.get(c, F.col("__row").getField(c)).alias(c) for c in docs.columns])
