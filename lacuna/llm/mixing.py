"""Mixing sources to target weights by hash-threshold histograms (operator 3).

Every row gets a 60-bit hash.  Sizes are summed by source and hash bucket; running sums over
the buckets of a source find the bucket in which its budget ends, and only the rows of that
bucket are split further, 1,024 buckets at a time, until it holds one hash value.  A row is in
the mix when its hash lies under the threshold: no sort of the corpus, and two budgets of one
source are nested because they cut the same hash order.

Cases: a null text has size 0 and is never taken; null is a source of its own, last in order;
rows equal in id and text share a hash, and where the threshold falls on such a tie each row
gives the same share of its words, so the target is still met; an empty table gives no rows.
Extra columns, whatever their names, pass through inside one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import keep_where, n_words, small, stash

HASH_BITS = 60
LEVEL_BITS = 10
WEIGHTS = (3, 1, 2)
BIG = "decimal(38,0)"


def row_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits of an MD5 over seed, id and text."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                   F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` with __size (words) and __hash."""
    return docs.withColumns({"__size": n_words(F.col("text")),
                             "__hash": row_hash(F.col("doc_id"), F.col("text"), seed)})


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Sources numbered by code point, null last: a range sort, then the count of each sorted
    part as offset, so that no task holds all sources."""
    placed = stash(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("__m", F.monotonically_increasing_id()))
    part, idx = F.shiftright("__m", 33), F.col("__m").bitwiseAND((1 << 33) - 1)
    parts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per sorted part
    offs = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (placed.withColumn("__part", part).join(F.broadcast(offs), "__part")
            .select("source", "source_size", (F.col("__off") + idx).alias("rank")))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: tuple = (3, 2), repeat: int = 2) -> DataFrame:
    """(source, source_size, target, budget): budgets proportional to the weights, sum ``share``
    of all sizes; one that would pass ``repeat`` times its source stops there and the excess is
    shared again until none is above.  Sums are exact integers; one division gives the double."""
    num, den = share
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = stash(ranked_sources(sizes).withColumn("weight", w.cast("long")))
    tot = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_w = int(tot[0] or 0), int(tot[1] or 0)
    limit = F.col("source_size").cast(BIG) * repeat
    capped, n_capped, top, bottom = F.lit(False), 0, num * total, den * all_w
    while bottom:
        above = F.col("weight").cast(BIG) * F.lit(top).cast(BIG) > limit * F.lit(bottom).cast(BIG)
        got = src.agg(F.sum(F.when(above, F.col("source_size")).otherwise(0)), F.sum(F.when(above, F.col("weight")).otherwise(0)),
                      F.count(F.when(above, 1))).first()
        capped = above
        if got[2] == n_capped:
            break
        n_capped, top, bottom = got[2], num * total - den * repeat * int(got[0]), den * (all_w - int(got[1]))
    part = F.col("weight").cast(BIG) * F.lit(top).cast(BIG)
    free = F.lit(max(bottom, 1)).cast(BIG)
    return src.select("source", "source_size",
                      F.when(capped, limit.cast("double")).otherwise(part.cast("double") / free.cast("double")).alias("target"),
                      F.when(capped, limit).otherwise(F.floor(part / free)).cast("long").alias("budget"))


def thresholds(rows: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """Per source: whole copies of every row, the hash at which the last copy ends, and the part
    (of ``tie`` words at exactly that hash) still due there."""
    whole = F.expr("budget div source_size")
    state = stash(targets.filter("source_size > 0").withColumn("copies", whole)
                  .withColumn("rest", F.col("budget") - F.col("copies") * F.col("source_size"))
                  .withColumn("prefix", F.lit(0).cast("long")))
    rows = rows.select("source", "__size", "__hash").filter("__size > 0")
    shift = HASH_BITS
    while shift:
        shift -= LEVEL_BITS
        s = state.select(F.col("source").alias("__s"), "prefix", "rest", "copies", "source_size", "target")
        inside = rows.join(small(s, n_sources), rows.source.eqNullSafe(F.col("__s"))
                           & (F.shiftright("__hash", shift + LEVEL_BITS) == F.col("prefix")))
        keys = ["__s", "source_size", "target", "copies", "rest"]
        hist = inside.groupBy(*keys, F.shiftright("__hash", shift).alias("bucket")).agg(
            F.sum("__size").alias("tie"), F.min("__hash").alias("lo"), F.max("__hash").alias("hi"))
        run = F.sum("tie").over(Window.partitionBy("__s").orderBy("bucket"))
        state = stash(hist.withColumn("run", run).filter("run > rest and run - tie <= rest")
                      .select(F.col("__s").alias("source"), "source_size", "target", "copies", "tie", "lo", "hi",
                              (F.col("rest") - F.col("run") + F.col("tie")).alias("rest"), F.col("bucket").alias("prefix")))
        if state.filter("lo < hi").isEmpty():
            break
    return state


def plan_mix(rows: DataFrame, weights: tuple = WEIGHTS, share: tuple = (3, 2), repeat: int = 2):
    """From (source, __size, __hash) rows: (per-source table, number of sources)."""
    sizes = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    targets = stash(source_targets(sizes, weights, share, repeat))
    n = targets.count()
    cuts = thresholds(rows, targets, n).select(F.col("source").alias("__s"), "copies", "lo", "rest", "tie")
    plan = targets.join(small(cuts, n), targets.source.eqNullSafe(F.col("__s")), "left").drop("__s", "budget")
    return stash(plan), n


def apply_mix(rows: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` (with __size, __hash) and source_size, target, taken."""
    p = plan.select(F.col("source").alias("__s"), F.col("source_size").alias("__ss"), F.col("target").alias("__t"),
                    F.col("copies").alias("__c"), F.col("lo").alias("__lo"), F.col("rest").alias("__r"), F.col("tie").alias("__tie"))
    last = (F.when(F.col("__hash") < F.col("__lo"), F.col("__size"))
            .when(F.col("__hash") == F.col("__lo"), F.floor(F.col("__size").cast(BIG) * F.col("__r") / F.col("__tie")))
            .otherwise(0))
    taken = F.when(F.col("__size") > 0, F.col("__c") * F.col("__size") + last).otherwise(0).cast("long")
    return (rows.join(small(p, n_sources), rows["source"].eqNullSafe(F.col("__s")))
            .withColumn("__taken", taken).drop("__s", "__c", "__lo", "__r", "__tie"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: tuple = (3, 2), repeat: int = 2, seed: int = 7) -> DataFrame:
    """Narrow result: doc_id, size, source_size, target, taken for every row of ``docs``."""
    rows = stash(sized(docs.select("doc_id", "source", "text"), seed).select("doc_id", "source", "__size", "__hash"))
    plan, n = plan_mix(rows, weights, share, repeat)
    return apply_mix(rows, plan, n).select("doc_id", F.col("__size").alias("size"), F.col("__ss").alias("source_size"),
                                           F.col("__t").alias("target"), F.col("__taken").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, share: tuple = (3, 2), repeat: int = 2,
                    seed: int = 7) -> DataFrame:
    """The mix itself, with the columns of ``docs``: an unchanged row per copy taken; of the row at the
    threshold, which ``mix`` counts in part, one more copy when at least half of it is due."""
    rows = sized(docs.select(F.struct("*").alias("__row"), "doc_id", "source", "text"), seed)
    plan, n = plan_mix(stash(rows.select("source", "__size", "__hash")), weights, share, repeat)
    took = keep_where(apply_mix(rows, plan, n), F.col("__taken") > 0)
    whole = F.expr("__taken div __size")
    rest = F.col("__taken") - whole * F.col("__size")
    copies = whole + F.when(2 * rest >= F.col("__size"), 1).otherwise(0)
    return took.select("__row", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("__copy")).select("__row.*")
