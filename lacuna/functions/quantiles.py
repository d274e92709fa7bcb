"""Exact quantiles without gathering a column in one task.

Spark's exact ``percentile``/``median`` aggregates keep every distinct value of a group in one
buffer, which does not survive a 100 TB column.  Here the value of rank r is found by brackets,
for any number of groups at once (``kth_values``).  While a group's range holds more than
``max_collect`` values, a round takes two scans:

1. a mergeable sketch (``percentile_approx`` on a fixed grid) of the values in the range gives a
   bracket of a few grid steps around the rank;
2. exact counts tell how many values lie below the bracket, at its ends and inside it.

The rank is then at an end (done), strictly inside (the range becomes the least and greatest
value inside), or, should the sketch have erred, on a known side.  The range gets strictly
smaller each round, by a factor of about ``GRID`` / 3, whatever the distribution: only
comparisons are used, so infinities are values like any other, and nothing is dropped or capped.
Ranges of at most ``max_collect`` values are finished by sorting them.  Linear interpolation
between neighbouring ranks gives the pandas / ``percentile`` definition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean

GRID = 128
#: of the sketches: a rank error of GRID / ACCURACY grid steps, well inside the bracket
ACCURACY = 1_000
#: ranges to search in at once that are broadcast; more are joined by a shuffle on the group
BROADCAST_ROWS = 20_000


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), clean(df, c).cast("double").alias("v"))
                      for i, c in enumerate(cols)])
    return df.select(F.explode(pairs).alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull())


def kth_values(base: DataFrame, keys: list[str], state: DataFrame, max_collect: int) -> DataFrame:
    """``base``: keys and v (not null).  ``state``: one row per target: keys, t, r (rank from 0),
    lo, hi (least and greatest value), below (0) and cnt (values) of the group.  Returns keys,
    t, val.  Null keys match null keys."""
    from lacuna.session import cut
    state_cols = [*keys, "t", "r", "lo", "hi", "below", "cnt"]
    span = ["lo", "hi", "below", "cnt"]

    def inside(ranges, *cols):
        """The values of ``base`` in each range, with the range's columns; targets of one range share it."""
        s = ranges.select(*[F.col(k).alias(f"s_{k}") for k in keys], *cols)
        s = F.broadcast(s) if n_state <= BROADCAST_ROWS else s
        on = F.col("v").between(F.col("lo"), F.col("hi"))
        for k in keys:
            on = F.col(k).eqNullSafe(F.col(f"s_{k}")) & on
        return base.join(s, on)

    def by_range(targets, *cols):
        return targets.groupBy(*keys, *cols).agg(F.sort_array(F.collect_list(F.struct("t", "r"))).alias("ts"))

    done = None
    state = cut(state.select(*state_cols))
    n_state = state.count()
    while True:
        known = state.where(F.col("lo") == F.col("hi")).select(*keys, "t", F.col("lo").alias("val"))
        few = by_range(state.where((F.col("lo") < F.col("hi")) & (F.col("cnt") <= max_collect)), *span)
        sorted_few = (inside(few, *span, "ts").groupBy(*keys, *span, "ts").agg(F.sort_array(F.collect_list("v")).alias("vs"))
                      .select(*keys, "below", "vs", F.explode("ts").alias("x"))
                      .select(*keys, "x.t", F.element_at("vs", (F.col("x.r") - F.col("below") + 1).cast("int")).alias("val")))
        part = known.unionByName(sorted_few)
        done = part if done is None else done.unionByName(part)
        todo = state.where((F.col("lo") < F.col("hi")) & (F.col("cnt") > max_collect))
        if todo.isEmpty():
            return done
        grid = F.percentile_approx("v", [i / GRID for i in range(GRID + 1)], ACCURACY)
        sketch = (inside(by_range(todo, *span), *span, "ts").groupBy(*keys, *span, "ts").agg(grid.alias("g"))
                  .select(*keys, *span, "g", F.explode("ts").alias("x")).select(*keys, "x.t", "x.r", *span, "g"))
        step = F.floor((F.col("r") - F.col("below")) * GRID / F.col("cnt")).cast("int")
        bracket = cut(sketch.select(*state_cols, F.element_at("g", F.greatest(step, F.lit(1))).alias("b0"),
                                    F.element_at("g", F.least(step + 3, F.lit(GRID + 1))).alias("b1")))
        v, b0, b1 = F.col("v"), F.col("b0"), F.col("b1")
        ends = [*span, "b0", "b1"]
        n = (inside(by_range(bracket, *ends), *ends, "ts").groupBy(*keys, *ends, "ts").agg(
            F.count_if(v < b0).alias("lt"), F.count_if(v == b0).alias("at0"), F.count_if((v > b0) & (v < b1)).alias("mid"),
            F.count_if(v == b1).alias("at1"), F.max(F.when(v < b0, v)).alias("under"), F.min(F.when((v > b0) & (v < b1), v)).alias("in0"),
            F.max(F.when((v > b0) & (v < b1), v)).alias("in1"), F.min(F.when(v > b1, v)).alias("over"))
             .withColumn("x", F.explode("ts")).withColumns({"t": F.col("x.t"), "r": F.col("x.r")}).drop("x", "ts"))
        at1 = F.when(b1 > b0, F.col("at1")).otherwise(0)
        place = F.col("r") - F.col("below")
        e0, e1 = F.col("lt") + F.col("at0"), F.col("lt") + F.col("at0") + F.col("mid")

        def to(lo, hi, below, cnt):
            return F.struct(lo.alias("lo"), hi.alias("hi"), below.alias("below"), cnt.alias("cnt"))

        new = (F.when(place < F.col("lt"), to(F.col("lo"), F.col("under"), F.col("below"), F.col("lt")))
               .when(place < e0, to(b0, b0, F.col("below") + F.col("lt"), F.col("at0")))
               .when(place < e1, to(F.col("in0"), F.col("in1"), F.col("below") + e0, F.col("mid")))
               .when(place < e1 + at1, to(b1, b1, F.col("below") + e1, at1))
               .otherwise(to(F.col("over"), F.col("hi"), F.col("below") + e1 + at1, F.col("cnt") - e1 - at1)))
        state = cut(n.select(*keys, "t", "r", new.alias("s")).select(*keys, "t", "r", "s.lo", "s.hi", "s.below", "s.cnt"))


def _sketches(df: DataFrame, cols: list[str]) -> dict[int, tuple]:
    """Per column index (n, least, greatest, grid of approximate quantiles), from one scan."""
    grid = [i / GRID for i in range(GRID + 1)]
    row = df.agg(*[x for i, c in enumerate(cols) for v in [clean(df, c).cast("double")] for x in (
        F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
        F.percentile_approx(v, grid, ACCURACY).alias(f"g{i}"))]).first()
    return {i: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"g{i}"]) for i in range(len(cols)) if row[f"n{i}"]}


def _pick(df: DataFrame, cols: list[str], sketches: dict[int, tuple], ranks: dict[int, list[int]],
          max_collect: int) -> dict[tuple[int, int], float]:
    """Values of the ranks: a second scan counts what lies below each bracket and at its ends and
    brings the values strictly inside, at most about ``max_collect`` over all brackets; the rest goes
    to ``kth_values``."""
    out, slow, targets, brackets, brought = {}, [], [], {}, 0
    for k, rs in ranks.items():
        if k not in sketches:
            continue
        n, lo, hi, g = sketches[k]
        for r in sorted(set(rs)):
            if lo == hi:
                out[k, r] = lo
                continue
            step = r * GRID // n
            b0 = lo if step < 1 else g[step - 1]
            b1 = hi if step + 2 > GRID else g[step + 2]
            cost = 0 if (k, b0, b1) in brackets else 4 * n // GRID
            if brought + cost > max_collect:
                slow.append((k, r))
            else:
                brought += cost
                targets.append((k, r, brackets.setdefault((k, b0, b1), len(brackets))))
    if brackets:
        aggs = []
        for (k, b0, b1), i in brackets.items():
            v, lo, hi = clean(df, cols[k]).cast("double"), F.lit(b0), F.lit(b1)
            aggs += [F.count_if(v < lo).alias(f"lt{i}"), F.count_if(v == lo).alias(f"at{i}"),
                     F.collect_list(F.when((v > lo) & (v < hi), v)).alias(f"in{i}"), F.count_if((v == hi) & (hi > lo)).alias(f"to{i}")]
        row = df.agg(*aggs).first()
        ends = {i: (b0, b1) for (_, b0, b1), i in brackets.items()}
        inside = {i: sorted(row[f"in{i}"]) for i in ends}
        for k, r, i in targets:
            at = r - row[f"lt{i}"]
            if at < 0 or at >= row[f"at{i}"] + len(inside[i]) + row[f"to{i}"]:
                slow.append((k, r))  # the sketch erred by more than a grid step
            elif at < row[f"at{i}"]:
                out[k, r] = ends[i][0]
            elif at < row[f"at{i}"] + len(inside[i]):
                out[k, r] = inside[i][at - row[f"at{i}"]]
            else:
                out[k, r] = ends[i][1]
    if slow:
        rows = [(k, r, r, float(sketches[k][1]), float(sketches[k][2]), 0, sketches[k][0]) for k, r in slow]
        state = df.sparkSession.createDataFrame(rows, "k int, t long, r long, lo double, hi double, below long, cnt long")
        out |= {(r["k"], r["t"]): r["val"] for r in kth_values(_long_values(df, cols), ["k"], state, max_collect).collect()}
    return out


def exact_kth(df: DataFrame, cols: list[str], ranks: dict[int, list[int]],
              max_collect: int = 200_000) -> dict[tuple[int, int], float]:
    """Values of 0-based ranks per column index: {(k, rank): value}."""
    return _pick(df, cols, _sketches(df, cols), ranks, max_collect)


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float], max_collect: int = 200_000) -> dict[str, list]:
    """Linear-interpolated quantiles (pandas default) for several columns, in two shared scans
    unless a column is very long."""
    sketches = _sketches(df, cols)
    ranks = {k: [r for p in probs for r in (math.floor((s[0] - 1) * p), math.ceil((s[0] - 1) * p))] for k, s in sketches.items()}
    vals = _pick(df, cols, sketches, ranks, max_collect)
    res = {}
    for k, c in enumerate(cols):
        if k not in sketches:
            res[c] = [None] * len(probs)
            continue
        qs = []
        for p in probs:
            h = (sketches[k][0] - 1) * p
            lo, hi = math.floor(h), math.ceil(h)
            a, b = vals[(k, lo)], vals[(k, hi)]
            qs.append(a if a == b else a + (h - lo) * (b - a))
        res[c] = qs
    return res


def exact_quantiles(df: DataFrame, col: str, probs: list[float], **kw) -> list:
    return exact_quantiles_multi(df, [col], probs, **kw)[col]


def grouped_exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                            max_collect: int = 1_000_000) -> DataFrame:
    """Exact linear quantiles per group, for any number of groups and any skew.

    Returns one row per group (keys, q0, q1, ...).  Per-group state is a DataFrame, never a
    driver object, and a hot group's sketches and counts are partially aggregated in every task.
    Null keys form a group of their own.
    """
    from lacuna.session import cut
    v = clean(df, value).cast("double")
    names, keys = keys, [f"__g{i}" for i in range(len(keys))]
    base = df.select(*[F.col(k).alias(g) for k, g in zip(names, keys)], v.alias("v")).where(F.col("v").isNotNull())
    st = cut(base.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    # targets: (keys, t = target index, r = 0-based rank); two ranks per probability
    tgt = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(p)
        tgt += [F.struct(F.lit(2 * i).alias("t"), F.floor(h).cast("long").alias("r")),
                F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(h).cast("long").alias("r"))]
    state = st.select(*keys, "n", F.explode(F.array(*tgt)).alias("x"), "lo", "hi") \
        .select(*keys, "x.t", "x.r", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("cnt"))
    done = kth_values(base, keys, state, max_collect)
    # linear interpolation between the two ranks of each probability
    n = st.select(*keys, "n")
    piv = done.groupBy(*keys).agg(*[F.max(F.when(F.col("t") == j, F.col("val"))).alias(f"v{j}")
                                    for j in range(2 * len(probs))])
    out = piv.alias("a").join(n.alias("c"), [F.col(f"a.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
                              if keys else F.lit(True))
    sel = [F.col(f"a.{g}").alias(k) for k, g in zip(names, keys)]
    for i, p in enumerate(probs):
        h = (F.col("c.n") - 1) * F.lit(p)
        frac = h - F.floor(h)
        a, b = F.col(f"a.v{2 * i}"), F.col(f"a.v{2 * i + 1}")
        sel.append(F.when(a == b, a).otherwise(a + frac * (b - a)).alias(f"q{i}"))
    return out.select(*sel)
