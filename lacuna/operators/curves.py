"""Polynomial and spline interpolation along an order key (WIN6, WIN7).

A hole is filled from the interpolating spline of degree ``order`` through the observations of
its series (by row position), with the usual not-a-knot ends: knots at the observations for odd
degrees and midway between them for even ones, the outermost left out.  'polynomial' fills only
between the first and last observation, 'spline' also extrapolates at the ends.

The spline is global, but an observation's influence falls by a constant factor per observation
in between (at least 2 for cubics and 3 for quadratics, for any spacing).  So each chunk
(series, range of the order key) is solved together with ``HALO`` observations on each side
outside it, found by exact rank; what lies further changes nothing that a double can hold, and
the fill is the same for any number of chunks.  Inside a chunk the observations are solved in
blocks in the same way, so no task holds a whole series or a large matrix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import clean
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.operators.ordered import CHUNK_ROWS, order_context
from lacuna.session import cut

HALO = 64
BLOCK = 192
SLOT_ROWS = 50_000


def knots_of(xs: np.ndarray, k: int) -> np.ndarray:
    """Knots of the interpolating spline of degree k: inner sites without the outermost ones."""
    inner = xs if k % 2 else (xs[1:] + xs[:-1]) / 2
    drop = (k + 1) // 2 if k % 2 else k // 2
    return np.concatenate((np.repeat(xs[0], k + 1), inner[drop:len(inner) - drop], np.repeat(xs[-1], k + 1)))


def basis(t: np.ndarray, k: int, x: np.ndarray) -> np.ndarray:
    """Values of all B-splines of degree k on knots t at the points x (rows); beyond the ends the
    outer pieces go on."""
    n = len(t) - k - 1
    at = np.clip(np.searchsorted(t, x, side="right") - 1, k, n - 1)
    b = np.ones((len(x), 1))
    for d in range(1, k + 1):
        new = np.zeros((len(x), d + 1))
        for r in range(d):
            lo, hi = t[at + r + 1 - d], t[at + r + 1]
            part = b[:, r] / (hi - lo)
            new[:, r] += part * (hi - x)
            new[:, r + 1] += part * (x - lo)
        b = new
    out = np.zeros((len(x), n))
    out[np.arange(len(x))[:, None], (at - k)[:, None] + np.arange(k + 1)] = b
    return out


def spline_at(xs: np.ndarray, ys: np.ndarray, xq: np.ndarray, order: int) -> np.ndarray:
    """The interpolating spline through (xs, ys), xs ascending, at the points xq; with ``order``
    observations or fewer, the polynomial through all of them."""
    n = len(xs)
    if n == 0 or len(xq) == 0:
        return np.full(len(xq), np.nan)
    if n == 1:
        return np.full(len(xq), ys[0])
    out = np.empty(len(xq))
    piece = np.clip(np.searchsorted(xs, xq, side="right") - 1, 0, n - 2)
    if order == 1:  # in the form and order of linear interpolation
        return ys[piece] + (ys[piece + 1] - ys[piece]) * (xq - xs[piece]) / (xs[piece + 1] - xs[piece])
    for a in np.unique(piece // BLOCK) * BLOCK:
        mine = piece // BLOCK == a // BLOCK
        lo, hi = max(0, a - HALO), min(n, a + BLOCK + 1 + HALO)
        x0 = xs[lo]
        x, y = xs[lo:hi] - x0, ys[lo:hi]
        k = min(order, len(x) - 1)
        t = knots_of(x, k)
        out[mine] = basis(t, k, xq[mine] - x0) @ np.linalg.solve(basis(t, k, x), y)
    return out


def halo_ranks(per: DataFrame, m: int) -> DataFrame:
    """(__key, __tb, __rank): the m observations just before and just after each chunk, by exact rank.
    A chunk that holds all observations of its series needs none, so short series cost nothing."""
    off, upto, every = F.col("__off"), F.col("__off") + F.col("__nobs"), F.col("__all")
    none = F.array().cast("array<bigint>")
    before = F.when(off > 0, F.sequence(F.greatest(off - (m - 1), F.lit(1)), off)).otherwise(none)
    after = F.when(upto < every, F.sequence(upto + 1, F.least(upto + m, every))).otherwise(none)
    return per.where((off > 0) | (upto < every)).select("__key", "__tb", F.explode(F.concat(before, after)).alias("__rank"))


class CurveModel(ImputerModel):
    def __init__(self, method, order, column, order_by, partition_by, buckets):
        self.method, self.order, self.column = method, order, column
        self.order_by, self.partition_by, self.buckets = order_by, partition_by, buckets

    def transform(self, df: DataFrame) -> DataFrame:
        c, part = self.column, self.partition_by
        m = HALO
        ctx = order_context(df, self.order_by, [c], part, self.buckets, keep_bucket=True)
        names = df.columns
        own = ctx.select(*[clean(df, x).cast("double").alias(x) if x == c else F.col(x) for x in names],
                         F.col("__pos").cast("double").alias("__pos"), F.col("__b").alias("__tb"),
                         F.lit(True).alias("__own"), F.col(f"{c}__pv").isNotNull().alias("__hp"),
                         F.col(f"{c}__nv").isNotNull().alias("__hn"))
        own = cut(own)
        # rank of every observation within its series: local rank + observations in earlier buckets
        # the series key as one struct: structs of nulls are equal in joins
        series = (F.struct(*part) if part else F.struct(F.lit(0).alias("one"))).alias("__key")
        obs = own.where(F.col(c).isNotNull()).select(series, "__tb", "__pos", c)
        wl = Window.partitionBy("__key", "__tb").orderBy("__pos")
        per = own.groupBy(series, "__tb").agg(F.count(c).alias("__nobs"))
        ws = Window.partitionBy("__key").orderBy("__tb").rowsBetween(Window.unboundedPreceding, -1)
        per = (per.withColumn("__off", F.coalesce(F.sum("__nobs").over(ws), F.lit(0)))
               .withColumns({"__all": F.sum("__nobs").over(Window.partitionBy("__key")),
                             "__chunks": F.count("*").over(Window.partitionBy("__key"))}))
        # only series that more than one chunk shares give halo rows, so only those are ranked
        shared = per.where("__chunks > 1").select("__key", "__tb", "__off")
        ranked = obs.join(shared, ["__key", "__tb"]).withColumn("__lr", F.row_number().over(wl)) \
                    .select("__key", "__pos", c, (F.col("__off") + F.col("__lr")).alias("__rank"))
        halo = halo_ranks(per, m).join(ranked, ["__key", "__rank"]).select(
            *[F.col(x) if x == c else F.col("__key").getField(x).alias(x) if x in part
              else F.lit(None).cast(own.schema[x].dataType).alias(x) for x in names], "__pos", "__tb", F.lit(False).alias("__own"), F.lit(True).alias("__hp"),
            F.lit(True).alias("__hn"))
        both = own.unionByName(halo)
        schema = own.select(*names).schema
        method, order = self.method, self.order
        # many short series share one Python call of about SLOT_ROWS rows: group by a hash of the
        # series key and the chunk (a long series is already split by the chunks)
        n_rows, last = own.agg(F.count("*"), F.max("__tb")).first()
        n_slots = max(1, -(-n_rows // (SLOT_ROWS * ((last or 0) + 1))))
        slot = F.pmod(F.xxhash64(*part), F.lit(n_slots)) if part else F.lit(0)
        both = both.withColumn("__slot", slot)
        if n_rows > CHUNK_ROWS:  # what a task sorts doesn't grow with the table
            both = both.repartition(-(-n_rows // SLOT_ROWS), "__slot", "__tb")

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pts = pdf[pdf[c].notna()].drop_duplicates("__pos").sort_values("__pos")
            mine = pdf[pdf["__own"]].copy()
            hole = mine[c].isna().to_numpy()
            if method == "polynomial":
                hole &= mine["__hp"].to_numpy() & mine["__hn"].to_numpy()
            vals = mine[c].to_numpy(dtype="float64", na_value=np.nan)
            if hole.any():
                vals[hole] = spline_at(pts["__pos"].to_numpy(), pts[c].to_numpy(dtype="float64"),
                                        mine["__pos"].to_numpy()[hole], order)
            mine[c] = vals
            return mine[names]

        def fn(pdf: pd.DataFrame) -> pd.DataFrame:
            if not part:
                return one(pdf)
            outs = [one(g) for _, g in pdf.groupby(part, dropna=False, sort=False)]
            return pd.concat(outs, ignore_index=True) if outs else pdf[names].iloc[:0]

        return both.groupBy("__slot", "__tb").applyInPandas(fn, schema)


class CurveInterpolationImputer(Imputer):
    def __init__(self, method: str = "polynomial", order: int = 2, order_by=None, partition_by=None,
                 column: str | None = None, buckets: int | None = None):
        if method not in ("polynomial", "spline"):
            raise ValueError("method must be 'polynomial' or 'spline'")
        if not order_by or column is None:
            raise ValueError("order_by and column are required")
        if order < 1:
            raise ValueError("order must be >= 1")
        self.method, self.order, self.column = method, order, column
        self.order_by = [order_by] if isinstance(order_by, str) else list(order_by)
        self.partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        self.buckets = buckets

    def fit(self, df):
        return CurveModel(self.method, self.order, self.column, self.order_by, self.partition_by, self.buckets)
