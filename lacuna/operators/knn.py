"""Nearest-neighbour fills on a top-k similarity join (MOD1-MOD3, JOI4-JOI6, TOP4).

Distances are sums of elementwise differences, so they do not depend on how rows are grouped and
nothing cancels.  When the donor matrix is small (its measured size is under ``broadcast_bytes``, and
for k nearest it has ``FEW_DONORS`` rows at most, as all pairs soon outnumber those the tree looks at)
it is shipped to every task, only receivers move, and matrices span ``DONOR_ROWS`` donors at a time
(the nearest fraction instead lays the shipped donors in leaves and looks at those the k-th may be in).
Beyond that, up to ``HELD_BYTES``, donors stream into a few large tasks of units that lie near each other, and each
task lays them in leaves for the columns and sets of features that its units have (``_held``).
Beyond that donors lie in a packed tree (index.py): leaves of ``leaf_rows`` donors, as deep as the rows ask for.

* k nearest: each receiver first scans the nearest leaves that hold k donors; the k-th distance
  found there is its radius, and only nodes that reach into it are opened.  Exact.
* nearest fraction: k grows with the table, so donors are counted instead.  Leaves stream past groups of
  units: those wholly below the range of the k-th distance add their count and sum, those cut by it are
  looked at, rounds narrow the range until few donors are left in it, and those are ranked.

Tasks emit candidates or counts, never pairs, and ties go to the smaller donor id.  Ids of any
type: those that are not integers are numbered in their order.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import clean, resolve_columns
from lacuna.operators import index
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.session import cut

BLOCK_ROWS = 2048
BROADCAST_BYTES = 64 << 20
DONOR_ROWS = 8192  # donors that one distance matrix spans
FEW_DONORS = 20_000  # up to so many, k nearest hold every receiver against every donor
LEAF_ROWS = index.LEAF_ROWS
CLOSE = 6  # nodes that a unit's first radius comes from besides
SLACK = 1e-9  # of bounds, for rounding
HELD_BYTES = 192 << 20  # donors of a task that holds them
HELD_UNITS = 131072  # units of a task that holds its donors
HELD_LEAF_ROWS = 64
OWN_UNITS, OWN_SHARE = 64, 1024  # units of one set of features, also as one part in so many of the donors, that are worth leaves of their own
NEAR_LEAVES = 8  # leaves that a first radius comes from
BLOCK_UNITS = 32  # near units whose bounds are computed together
LOOK_ROWS = 4096  # donors that a block's units look at together
POINT_ROWS = 32  # equal donors that are taken by their sum

CAND_SCHEMA = "rid long, j int, sid long, dist2 double, v double"


class _Ids:
    """Row ids as longs in the ids' order: integers as they are, others by rank."""

    def __init__(self, df: DataFrame, id_col: str):
        self.id_col, self.ranks = id_col, None
        if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
            sorted_ids = df.select(F.col(id_col).alias("__key")).distinct().repartitionByRange("__key").sortWithinPartitions("__key")
            self.ranks = cut(sorted_ids.withColumn("__id", F.monotonically_increasing_id()))

    def number(self, df: DataFrame) -> DataFrame:
        if self.ranks is None:
            return df.withColumn("__id", F.col(self.id_col).cast("long"))
        return df.join(self.ranks, F.col(self.id_col).eqNullSafe(F.col("__key")), "left").drop("__key")

    def back(self, df: DataFrame, *cols: str) -> DataFrame:
        """The columns of numbers as ids again."""
        if self.ranks is None:
            return df
        out = df
        for c in cols:
            out = out.withColumnRenamed(c, "__id").join(self.ranks, "__id").drop("__id").withColumnRenamed("__key", c)
        return out.select(*df.columns)


def _is_small(don: DataFrame, width: int, broadcast_bytes: int, most: float = math.inf) -> bool:
    n = don.count()
    return n <= most and n * (width + 2) * 8 <= broadcast_bytes


def _shipped(rec: DataFrame, don: DataFrame, block_rows: int, block_fn, schema: str, merge=None) -> DataFrame:
    """``block_fn(rec_pdf, don_pdf) -> pdf`` over blocks of receivers and a donor table of a measured,
    bounded size, which goes to every task; donors are visited ``DONOR_ROWS`` at a time and
    ``merge`` folds the results of two visits."""
    spark = rec.sparkSession
    bc = spark.sparkContext.broadcast(don.toPandas())
    # spread receivers so every core gets blocks to work on
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(rec.count() / block_rows))

    def run(it):
        d = bc.value
        for rpdf in it:
            for start in range(0, len(rpdf), block_rows):
                part, held = rpdf.iloc[start:start + block_rows], None
                for at in range(0, len(d), DONOR_ROWS):
                    out = block_fn(part, d.iloc[at:at + DONOR_ROWS])
                    if merge is None and len(out):
                        yield out
                    elif merge is not None:
                        held = out if held is None else merge(held, out)
                if held is not None and len(held):
                    yield held
    return rec.repartition(parts).mapInPandas(run, schema)


def _distances(units: index.Units, x: np.ndarray, metric: str = "euclidean", scaled: bool = False) -> np.ndarray:
    """Units against donors, over the features both have; infinite where there are none."""
    ss, shared = np.zeros((len(units.x), len(x))), np.zeros((len(units.x), len(x)))
    has_u, has_x = ~np.isnan(units.x), ~np.isnan(x)
    for i in np.flatnonzero(has_u.any(axis=0) & has_x.any(axis=0)):
        diff = units.x[:, i, None] - x[None, :, i]
        if has_u[:, i].all() and has_x[:, i].all():
            shared += 1
        else:
            both = has_u[:, i, None] & has_x[None, :, i]
            diff[~both] = 0.0
            shared += both
        ss += diff * diff if metric == "euclidean" else np.abs(diff)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, x.shape[1] * ss / shared if scaled else ss, np.inf)


def _indexed(rec: DataFrame, don: DataFrame, feats: list[str], targets: list[int] | None, k: int, scaled: bool, leaf_rows: int) -> DataFrame:
    """(rid, j, sid, dist2, v): candidates that hold the k nearest donors of every unit.

    Without ``targets`` a unit is a receiver, every row is a donor but the receiver itself."""
    tree = index.build(don, feats, leaf_rows)
    if tree is None:
        return rec.sparkSession.createDataFrame([], CAND_SCHEMA)
    used, need = list(range(len(feats))), k + (targets is None)

    def nearest(units, boxes):
        """The nearest nodes that hold enough comparable donors; all that hold any where there are too few."""
        low, top = boxes.distances(units.x, used, scaled=scaled)
        count = boxes.n if units.j < 0 else boxes.count[:, units.j]
        order = np.argsort(top, axis=1, kind="stable")
        sure = np.where(np.isfinite(np.take_along_axis(top, order, 1)), count[order], 0)
        before = np.cumsum(sure, axis=1) - sure
        wanted = np.zeros(low.shape, bool)
        np.put_along_axis(wanted, order, before < need, 1)
        # and those that lie next to the unit, so that the radius is near the true one
        close = np.lexsort((top, np.where(count > 0, low, np.inf)), axis=1)[:, :CLOSE]
        np.put_along_axis(wanted, close, True, 1)
        return units.state, wanted & np.isfinite(low) & (count > 0), None

    def within(units, boxes):
        low, _ = boxes.distances(units.x, used, scaled=scaled)
        count = boxes.n if units.j < 0 else boxes.count[:, units.j]
        return units.state, (low <= units.state[:, :1] * (1 + SLACK)) & np.isfinite(low) & (count > 0), None

    def scan(units, ids, x):
        if units.j >= 0:
            has = ~np.isnan(x[:, units.j])
            ids, x = ids[has], x[has]
        if not len(ids):
            return pd.DataFrame()
        dist = _distances(units, x, scaled=scaled)
        if units.j < 0:
            dist[units.rids[:, None] == ids[None, :]] = np.inf  # never a neighbour of itself
        if units.state.shape[1]:  # what lies behind the k-th donor found before (ids by their doubles, so never one too few)
            dist[(dist > units.state[:, :1]) | ((dist == units.state[:, :1]) & (ids[None, :] > units.state[:, 1:]))] = np.inf
        near = np.isfinite(dist)
        many = near.sum(axis=1) > k
        a, b = np.nonzero(near & ~many[:, None])
        if many.any():
            rows = np.flatnonzero(many)
            idx = _topk_idx(dist[rows], ids, k)
            a, b = np.concatenate((a, np.repeat(rows, k))), np.concatenate((b, idx.ravel()))
        return pd.DataFrame({"rid": units.rids[a], "j": np.int32(units.j), "sid": ids[b], "dist2": dist[a, b], "v": x[b, units.j] if units.j >= 0 else 0.0})

    units = index.units_of_holes(tree, rec, targets)
    first = index.scanned(tree, index.descend(tree, units, 0, nearest, nearest), 0, scan, CAND_SCHEMA)
    last = _merge_topk(first, k).where(F.col("rank") == k)
    radius = last.select(F.col("rid").alias("__id"), F.col("j").alias("__j"), F.col("dist2").alias("__s0"), F.col("sid").cast("double").alias("__s1"))
    bounded = cut(units.join(radius, ["__id", "__j"], "left").fillna(math.inf, ["__s0", "__s1"]))
    return index.scanned(tree, index.descend(tree, bounded, 2, within, within), 2, scan, CAND_SCHEMA)


def _topk_idx(dist: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Per row, indices of the k smallest (dist, id); inf distances are excluded later."""
    n = dist.shape[1]
    if n <= k:
        order = np.lexsort((np.broadcast_to(ids, dist.shape), dist), axis=1)
        return order
    part = np.argpartition(dist, k - 1, axis=1)[:, :k]
    pd_ = np.take_along_axis(dist, part, 1)
    kth = pd_.max(axis=1, keepdims=True)
    # rows whose k-th distance is tied with a donor left out need the slow path,
    # so that ties at the boundary go to the smaller id
    tied = (dist <= kth).sum(axis=1) > k
    o = np.lexsort((ids[part], pd_), axis=1)
    out = np.take_along_axis(part, o, 1)
    for i in np.nonzero(tied)[0]:
        cand = np.nonzero(dist[i] <= kth[i])[0]
        out[i] = cand[np.lexsort((ids[cand], dist[i, cand]))[:k]]
    return out


# ---------------------------------------------------------------- MOD1 missing-aware KNN

def _nan_euclid_block(feats: list[str], targets: list[int], k: int):
    d = len(feats)

    def fn(rp: pd.DataFrame, dp: pd.DataFrame) -> pd.DataFrame:
        Xr = rp[feats].to_numpy(dtype="float64")
        Xd = dp[feats].to_numpy(dtype="float64")
        Mr, Md = ~np.isnan(Xr), ~np.isnan(Xd)
        # differences themselves, feature by feature: no cancellation, and the order of SQL
        ss, shared = np.zeros((len(Xr), len(Xd))), np.zeros((len(Xr), len(Xd)))
        for i in range(d):
            both = Mr[:, i, None] & Md[None, :, i]
            diff = np.where(both, Xr[:, i, None] - Xd[None, :, i], 0.0)
            ss += diff * diff
            shared += both
        with np.errstate(divide="ignore", invalid="ignore"):
            dist2 = np.where(shared > 0, d * ss / shared, np.inf)
        rid = rp["__id"].to_numpy()
        sid = dp["__id"].to_numpy()
        outs = []
        for j in targets:
            ri = np.nonzero(~Mr[:, j])[0]
            di = np.nonzero(Md[:, j])[0]
            if len(ri) == 0 or len(di) == 0:
                continue
            sub = dist2[np.ix_(ri, di)]
            idx = _topk_idx(sub, sid[di], k)
            dd = np.take_along_axis(sub, idx, 1)
            ok = np.isfinite(dd)
            rows = np.repeat(ri, idx.shape[1]).reshape(idx.shape)
            outs.append(pd.DataFrame({
                "rid": rid[rows[ok]], "j": np.full(ok.sum(), j, dtype="int32"),
                "sid": sid[di][idx[ok]], "dist2": dd[ok], "v": Xd[di[idx[ok]], j]}))
        if not outs:
            return pd.DataFrame({"rid": [], "j": [], "sid": [], "dist2": [], "v": []})
        return pd.concat(outs, ignore_index=True)
    return fn


def _keep_best(k: int, keys: list[str], dist: str):
    """Merge of two visits' candidates: the k best by (distance, donor) per key."""
    def merge(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        both = pd.concat([x, y], ignore_index=True).sort_values([*keys, dist, "sid"], kind="mergesort")
        return both.groupby(keys, sort=False).head(k)
    return merge


def _merge_topk(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("rid", "j").orderBy("dist2", "sid")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _weighted(cand: DataFrame, weights: str) -> DataFrame:
    if weights == "uniform":
        return cand.groupBy("rid", "j").agg(F.avg("v").alias("fill"))
    d = F.sqrt("dist2")
    return cand.groupBy("rid", "j").agg(
        F.when(F.min("dist2") == 0, F.avg(F.when(F.col("dist2") == 0, F.col("v"))))
        .otherwise(F.sum(F.when(F.col("dist2") > 0, F.col("v") / d)) /
                   F.sum(F.when(F.col("dist2") > 0, F.lit(1.0) / d))).alias("fill"))


def _apply_fills(df: DataFrame, columns: list[str], cols: list[str], fills: DataFrame, fallback: dict) -> DataFrame:
    """``columns`` of ``df`` (numbered by __id), holes of ``cols`` filled."""
    wide = fills.groupBy("rid").agg(*[
        F.max(F.when(F.col("j") == i, F.col("fill"))).alias(f"__f{i}") for i in range(len(cols))])
    j = df.join(wide, df["__id"] == wide["rid"], "left")
    out = []
    for name in columns:
        if name in cols:
            i = cols.index(name)
            out.append(F.coalesce(clean(df, name).cast("double"), F.col(f"__f{i}"),
                                  F.lit(fallback.get(name))).alias(name))
        else:
            out.append(df[name])
    return j.select(*out)


class KNNModel(ImputerModel):
    def __init__(self, id_col, feats, targets, k, weights, donors, means, block_rows, broadcast_bytes, leaf_rows=LEAF_ROWS):
        self.id_col, self.feats, self.targets, self.k, self.weights = id_col, feats, targets, k, weights
        self.donors, self.means = donors, means
        self.block_rows, self.broadcast_bytes, self.leaf_rows = block_rows, broadcast_bytes, leaf_rows

    def candidates(self, df: DataFrame, k: int | None = None) -> DataFrame:
        """Of rows numbered by __id, the k best donors per hole."""
        k = k or self.k
        tj = [self.feats.index(c) for c in self.targets]
        any_hole = None
        for c in self.targets:
            h = clean(df, c).isNull()
            any_hole = h if any_hole is None else (any_hole | h)
        rec = df.where(any_hole).select("__id", *[clean(df, c).cast("double").alias(c) for c in self.feats])
        don = self.donors
        if _is_small(don, len(self.feats), self.broadcast_bytes, FEW_DONORS):
            cand = _shipped(rec, don, self.block_rows, _nan_euclid_block(self.feats, tj, k), CAND_SCHEMA, _keep_best(k, ["rid", "j"], "dist2"))
        elif _is_small(don, len(self.feats) - 1, HELD_BYTES):
            cand = _held_nearest(rec, don, self.feats, tj, k, True, self.leaf_rows)
        else:
            cand = _indexed(rec, don, self.feats, tj, k, True, self.leaf_rows)
        return _merge_topk(cand, k)

    def transform(self, df: DataFrame) -> DataFrame:
        numbered = _Ids(df, self.id_col).number(df)
        cand = self.candidates(numbered)
        fills = _weighted(cand, self.weights)
        # j indexes feats; map to target order
        tj = [self.feats.index(c) for c in self.targets]
        fills = fills.withColumn("j", F.array_position(F.array(*[F.lit(x) for x in tj]), F.col("j")) - 1)
        return _apply_fills(numbered, df.columns, self.targets, fills, self.means)


class KNNImputer(Imputer):
    """k nearest donors under the missing-aware Euclidean distance
    d(x, y)^2 = (n_features / n_shared) * sum over shared features of (x - y)^2.

    Donors for a column are the fitted rows that have it; ``weights='distance'``
    weighs donors by 1/d (zero-distance donors take all the weight); a hole
    with no comparable donor gets the column mean.
    """

    def __init__(self, id_col: str, n_neighbors: int = 5, weights: str = "uniform", columns=None,
                 features=None, exclude=(), block_rows: int = BLOCK_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
                 leaf_rows: int = LEAF_ROWS):
        if weights not in ("uniform", "distance"):
            raise ValueError("weights must be 'uniform' or 'distance'")
        if n_neighbors < 1:
            raise ValueError("n_neighbors must be >= 1")
        self.id_col, self.k, self.weights = id_col, n_neighbors, weights
        self.columns, self.features, self.exclude = columns, features, tuple(exclude)
        self.block_rows, self.broadcast_bytes, self.leaf_rows = block_rows, broadcast_bytes, leaf_rows

    def fit(self, df):
        self._check_input(df)
        feats = resolve_columns(df, self.features, "numeric", list(self.exclude) + [self.id_col])
        targets = resolve_columns(df, self.columns, "numeric", list(self.exclude) + [self.id_col])
        targets = [c for c in targets if c in feats]
        if not feats:
            raise ValueError("no numeric feature columns")
        row = df.agg(*[F.avg(clean(df, c)).alias(c) for c in targets]).first()
        means = {c: row[c] for c in targets}
        donors = _Ids(df, self.id_col).number(df).select("__id", *[clean(df, c).cast("double").alias(c) for c in feats])
        return KNNModel(self.id_col, feats, targets, self.k, self.weights, donors, means,
                        self.block_rows, self.broadcast_bytes, self.leaf_rows)


# ---------------------------------------------------------------- MOD2 enhanced KNN

NEIGH_SCHEMA = "rid long, sid long, ss double"


def _euclid_block(feats: list[str], k: int):
    def fn(rp: pd.DataFrame, dp: pd.DataFrame) -> pd.DataFrame:
        Xr = rp[feats].to_numpy(dtype="float64")
        Xd = dp[feats].to_numpy(dtype="float64")
        ss = np.zeros((len(Xr), len(Xd)))
        for i in range(len(feats)):  # feature by feature: the same summation order as SQL
            diff = Xr[:, i, None] - Xd[None, :, i]
            ss += diff * diff
        rid = rp["__id"].to_numpy()
        sid = dp["__id"].to_numpy()
        ss[rid[:, None] == sid[None, :]] = np.inf  # never a neighbour of itself
        idx = _topk_idx(ss, sid, k)
        dd = np.take_along_axis(ss, idx, 1)
        ok = np.isfinite(dd)
        rows = np.repeat(np.arange(len(rid)), idx.shape[1]).reshape(idx.shape)
        return pd.DataFrame({"rid": rid[rows[ok]], "sid": sid[idx[ok]], "ss": dd[ok]})
    return fn


class EnhancedKNNModel(ImputerModel):
    def __init__(self, id_col, dist_feats, num_cols, cat_cols, k, weights, means, modes,
                 block_rows, broadcast_bytes, leaf_rows=LEAF_ROWS):
        self.id_col, self.dist_feats, self.num_cols, self.cat_cols = id_col, dist_feats, num_cols, cat_cols
        self.k, self.weights, self.means, self.modes = k, weights, means, modes
        self.block_rows, self.broadcast_bytes, self.leaf_rows = block_rows, broadcast_bytes, leaf_rows

    def neighbours(self, df: DataFrame, k: int | None = None) -> DataFrame:
        """(rid, sid, dist, rank): the k nearest other rows of every row with a hole,
        in standardized mean-filled distance features."""
        k = k or self.k
        filled = [F.coalesce(clean(df, c).cast("double"), F.lit(self.means[c])) for c in self.dist_feats]
        st = df.agg(*[x for i, f in enumerate(filled) for x in
                      (F.avg(f).alias(f"m{i}"), F.stddev_pop(f).alias(f"s{i}"))]).first()
        z = []
        for i, (c, f) in enumerate(zip(self.dist_feats, filled)):
            sd = st[f"s{i}"] if st[f"s{i}"] else 1.0
            z.append(((f - F.lit(st[f"m{i}"])) / F.lit(sd)).alias(c))
        ids = _Ids(df, self.id_col)
        numbered = ids.number(df)
        allz = numbered.select("__id", *z)
        hole = None
        for c in self.num_cols + self.cat_cols:
            h = clean(df, c).isNull()
            hole = h if hole is None else (hole | h)
        rec = numbered.where(hole).select("__id", *z)
        if _is_small(allz, len(self.dist_feats), self.broadcast_bytes, FEW_DONORS):
            cand = _shipped(rec, allz, self.block_rows, _euclid_block(self.dist_feats, k), NEIGH_SCHEMA, _keep_best(k, ["rid"], "ss"))
        elif _is_small(allz, len(self.dist_feats) - 1, HELD_BYTES):
            cand = _held_nearest(rec, allz, self.dist_feats, None, k, False, self.leaf_rows).withColumnRenamed("dist2", "ss")
        else:
            cand = _indexed(rec, allz, self.dist_feats, None, k, False, self.leaf_rows).withColumnRenamed("dist2", "ss")
        w = Window.partitionBy("rid").orderBy("ss", "sid")
        best = (cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .select("rid", "sid", F.sqrt("ss").alias("dist"), "rank"))
        return ids.back(best, "rid", "sid")

    def fill_from(self, df: DataFrame, neigh: DataFrame) -> DataFrame:
        kind = neigh.schema["sid"].dataType
        vals = df.select(F.col(self.id_col).cast(kind).alias("sid"),
                         *[clean(df, c).alias(c) for c in self.num_cols + self.cat_cols])
        nv = neigh.join(vals, "sid")
        aggs = []
        for c in self.num_cols:
            v = F.col(c).cast("double")
            if self.weights == "distance":
                wgt = F.lit(1.0) / (F.col("dist") + F.lit(1e-10))
                aggs.append((F.sum(F.when(v.isNotNull(), wgt * v)) /
                             F.sum(F.when(v.isNotNull(), wgt))).alias(c))
            else:
                aggs.append(F.avg(v).alias(c))
        fills = nv.groupBy("rid").agg(*aggs) if aggs else nv.select("rid").distinct()
        for c in self.cat_cols:
            cnt = nv.where(F.col(c).isNotNull()).groupBy("rid", c).agg(F.count("*").alias("cnt"))
            m = cnt.groupBy("rid").agg(F.min_by(F.col(c), F.struct(-F.col("cnt"), F.col(c))).alias(c))
            fills = fills.join(m, "rid", "left")
        fills = fills.select("rid", *[F.col(c).alias(f"__f_{c}") for c in self.num_cols + self.cat_cols])
        j = df.join(fills, df[self.id_col].cast(kind) == fills["rid"], "left")
        out = []
        for name in df.columns:
            if name in self.num_cols:
                out.append(F.coalesce(clean(df, name).cast("double"), F.col(f"__f_{name}"),
                                      F.lit(self.means.get(name))).alias(name))
            elif name in self.cat_cols:
                out.append(F.coalesce(df[name], F.col(f"__f_{name}"),
                                      F.lit(self.modes.get(name))).alias(name))
            else:
                out.append(df[name])
        return j.select(*out)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fill_from(df, self.neighbours(df))


class EnhancedKNNImputer(Imputer):
    """k nearest rows in standardized, mean-filled distance features; then, per
    hole, the neighbours that have the value: numeric weighted by
    1/(d + 1e-10) (each neighbour by its own distance), categorical by mode.
    A row is never its own neighbour.  ``categorical_strategy='ignore'`` leaves
    string columns alone."""

    def __init__(self, id_col: str, n_neighbors: int = 5, weights: str = "distance", distance_features=None,
                 categorical_strategy: str = "mode", columns=None, exclude=(),
                 block_rows: int = BLOCK_ROWS, broadcast_bytes: int = BROADCAST_BYTES, leaf_rows: int = LEAF_ROWS):
        if categorical_strategy not in ("mode", "ignore"):
            raise ValueError("categorical_strategy must be 'mode' or 'ignore'")
        if weights not in ("uniform", "distance"):
            raise ValueError("weights must be 'uniform' or 'distance'")
        if n_neighbors < 1:
            raise ValueError("n_neighbors must be >= 1")
        self.id_col, self.k, self.weights = id_col, n_neighbors, weights
        self.distance_features, self.categorical_strategy = distance_features, categorical_strategy
        self.columns, self.exclude = columns, tuple(exclude)
        self.block_rows, self.broadcast_bytes, self.leaf_rows = block_rows, broadcast_bytes, leaf_rows

    def fit(self, df):
        self._check_input(df)
        ex = list(self.exclude) + [self.id_col]
        num = resolve_columns(df, self.columns, "numeric", ex)
        cat = [] if self.categorical_strategy == "ignore" else resolve_columns(
            df, None if self.columns is None else self.columns, "string", ex, warn=False)
        dist = resolve_columns(df, self.distance_features, "numeric", ex, warn=False)
        if not dist:
            raise ValueError("distance_features holds no numeric column")
        row = df.agg(*[F.avg(clean(df, c)).alias(c) for c in sorted(set(num + dist))]).first()
        means = row.asDict()
        from lacuna.operators.simple import column_modes
        modes = column_modes(df, cat)
        return EnhancedKNNModel(self.id_col, dist, num, cat, self.k, self.weights, means, modes,
                                self.block_rows, self.broadcast_bytes, self.leaf_rows)


# ---------------------------------------------------------------- MOD3 similarity partial mean
#
# Each hole takes the mean of its k = max(1, int(n_available * fraction)) most
# similar donors.  k grows with the table, so candidate lists are never built.
# With donors in every task, they lie in leaves of near rows: bounds of the leaves
# tell which are nearer than the k-th donor can be (added whole by their sums) and
# which may hold it (ranked by (distance, donor id) to take exactly the ones still
# needed).  Only fills leave the task.  With donors in a tree see ``_counted``.

SHARE_LEAF_ROWS = 128


class _Laid:
    """Donors of one column (j < 0: of all rows) in leaves of near rows that have the same features: places, leaf
    starts, boxes over ``others``, the features that count."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, j: int, order: np.ndarray, starts: np.ndarray, others: list[int] | None = None):
        self.others = [i for i in range(x.shape[1]) if i != j] if others is None else others
        self.x, self.ids, self.v = [np.ascontiguousarray(x[order, i]) for i in self.others], ids[order], x[order, j] if j >= 0 else np.zeros(len(order))
        self.starts, self.ends = starts, np.append(starts[1:], len(order))
        self.n, self.mean, self.var = self.ends - starts, None, None
        if len(order):
            self.sum = np.add.reduceat(self.v, starts)
            self.lo, self.hi = ([f.reduceat(c, starts) for c in self.x] for f in (np.minimum, np.maximum))
            self.point = self.n >= POINT_ROWS  # equal rows, in the order of their ids
            for lo, hi in zip(self.lo, self.hi):
                self.point &= (lo == hi) | np.isnan(lo)

    def places(self, leaves: np.ndarray, most: int | None = None) -> np.ndarray:
        """Places of the donors of some leaves; of equal rows the first ``most``."""
        n = self.n[leaves] if most is None else np.where(self.point[leaves], np.minimum(self.n[leaves], most), self.n[leaves])
        ends = np.cumsum(n)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[leaves] + n - ends, n)

    def bounds(self, rows: np.ndarray, metric: str):
        """Least and greatest distance of rows to the donors of every leaf; infinite without a shared feature."""
        low, top = np.zeros((len(rows), len(self.n))), np.zeros((len(rows), len(self.n)))
        shared = np.zeros(low.shape, bool)
        for c, lo, hi in zip(self.others, self.lo, self.hi):
            v = rows[:, c, None]
            both = ~np.isnan(v) & ~np.isnan(lo)[None, :]
            gap, far = np.maximum(np.maximum(lo - v, v - hi), 0.0), np.maximum(np.abs(v - lo), np.abs(v - hi))
            if metric == "euclidean":
                gap, far = gap * gap, far * far
            low += np.where(both, gap, 0.0)
            top += np.where(both, far, 0.0)
            shared |= both
        return np.where(shared, low, np.inf), np.where(shared, top, np.inf)

    def distances(self, row: np.ndarray, at: np.ndarray, metric: str) -> np.ndarray:
        """Unscaled squared Euclidean, or Manhattan, distance of a row to the donors at places ``at``, over
        the other columns both have; infinite if none."""
        ss, shared = np.zeros(len(at)), np.zeros(len(at), bool)
        for c, x in zip(self.others, self.x):
            if np.isnan(row[c]):
                continue
            diff = row[c] - x[at]
            both = diff == diff
            diff[~both] = 0.0
            ss += diff * diff if metric == "euclidean" else np.abs(diff)
            shared |= both
        return np.where(shared, ss, np.inf)

    def nearest_mean(self, rows: np.ndarray, low: np.ndarray, top: np.ndarray, ks: list[int], metric: str) -> list[float]:
        """Mean of the k nearest donors for every k: leaves nearer than the k-th can be are added whole, those
        that may hold it are ranked, ties by id.  Rows (of one id) share the k."""
        low, top, leaf = low.ravel(), top.ravel(), np.tile(np.arange(len(self.n)), len(rows))
        n = self.n[leaf]
        by_low, by_top = np.argsort(low), np.argsort(top)
        below_low, below_top = np.cumsum(n[by_low]), np.cumsum(n[by_top])
        out = []
        for k in ks:
            least = low[by_low[np.searchsorted(below_low, k)]] * (1 - SLACK)
            most = top[by_top[np.searchsorted(below_top, k)]] * (1 + SLACK)
            whole = top < least
            opened = np.flatnonzero(~whole & (low <= most))
            places, dists = [], []
            for i, row in enumerate(rows):
                places.append(self.places(leaf[opened[opened // len(self.n) == i]]))
                dists.append(self.distances(row, places[-1], metric))
            at, dist = np.concatenate(places), np.concatenate(dists)
            need = k - int(n[whole].sum())
            kth = np.partition(dist, need - 1)[need - 1]
            near, tied = dist < kth, at[dist == kth]
            tied = tied[np.argsort(self.ids[tied], kind="stable")[:need - int(near.sum())]]
            out.append((self.sum[leaf[whole]].sum() + self.v[at[near]].sum() + self.v[tied].sum()) / k)
        return out

    def _present(self, rows: np.ndarray) -> list[tuple[int, int]]:
        """Places in ``others`` and numbers of the features of rows that all have the same."""
        return [(i, c) for i, c in enumerate(self.others) if rows[0, c] == rows[0, c]]

    def _box(self, rows: np.ndarray, cols, metric: str):
        """Least and greatest distance of any of the rows to the donors of every leaf, and the number of shared features."""
        low, top, shared = (np.zeros(len(self.n)) for _ in range(3))
        for i, c in cols:
            lo, hi, least, most = self.lo[i], self.hi[i], rows[:, c].min(), rows[:, c].max()
            gap, far = np.maximum(np.maximum(lo - most, least - hi), 0.0), np.maximum(most - lo, hi - least)
            if metric == "euclidean":
                gap, far = gap * gap, far * far
            has = lo == lo
            low += np.where(has, gap, 0.0)
            top += np.where(has, far, 0.0)
            shared += has
        low[shared == 0] = top[shared == 0] = np.inf
        return low, top, shared

    def _row_bounds(self, rows: np.ndarray, cols, leaves: np.ndarray, metric: str):
        """Least and greatest distance of each of the rows to the donors of some leaves."""
        low, top, shared = np.zeros((len(rows), len(leaves))), np.zeros((len(rows), len(leaves))), np.zeros(len(leaves), bool)
        for i, c in cols:
            lo, hi = self.lo[i][leaves], self.hi[i][leaves]
            has, v = lo == lo, rows[:, c, None]
            under, over = lo - v, v - hi
            gap, far = np.maximum(under, over), np.maximum(-under, -over)
            np.maximum(gap, 0.0, out=gap)
            if metric == "euclidean":
                gap *= gap
                far *= far
            if not has.all():
                gap[:, ~has] = far[:, ~has] = 0.0
            low += gap
            top += far
            shared |= has
        low[:, ~shared] = top[:, ~shared] = np.inf
        return low, top

    def shares(self, rows: np.ndarray, ks: list[int], metric: str) -> np.ndarray:
        """Mean of the k nearest donors of every row and k; rows lie near each other and have the same features."""
        cols, out = self._present(rows), np.empty((len(rows), len(ks)))
        if not cols or (len(rows) > 1 and all((rows[:, c] == rows[0, c]).all() for _, c in cols)):
            out[:] = self.shares(rows[:1], ks, metric)[0] if len(rows) > 1 else self.nearest_mean(rows, *self.bounds(rows, metric), ks, metric)
            return out
        low, top, _ = self._box(rows, cols, metric)
        by_low, by_top = np.argsort(low), np.argsort(top)
        below_low, below_top = np.cumsum(self.n[by_low]), np.cumsum(self.n[by_top])
        for at, k in enumerate(ks):
            least = low[by_low[np.searchsorted(below_low, k)]] * (1 - SLACK)
            most = top[by_top[np.searchsorted(below_top, k)]] * (1 + SLACK)
            whole = top < least
            out[:, at] = (self.sum[whole].sum() + self._sums(rows, cols, np.flatnonzero(~whole & (low <= most)), k - int(self.n[whole].sum()), metric)) / k
        return out

    def _middles(self, rows: np.ndarray, cols, leaves: np.ndarray, metric: str) -> np.ndarray:
        """Of each of the rows, the mean distance to the donors of some leaves (under 'manhattan' nearly)."""
        if self.mean is None:
            self.mean = [np.add.reduceat(c, self.starts) / self.n for c in self.x]
            self.var = [np.add.reduceat((c - np.repeat(m, self.n)) ** 2, self.starts) / self.n for c, m in zip(self.x, self.mean)]
        out, shared = np.zeros((len(rows), len(leaves))), np.zeros(len(leaves), bool)
        for i, c in cols:
            mean, var = self.mean[i][leaves], self.var[i][leaves]
            diff = rows[:, c, None] - mean
            if metric == "euclidean":
                diff *= diff
                diff += var
            else:
                diff = np.maximum(np.abs(diff), 0.8 * np.sqrt(var))
            has = mean == mean
            if not has.all():
                diff[:, ~has] = 0.0
            out += diff
            shared |= has
        out[:, ~shared] = np.inf
        return out

    def _sums(self, rows: np.ndarray, cols, leaves: np.ndarray, need: int, metric: str) -> np.ndarray:
        """Sum of the ``need`` nearest donors among those of some leaves, row by row.  The mean distances of the leaves give
        a guess of the distance of the last one, and only leaves that reach into its neighbourhood are looked at; a
        guess that fails is moved by what was counted, and then gives way to the sure range."""
        n, low, top = self.n[leaves], *self._row_bounds(rows, cols, leaves, metric)
        middle = self._middles(rows, cols, leaves, metric)
        order = np.argsort(middle, axis=1)
        sums, left = np.zeros(len(rows)), np.arange(len(rows))
        g, moved = np.empty((len(rows), 2)), np.zeros(len(rows), np.int64)
        guess = np.empty((len(rows), 2), np.int64)
        for again in range(3):
            for i in left:
                if again == 2:
                    by_low, by_top = np.argsort(low[i]), np.argsort(top[i])
                    g[i] = (low[i, by_low[np.searchsorted(np.cumsum(n[by_low]), need)]] * (1 - SLACK),
                            top[i, by_top[np.searchsorted(np.cumsum(n[by_top]), need)]] * (1 + SLACK))
                    continue
                below = np.cumsum(n[order[i]])
                aim = min(max(need + moved[i], 1), below[-1])
                e = middle[i, order[i, np.searchsorted(below, aim)]]
                cut_ = n[(low[i] <= e) & (top[i] >= e)]
                margin = math.sqrt(np.dot(cut_, cut_)) + cut_.max(initial=0)
                at = np.searchsorted(below, (max(aim - margin, 1), min(aim + margin, below[-1])))
                at[1] = min(at[1], len(leaves) - 1)
                g[i], guess[i] = middle[i, order[i, at]], below[at]
            got, before, through = self._within(rows[left], cols, leaves, low[left], top[left], g[left], need, metric)
            sums[left] = got
            early, late = before >= need, through < need
            moved[left] = np.where(early, guess[left, 0] - before, guess[left, 1] - through)
            left = left[early | late]
            if not len(left):
                break
        return sums

    def _within(self, rows, cols, leaves, low, top, g, need, metric):
        """(sums of the ``need`` nearest, numbers of donors before and through the range ``g`` of each row): a row whose last
        one is not in its range has no sum."""
        n, s, point = self.n[leaves], self.sum[leaves], self.point[leaves]
        whole = top * (1 + SLACK) < g[:, :1]
        opened = ~whole & (low * (1 - SLACK) <= g[:, 1:])
        looked = opened.any(axis=0) & ~point
        points = np.flatnonzero(point)
        at = self.places(leaves[looked])
        mine = rows[:, [c for _, c in cols]]
        count, total = np.zeros(len(rows), np.int64), np.zeros(len(rows))  # below the range
        # distances by products of centred values, whose rounding is far below ``off``; those of the donors in the range are exact
        zero = mine - mine[0]
        off = SLACK * 1e-3 * ((zero * zero).sum(axis=1).max() + np.where(np.isfinite(g[:, 1]), g[:, 1], np.where(np.isfinite(g[:, 0]), g[:, 0], 0.0)))
        first, last = (g[:, 0] - off)[:, None], (g[:, 1] + off)[:, None]
        by_row = np.concatenate((zero * zero, -2 * zero, np.ones((len(rows), 1))), axis=1)
        pairs = []
        for a in range(0, len(at), LOOK_ROWS):
            b = at[a:a + LOOK_ROWS]
            x = np.stack([self.x[i][b] for i, _ in cols])
            gone = np.isnan(x)
            if metric == "euclidean":
                x -= mine[0][:, None]
                x[gone] = 0.0
                dist = by_row @ np.concatenate((~gone, x, (x * x).sum(axis=0, keepdims=True)))
            else:
                dist = np.zeros((len(rows), len(b)))
                for i, values in enumerate(x):
                    diff = np.abs(mine[:, i, None] - values)
                    if gone[i].any():
                        diff[:, gone[i]] = 0.0
                    dist += diff
            none = gone.all(axis=0)
            if none.any():
                dist[:, none] = np.inf
            below = dist < first
            count += np.count_nonzero(below, axis=1)
            total += below @ self.v[b]
            r, p = np.divmod(np.flatnonzero((dist <= last) ^ below), len(b))
            pairs.append((r, b[p]))
        r, p = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(r, kind="stable")
        r, p = r[order], p[order]
        dist, shared = np.zeros(len(r)), np.zeros(len(r), bool)
        for i, c in cols:
            diff = rows[r, c] - self.x[i][p]
            both = diff == diff
            diff[~both] = 0.0
            dist += diff * diff if metric == "euclidean" else np.abs(diff)
            shared |= both
        dist[~shared] = np.inf
        ends = np.searchsorted(r, np.arange(len(rows) + 1))
        sums, before, through = np.zeros(len(rows)), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for i in range(len(rows)):
            near, where = dist[ends[i]:ends[i + 1]], p[ends[i]:ends[i + 1]]
            full = whole[i] & ~looked
            full[points] = low[i, points] < g[i, 0]  # equal rows: their distance itself
            tied = points[(low[i, points] >= g[i, 0]) & (low[i, points] <= g[i, 1])]
            left = need - int(n[full].sum()) - int(count[i])
            before[i] = need - left + np.count_nonzero(near < g[i, 0])
            through[i] = need - left + np.count_nonzero(near <= g[i, 1]) + n[tied].sum()
            if before[i] >= need or through[i] < need:
                continue
            if len(tied):
                every, many = np.concatenate((near, low[i, tied])), np.concatenate((np.ones(len(near), np.int64), n[tied]))
                order = np.argsort(every, kind="stable")
                kth = every[order[np.searchsorted(np.cumsum(many[order]), left)]]
            else:
                kth = np.partition(near, left - 1)[left - 1]
            nearer, points_nearer = near < kth, tied[low[i, tied] < kth]
            left -= int(np.count_nonzero(nearer)) + int(n[points_nearer].sum())
            equal = where[near == kth]
            sums[i] = (s[full].sum() + total[i] + self.v[where[nearer]].sum() + s[points_nearer].sum()
                       + self._first_ids(self.ids[equal], self.v[equal], leaves[tied[low[i, tied] == kth]], left))
        return sums, before, through

    def _first_ids(self, ids: np.ndarray, v: np.ndarray, points: np.ndarray, need: int) -> float:
        """Sum of the ``need`` donors of smallest id among some and those of leaves of equal rows, which are in the order of ids."""
        if not len(points):
            return v[np.argsort(ids, kind="stable")[:need]].sum()
        spans = [slice(self.starts[p], self.ends[p]) for p in points]
        if need == len(ids) + int(self.n[points].sum()):
            return v.sum() + self.sum[points].sum()
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        least, most = (int(f([*(self.ids[p][i] for p in spans), *ids[i:i + 1 or None]])) for f, i in ((min, 0), (max, -1)))
        while least < most:  # the smallest id with which there are enough
            middle = (least + most) // 2
            if np.searchsorted(ids, middle, "right") + sum(np.searchsorted(self.ids[p], middle, "right") for p in spans) >= need:
                most = middle
            else:
                least = middle + 1
        total = 0.0
        for some, value in [(ids, v), *((self.ids[p], self.v[p]) for p in spans)]:
            sure = np.searchsorted(some, least, "left")
            total, need = total + value[:sure].sum(), need - sure
        for some, value in [(ids, v), *((self.ids[p], self.v[p]) for p in spans)]:
            a, b = np.searchsorted(some, least, "left"), np.searchsorted(some, least, "right")
            total, need = total + value[a:a + min(need, b - a)].sum(), need - min(need, b - a)
        return total

    def nearest(self, rids: np.ndarray, rows: np.ndarray, k: int, scaled: bool, itself: int):
        """(places of rows, places of donors, squared distances): the k nearest donors of every row; rows lie near each
        other and have the same features.  ``itself`` > 0: donors of a row's own id, so many at most, are none."""
        cols, d = self._present(rows), rows.shape[1]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not cols:
            return none
        low, top, shared = self._box(rows, cols, "euclidean")
        with np.errstate(divide="ignore", invalid="ignore"):
            rate = np.where(shared > 0, d / shared if scaled else 1.0, np.inf)
            low, top = np.where(shared > 0, low * rate, np.inf), np.where(shared > 0, top * rate, np.inf)
        some = np.flatnonzero(shared > 0)
        if not len(some):
            return none

        def pairs(leaves):
            at = self.places(leaves, k + itself)
            ss, both = np.zeros((len(rows), len(at))), np.zeros(len(at))
            for i, c in cols:
                values = self.x[i][at]
                diff = rows[:, c, None] - values
                gone = np.isnan(values)
                if gone.any():
                    diff[:, gone] = 0.0
                diff *= diff
                ss += diff
                both += ~gone
            if scaled:
                ss = d * ss / both
            if itself:
                ss[rids[:, None] == self.ids[at][None, :]] = np.inf
            return ss, at

        first = some if len(some) <= NEAR_LEAVES else some[np.argpartition(low[some] + top[some], NEAR_LEAVES)[:NEAR_LEAVES]]
        ss, at = pairs(first)
        radius = np.partition(ss, k - 1, axis=1)[:, k - 1] if len(at) >= k else np.full(len(rows), np.inf)
        best = best_at = None
        near = some[low[some] <= radius.max() * (1 + SLACK)]
        near = near[np.argsort(low[near], kind="stable")]
        begin = 0
        while begin < len(near):
            wide = np.cumsum(np.where(self.point[near[begin:]], np.minimum(self.n[near[begin:]], k + itself), self.n[near[begin:]]))
            end = begin + max(1, int(np.searchsorted(wide, DONOR_ROWS, "right")))
            leaves = near[begin:end]
            least = self._row_bounds(rows, cols, leaves, "euclidean")[0] * rate[leaves]
            leaves = leaves[(least <= radius[:, None] * (1 + SLACK)).any(axis=0)]
            begin = end
            if len(leaves):
                ss, at = pairs(leaves)
                pick = _topk_idx(ss, self.ids[at], k)
                got, got_at = np.take_along_axis(ss, pick, 1), at[pick]
                if best is not None:
                    got, got_at = np.concatenate((best, got), axis=1), np.concatenate((best_at, got_at), axis=1)
                    pick = np.lexsort((self.ids[got_at], got), axis=1)[:, :k]
                    got, got_at = np.take_along_axis(got, pick, 1), np.take_along_axis(got_at, pick, 1)
                best, best_at = got, got_at
                if best.shape[1] == k:
                    radius = np.minimum(radius, best[:, -1])
                    if begin < len(near) and low[near[begin]] > radius.max() * (1 + SLACK):
                        break
        if best is None:
            return none
        a, b = np.nonzero(np.isfinite(best))
        return a, best_at[a, b], best[a, b]


def _leaf_order(x: np.ndarray, j: int, leaf_rows: int, cols: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that have column j (j < 0: of all), leaf by leaf, and where leaves start.  Rows of one leaf have
    the same features of ``cols`` (all but j); leaves are halved along their widest one, which distances follow.
    Rows that are equal there stay in one leaf, in their order."""
    cols = [i for i in range(x.shape[1]) if i != j] if cols is None else cols
    places = np.flatnonzero(~np.isnan(x[:, j])) if j >= 0 else np.arange(len(x))
    if len(cols) <= 62:
        kind = np.zeros(len(places), np.int64)
        for bit, i in enumerate(cols):
            kind |= (~np.isnan(x[places, i])).astype(np.int64) << bit
        kind = np.unique(kind, return_inverse=True)[1]
    else:
        kind = np.unique(np.packbits(~np.isnan(x[places][:, cols]), axis=1), axis=0, return_inverse=True)[1].ravel()
    by_kind = np.argsort(kind, kind="stable")
    leaves = []
    for same in np.split(places[by_kind], np.flatnonzero(np.diff(kind[by_kind])) + 1):
        left, mine = [same] if len(same) else [], [i for i in cols if len(same) and x[same[0], i] == x[same[0], i]]
        while left:
            at = left.pop()
            if len(at) > 1 << 16:  # a column at a time
                span = np.array([np.ptp(x[at, i]) for i in mine] or [0.0])
            else:
                span = np.ptp(x[np.ix_(at, mine)], axis=0) if mine else np.zeros(1)
            if not span.any():
                leaves.append(np.sort(at))
                continue
            if len(at) <= leaf_rows:
                leaves.append(at)
                continue
            half = len(at) // 2
            order = np.argpartition(x[at, mine[int(span.argmax())]], half)
            left += [at[order[half:]], at[order[:half]]]
    if not leaves:
        return places.astype(np.int32), np.zeros(0, np.int64)
    return np.concatenate(leaves).astype(np.int32), np.cumsum([0, *map(len, leaves[:-1])])


def _blocks(ids: np.ndarray, x: np.ndarray, j: int, rows: np.ndarray, leaf_rows: int):
    """(laid donors, places of near rows that have the same features) for units of column j.  Donors, in the order of ids,
    are laid by the features of many units: what these units lack has no part in their distances."""
    others = [i for i in range(x.shape[1]) if i != j]
    order, starts = _leaf_order(rows, -1, BLOCK_UNITS, others)
    has, every, own = ~np.isnan(rows[:, others]), [], []
    blocks = np.split(order, starts[1:])
    for _, same in itertools.groupby(blocks, lambda b: has[b[0]].tobytes()):
        same = list(same)
        cols = [c for c, h in zip(others, has[same[0][0]]) if h]
        if cols and len(cols) < len(others) and sum(map(len, same)) >= max(OWN_UNITS, len(x) // OWN_SHARE):
            own.append((cols, same))
        else:
            every += same
    for cols, same in ([(None, every)] if every else []) + own:  # one order of the donors at a time
        laid = _Laid(x, ids, j, *_leaf_order(x, j, leaf_rows, cols), cols)
        for b in same:
            yield laid, b
        del laid


def _share_fills(ids, x, j, rids, rows, ks: list[int], metric: str, leaf_rows: int) -> pd.DataFrame:
    """(rid, j, f, fill) of units of column j, all of an id together."""
    order = np.argsort(rids, kind="stable")
    rids, rows = rids[order], rows[order]
    starts = np.flatnonzero(np.append(True, rids[1:] != rids[:-1]))
    ends = np.append(starts[1:], len(rids))
    fills = np.empty((len(starts), len(ks)))
    once = np.flatnonzero(ends - starts == 1)
    for laid, b in _blocks(ids, x, j, rows[starts[once]], leaf_rows):
        fills[once[b]] = laid.shares(rows[starts[once[b]]], ks, metric)
        del laid  # before the next is made
    again = np.flatnonzero(ends - starts > 1)
    if len(again):  # rows of one id share the k
        laid = _Laid(x, ids, j, *_leaf_order(x, j, leaf_rows))
        for u in again:
            mine = rows[starts[u]:ends[u]]
            fills[u] = laid.nearest_mean(mine, *laid.bounds(mine, metric), ks, metric)
    return pd.DataFrame({"rid": np.repeat(rids[starts], len(ks)), "j": np.int32(j),
                         "f": np.tile(np.arange(len(ks), dtype=np.int32), len(starts)), "fill": np.ravel(fills)})


FILL_SCHEMA = "rid long, j int, f int, fill double"


def _units(rec: DataFrame, cols: list[str], targets: list[int] | None, tasks: int) -> DataFrame:
    """A unit per missing target of every receiver (or one with __j = -1), near ones of one column in one task, all of an id too
    (fills of null ids would find no row)."""
    pattern = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    spread = rec.agg(*[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    wide = sorted(range(len(cols)), key=lambda i: -(spread[f"s{i}"] or 0.0))
    place = F.min(F.struct(pattern.alias("p"), F.coalesce(*[F.col(cols[i]) for i in wide]).alias("x"))).over(Window.partitionBy("__id"))
    j = F.lit(-1) if targets is None else F.explode(F.array_compact(F.array(*[F.when(F.col(cols[t]).isNull(), F.lit(t)) for t in targets])))
    order = ["__j", "__place", "__id"]
    return (rec.where(F.col("__id").isNotNull()).withColumn("__place", place).select(j.alias("__j"), "__place", "__id", *cols)
            .repartitionByRange(tasks, *order).sortWithinPartitions(*order))


def _by_column(j: np.ndarray, rids: np.ndarray, rows: np.ndarray):
    for one in np.unique(j):
        at = np.flatnonzero(j == one)
        yield int(one), rids[at], rows[at]


def _shared_out(rec: DataFrame, don: DataFrame, cols: list[str], available: list[int], fractions: list[float], metric: str,
                block_rows: int) -> DataFrame:
    """(rid, j, f, fill): mean of the nearest share of a donor table of a measured, bounded size, which goes to
    every task; a hole is filled where it lies."""
    spark = rec.sparkSession
    d = don.select(F.coalesce("__id", F.lit(LOW_ID)).alias("__id"), *cols).toPandas()
    ids, x = d["__id"].to_numpy(np.int64), d[cols].to_numpy(dtype="float64", na_value=np.nan)
    order = np.argsort(ids, kind="stable")
    held = spark.sparkContext.broadcast((ids[order], x[order]))
    ks, leaf_rows = [[max(1, int(n * f)) for f in fractions] if n else [] for n in available], SHARE_LEAF_ROWS
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(rec.count() / max(block_rows, HELD_UNITS // len(cols))))

    def run(it):
        got = list(it)
        if got:
            pdf = pd.concat(got, ignore_index=True)
            for j, rids, rows in _by_column(pdf["__j"].to_numpy(), pdf["__id"].to_numpy(np.int64), pdf[cols].to_numpy(dtype="float64", na_value=np.nan)):
                if ks[j]:
                    yield _share_fills(*held.value, j, rids, rows, ks[j], metric, leaf_rows)
    return _units(rec, cols, list(range(len(cols))), parts).drop("__place").mapInPandas(run, FILL_SCHEMA)


def _held(rec: DataFrame, don: DataFrame, cols: list[str], targets: list[int] | None, work, schema: str) -> DataFrame:
    """``work(ids, x, j, rids, rows) -> frames`` for the units of every column of a task, with all donors in the order of
    their ids.  Units near each other fill a task, and donors, of a measured, bounded size, stream into each of the
    few tasks there are."""
    spark, d = rec.sparkSession, len(cols)

    def packed(it):
        for pdf in it:
            yield pd.DataFrame({"n": [len(pdf)], "ids": [pdf["__id"].to_numpy(np.int64).tobytes()],
                                "rows": [np.ascontiguousarray(pdf[cols].to_numpy(dtype="float64", na_value=np.nan)).tobytes()]})

    def placed(it):
        from pyspark import TaskContext
        for pdf in it:
            yield pd.DataFrame({"grp": [TaskContext.get().partitionId()], "js": [pdf["__j"].to_numpy(np.int32).tobytes()],
                                "ids": [pdf["__id"].to_numpy(np.int64).tobytes()],
                                "rows": [np.ascontiguousarray(pdf[cols].to_numpy(dtype="float64", na_value=np.nan)).tobytes()]})

    donors = cut(don.select(F.coalesce("__id", F.lit(LOW_ID)).alias("__id"), *cols).mapInPandas(packed, "n long, ids binary, rows binary"))
    total = donors.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], schema)
    holes = [F.lit(1)] if targets is None else [F.col(cols[t]).isNull().cast("int") for t in targets]
    units = rec.agg(F.sum(sum(holes[1:], holes[0]))).first()[0] or 0
    many = max(spark.sparkContext.defaultParallelism, -(-units // HELD_UNITS))

    def run(it):
        ids, x, at, js, rids, rows = np.empty(total, np.int64), np.empty((total, d)), 0, [], [], []
        for b in it:
            for j, i, r in zip(b.column("js"), b.column("ids"), b.column("rows")):
                i, r = np.frombuffer(i.as_buffer(), np.int64), np.frombuffer(r.as_buffer(), np.float64).reshape(-1, d)
                if j.is_valid:
                    js.append(np.frombuffer(j.as_buffer(), np.int32).copy())
                    rids.append(i.copy())
                    rows.append(r.copy())
                else:
                    ids[at:at + len(i)], x[at:at + len(i)], at = i, r, at + len(i)
            b = i = r = j = None
        if js:
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            for c in range(d):
                x[:, c] = x[order, c]
            for j, mine, of in _by_column(np.concatenate(js), np.concatenate(rids), np.concatenate(rows)):
                for out in work(ids, x, j, mine, of):
                    yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    passed = donors.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("grp"), F.lit(None).cast("binary").alias("js"), "ids", "rows")
    both = _units(rec, cols, targets, many).drop("__place").mapInPandas(placed, "grp int, js binary, ids binary, rows binary").unionByName(passed)
    return both.repartitionById(many, "grp").mapInArrow(run, schema)


def _held_shares(rec: DataFrame, don: DataFrame, cols: list[str], available: list[int], fractions: list[float], metric: str, leaf_rows: int) -> DataFrame:
    """(rid, j, f, fill): mean of the nearest share, donors held by the tasks."""
    ks, leaf_rows = [[max(1, int(n * f)) for f in fractions] if n else [] for n in available], min(leaf_rows, SHARE_LEAF_ROWS)

    def work(ids, x, j, rids, rows):
        if ks[j]:
            yield _share_fills(ids, x, j, rids, rows, ks[j], metric, leaf_rows)
    return _held(rec, don, cols, list(range(len(cols))), work, FILL_SCHEMA)


def _held_nearest(rec: DataFrame, don: DataFrame, feats: list[str], targets: list[int] | None, k: int, scaled: bool, leaf_rows: int) -> DataFrame:
    """(rid, j, sid, dist2, v): the k nearest donors of every unit, donors held by the tasks.

    Without ``targets`` a unit is a receiver, every row is a donor but the receiver itself."""
    leaf_rows = min(leaf_rows, HELD_LEAF_ROWS)

    def work(ids, x, j, rids, rows):
        itself = 0
        if j < 0:  # how often an id comes at most
            itself = int(np.diff(np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))).max())
        elif np.isnan(x[:, j]).all():
            return

        def frames():
            for laid, b in _blocks(ids, x, j, rows, leaf_rows):
                for part in np.array_split(b, -(-len(b) // BLOCK_UNITS)):
                    a, at, dist = laid.nearest(rids[part], rows[part], k, scaled, itself)
                    yield pd.DataFrame({"rid": rids[part[a]], "j": np.int32(j), "sid": laid.ids[at], "dist2": dist, "v": laid.v[at]})
                del laid  # before the next is made
        yield from index.gathered(frames())
    return _held(rec, don, feats, targets, work, CAND_SCHEMA)


# Range counting: a unit (a hole and a fraction) looks for the distance of its k-th donor.  Units lie in
# groups of neighbours, one task each; every round the leaves stream past each group, and a unit counts
# what lies below its range and, in bins, what lies in it.  The bin that holds the k-th donor is its next
# range; when FEW donors are left they are ranked.  The first range is a guess from the boxes of the tree,
# the sure one follows if the k-th donor is not in it.  Between rounds only units are written, and a round
# moves each leaf once per group.
RANGE_BINS = 128
FEW = 256  # donors left in a range that are ranked one by one
GROUP_UNITS = 32768  # units of a group: its task holds their bins or their FEW donors
LEAST_UNITS = 256  # units that are worth a group
GUESS = 0.04  # share of the donors on either side of the guessed distance
LOOK = 512  # units that look at a leaf together
LOW_ID, HIGH_ID = -(1 << 63), (1 << 63) - 1

#: rows of units (kind 0), a leaf (1) or fills (2) in bytes
RANGED = "grp int, kind int, j int, ids binary, rows binary"


def _keys(distance: np.ndarray) -> np.ndarray:
    """Distances (0 or more) as integers in the same order."""
    return np.ascontiguousarray(distance, np.float64).view(np.int64)


def _unit_type(d: int) -> np.dtype:
    """A row of a unit: its range (distances, then ids among equals), the sure range, n donors in the range
    (-1: not counted), ``before`` and ``sbefore`` of those below."""
    return np.dtype([("rid", "i8"), ("f", "i8"), ("k", "i8"), ("lo", "f8"), ("hi", "f8"), ("slo", "f8"), ("shi", "f8"), ("ilo", "i8"), ("ihi", "i8"),
                     ("n", "i8"), ("before", "i8"), ("sbefore", "f8"), ("x", "f8", (d,))])


def _first_ranges(units: np.ndarray, rows: np.ndarray, u: np.ndarray, j: int, top: index.Boxes, metric: str):
    """Sure and guessed ranges of units (rows of unit i: u == i) by the top of the tree."""
    count, used = top.count[:, j], [i for i in range(rows["x"].shape[1]) if i != j]
    margin = max(GUESS, 4 / len(count)) * count.sum()
    with np.errstate(invalid="ignore"):
        means = top.sum / np.where(top.count > 0, top.count, np.nan)
    by_unit = np.argsort(u, kind="stable")
    starts = np.append(np.flatnonzero(np.append(True, np.diff(u[by_unit]) > 0)), len(u))

    def ranked(bound, counts, ks):
        """The bounds at which the counts reach ks."""
        order = np.argsort(bound)
        reached = np.minimum(np.searchsorted(np.cumsum(counts[order]), ks), len(order) - 1)
        return bound[order[reached]]

    for a in range(0, len(units), 256):
        b = min(a + 256, len(units))
        low, high = top.distances(rows["x"][by_unit[starts[a]:starts[b]]], used, metric)
        middle = np.zeros(low.shape)
        for i in used:  # to the mean of a node's rows
            diff = np.abs(rows["x"][by_unit[starts[a]:starts[b]], i][:, None] - means[None, :, i])
            middle += np.nan_to_num(diff * diff if metric == "euclidean" else diff)
        middle = np.where(np.isfinite(low), middle, np.inf)
        for i in range(a, b):
            mine = slice(starts[i] - starts[a], starts[i + 1] - starts[a])
            counts, k = np.tile(count, mine.stop - mine.start), units["k"][i]
            slo = ranked(low[mine].ravel(), counts, k) * (1 - SLACK)
            shi = ranked(high[mine].ravel(), counts, k) * (1 + SLACK)
            lo, hi = ranked(middle[mine].ravel(), counts, [max(k - margin, 1), min(k + margin, counts.sum())])
            units["slo"][i], units["shi"][i] = slo, shi
            units["lo"][i], units["hi"][i] = min(max(lo, slo), shi), max(min(hi, shi), slo)


class _Ranged:
    """Units of one column and group while the leaves stream past."""

    def __init__(self, j: int, rows: np.ndarray, top: index.Boxes, metric: str, bins: int, few: int):
        self.j, self.rows, self.metric, self.bins, self.few = j, rows, metric, bins, few
        # receivers of one id share a unit
        order = np.lexsort((rows["rid"], rows["f"]))
        new = np.append(True, (np.diff(rows["rid"][order]) != 0) | (np.diff(rows["f"][order]) != 0))
        self.u = np.empty(len(rows), np.int64)
        self.u[order] = np.cumsum(new) - 1
        self.units = s = rows[order[new]]
        if np.isnan(s["lo"]).any():
            _first_ranges(s, rows, self.u, j, top, metric)
        self.counting, self.listing = s["n"] < 0, (s["n"] >= 0) & (s["n"] <= few)
        self.others = [i for i in range(rows["x"].shape[1]) if i != j]
        self.x = {i: np.ascontiguousarray(rows["x"][:, i]) for i in self.others}
        self.has = {i: ~np.isnan(self.x[i]) for i in self.others}
        self.lo, self.hi = s["lo"][self.u], s["hi"][self.u]
        self.n, self.s = np.zeros(len(rows), np.int64), np.zeros(len(rows))  # below the range, per row
        # bins of the units that are not ranked in this round: equal steps of the distance (of its root in a wide
        # range, of its key in an endless one), or of the id among equals of one distance
        self.one = s["lo"] == s["hi"]
        self.step = np.where(np.isinf(s["hi"]), 2, np.where(s["hi"] > 4 * s["lo"], 1, 0))
        every = np.arange(len(s))
        self.least = self._steps(s["lo"], every)
        self.span = np.where(self.one, 1.0, self._steps(s["hi"], every) - self.least)
        self.id_width = (s["ihi"].astype(np.uint64) - s["ilo"].astype(np.uint64)) // np.uint64(bins) + np.uint64(1)
        self.slot = np.cumsum(~self.listing) - 1
        size = int((~self.listing).sum()) * bins
        self.bin_n, self.bin_s = np.zeros(size, np.int64), np.zeros(size)
        self.bin_lo, self.bin_hi = np.full(size, HIGH_ID), np.full(size, LOW_ID)
        self.listed = []

    def _steps(self, dist: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Distances of units u on the scale of their bins, in the same order."""
        step = self.step[u]
        out = np.where(step == 1, np.sqrt(dist), dist)
        if (step == 2).any():
            out = np.where(step == 2, _keys(dist).astype(np.float64), out)
        return out

    def visit(self, ids: np.ndarray, x: np.ndarray):
        """Donors of a leaf: added whole where all are below the range, looked at where some may be in it."""
        at = ~np.isnan(x[:, self.j])
        if not at.any():
            return
        ids, x, m = ids[at], x[at], len(self.rows)
        v, has = x[:, self.j], ~np.isnan(x)
        low, top, sure, may = np.zeros(m), np.zeros(m), np.zeros(m, bool), np.zeros(m, bool)
        for i in self.others:
            if not has[:, i].any():
                continue
            c, both, least, greatest = self.x[i], self.has[i], np.nanmin(x[:, i]), np.nanmax(x[:, i])
            gap, far = np.maximum(np.maximum(least - c, c - greatest), 0.0), np.maximum(np.abs(c - least), np.abs(c - greatest))
            if self.metric == "euclidean":
                gap, far = gap * gap, far * far
            top += np.where(both, far, 0.0)
            may |= both
            if has[:, i].all():
                low += np.where(both, gap, 0.0)
                sure |= both
        low, top = np.where(may, low, np.inf) * (1 - SLACK), np.where(sure, top, np.inf) * (1 + SLACK)
        below = top < self.lo
        self.n[below] += len(ids)
        self.s[below] += v.sum()
        opened = np.flatnonzero(~below & (low <= self.hi))
        for a in range(0, len(opened), LOOK):
            self._look(opened[a:a + LOOK], ids, x, v, has)

    def _distances(self, r: np.ndarray, x: np.ndarray, has: np.ndarray) -> np.ndarray:
        ss, none = np.zeros((len(r), len(x))), np.ones((len(r), len(x)), bool)
        for i in self.others:
            if not has[:, i].any() or not self.has[i][r].any():
                continue
            diff = self.x[i][r][:, None] - x[None, :, i]
            if has[:, i].all() and self.has[i][r].all():
                none = None
            else:
                missing = np.isnan(diff)
                diff[missing] = 0.0
                if none is not None:
                    none &= missing
            if self.metric == "euclidean":
                diff *= diff
            else:
                np.abs(diff, out=diff)
            ss += diff
        if none is not None:
            ss[none] = np.inf
        return ss

    def _look(self, r, ids, x, v, has):
        dist, u = self._distances(r, x, has), self.u[r]
        below = dist < self.lo[r, None]
        inside = ~below & (dist <= self.hi[r, None])
        at = np.flatnonzero(self.one[u])
        if len(at):
            first, last = self.units["ilo"][u[at], None], self.units["ihi"][u[at], None]
            below[at] |= inside[at] & (ids[None, :] < first)
            inside[at] &= (ids[None, :] >= first) & (ids[None, :] <= last)
        if self.counting.any():
            self.n[r] += below.sum(axis=1)
            self.s[r] += below @ v
        a, b = np.nonzero(inside)
        if not len(a):
            return
        u, dist = u[a], dist[a, b]
        few = self.listing[u]
        if few.any():
            self.listed.append((u[few], dist[few], ids[b[few]], v[b[few]]))
            u, dist, b = u[~few], dist[~few], b[~few]
        value, one = _keys(dist), np.flatnonzero(self.one[u])
        bin_ = np.minimum(((self._steps(dist, u) - self.least[u]) / self.span[u] * self.bins).astype(np.int64), self.bins - 1)
        if len(one):
            value[one] = ids[b[one]]
            first = self.units["ilo"][u[one]].astype(np.uint64)
            bin_[one] = ((value[one].astype(np.uint64) - first) // self.id_width[u[one]]).astype(np.int64)
        slot = self.slot[u] * self.bins + bin_
        np.add.at(self.bin_n, slot, 1)
        np.add.at(self.bin_s, slot, v[b])
        np.minimum.at(self.bin_lo, slot, value)
        np.maximum.at(self.bin_hi, slot, value)

    def result(self):
        """(rows of units that go on, fills of the others by unit number)."""
        s, total = self.units, len(self.units)
        before = s["before"] + np.where(self.counting, np.bincount(self.u, self.n, total), 0).astype(np.int64)
        sbefore = s["sbefore"] + np.where(self.counting, np.bincount(self.u, self.s, total), 0.0)
        fills = np.full(total, np.nan)
        done = self.listing.copy()
        if self.listed:
            u, dist, ids, v = (np.concatenate(c) for c in zip(*self.listed))
            order = np.lexsort((ids, dist, u))
            u, v = u[order], v[order]
            rank = np.arange(len(u)) - np.searchsorted(u, u)
            taken = rank < (s["k"] - before)[u]
            fills = (sbefore + np.bincount(u[taken], v[taken], total)) / s["k"]
        at = np.flatnonzero(~self.listing)
        n, sums, lo, hi = (c.reshape(-1, self.bins) for c in (self.bin_n, self.bin_s, self.bin_lo, self.bin_hi))
        reached = before[at, None] + np.cumsum(n, axis=1)
        missed = (s["k"][at] <= before[at]) | (s["k"][at] > reached[:, -1])
        # the guess was wrong: count again in the part of the sure range where the k-th donor must be
        m = at[missed]
        under = s["k"][m] <= before[m]
        s["shi"][m], s["slo"][m] = np.where(under, np.nextafter(s["lo"][m], 0.0), s["shi"][m]), np.where(under, s["slo"][m], np.nextafter(s["hi"][m], np.inf))
        s["lo"][m], s["hi"][m], s["n"][m] = s["slo"][m], s["shi"][m], -1
        # the others: the bin that holds it
        f, h = at[~missed], np.flatnonzero(~missed)
        bin_ = (reached[h] >= s["k"][f, None]).argmax(axis=1)
        n, sums, lo, hi, here = n[h, bin_], sums[h, bin_], lo[h, bin_], hi[h, bin_], np.arange(self.bins)[None, :] < bin_[:, None]
        s["before"][f] = before[f] + (self.bin_n.reshape(-1, self.bins)[h] * here).sum(axis=1)
        s["sbefore"][f] = sbefore[f] + (self.bin_s.reshape(-1, self.bins)[h] * here).sum(axis=1)
        s["n"][f] = n
        one = self.one[f]
        s["ilo"][f], s["ihi"][f] = np.where(one, lo, s["ilo"][f]), np.where(one, hi, s["ihi"][f])
        s["lo"][f] = np.where(one, s["lo"][f], np.ascontiguousarray(lo).view(np.float64))
        s["hi"][f] = np.where(one, s["hi"][f], np.ascontiguousarray(hi).view(np.float64))
        # donors of one distance and id: no order is left among them
        equal = one & (lo == hi)
        e = f[equal]
        fills[e] = (s["sbefore"][e] + sums[equal] * (s["k"][e] - s["before"][e]) / n[equal]) / s["k"][e]
        done[e] = True
        rows = s[self.u]
        rows["x"] = self.rows["x"]
        return rows[~done[self.u]], s[done], fills[done]


def _counted(rec: DataFrame, don: DataFrame, cols: list[str], available: list[int], fractions: list[float], metric: str, leaf_rows: int) -> DataFrame:
    """(rid, j, f, fill): mean of the nearest share of donors by range counting on a tree."""
    spark, d = rec.sparkSession, len(cols)
    tree = index.build(don, cols, leaf_rows, wide=True)
    if tree is None or rec.isEmpty():
        return spark.createDataFrame([], "rid long, j int, f int, fill double")
    ks = [[max(1, int(n * f)) if n else 0 for f in fractions] for n in available]
    unit, bins, few, top = _unit_type(d), RANGE_BINS, FEW, spark.sparkContext.broadcast(tree.top)
    ends = don.agg(F.min("__id").alias("lo"), F.max("__id").alias("hi")).first()
    ilo, ihi = ends["lo"], ends["hi"]
    # rows of one id in one group (fills of null ids would find no row)
    place = F.min(F.struct("__pattern", "__code")).over(Window.partitionBy("__j", "__id"))
    holes = index.units_of_holes(tree, rec, list(range(d))).where("__id IS NOT NULL").withColumn("__place", place)
    parallel = spark.sparkContext.defaultParallelism

    def groups(n):
        return max(1, min(max(parallel, -(-n // GROUP_UNITS)), -(-n // LEAST_UNITS)))

    def packed(it):
        from pyspark import TaskContext
        for pdf in it:
            for j, part in pdf.groupby("__j"):
                for f, k in enumerate(ks[j]):
                    if k:
                        rows = np.zeros(len(part), unit)
                        rows["rid"], rows["x"] = part["__id"].to_numpy(np.int64), part[cols].to_numpy(dtype="float64", na_value=np.nan)
                        rows["f"], rows["k"], rows["lo"], rows["hi"], rows["ilo"], rows["ihi"], rows["n"] = f, k, np.nan, np.nan, ilo, ihi, -1
                        yield pd.DataFrame({"grp": [TaskContext.get().partitionId()], "kind": 0, "j": j, "ids": None, "rows": rows.tobytes()})

    def look(it):
        held, work, grp = {}, None, 0
        for pdf in it:
            for r in pdf.itertuples(index=False):
                if r.kind == 0:
                    held.setdefault(r.j, []).append(np.frombuffer(r.rows, unit))
                    grp = r.grp
                    continue
                if work is None:
                    work = [_Ranged(j, np.concatenate(rows), top.value, metric, bins, few) for j, rows in held.items()]
                    held = {}
                for w in work:
                    w.visit(np.frombuffer(r.ids, np.int64), np.frombuffer(r.rows, np.float64).reshape(-1, d))
        for w in work or []:
            rest, done, fills = w.result()
            if len(rest):
                yield pd.DataFrame({"grp": [grp], "kind": 0, "j": w.j, "ids": None, "rows": rest.tobytes()})
            if len(done):
                got = np.stack([done["rid"], done["f"]], axis=1)
                yield pd.DataFrame({"grp": [grp], "kind": 2, "j": w.j, "ids": got.tobytes(), "rows": fills.tobytes()})

    def opened(it):
        for pdf in it:
            for r in pdf.itertuples(index=False):
                got = np.frombuffer(r.ids, np.int64).reshape(-1, 2)
                yield pd.DataFrame({"rid": got[:, 0], "j": np.int32(r.j), "f": got[:, 1].astype(np.int32), "fill": np.frombuffer(r.rows, np.float64)})

    order = ["__j", "__place", "__id"]
    near = holes.repartitionByRange(groups(holes.count() * len(fractions)), *order).sortWithinPartitions(*order)
    left, out = cut(near.select("__j", "__id", *cols).mapInPandas(packed, RANGED)), []
    while True:
        n = left.agg(F.sum(F.length("rows"))).first()[0]
        if not n:
            break
        alive = sorted(r["grp"] for r in left.select("grp").distinct().collect())  # a number per group
        many = min(groups(n // unit.itemsize), len(alive))
        at = {g: i % many for i, g in enumerate(alive)}
        dealt = F.element_at(F.array(*[F.lit(at.get(g, 0)) for g in range(alive[-1] + 1)]), F.col("grp") + 1)
        passed = tree.leaves.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("grp"), F.lit(1).alias("kind"), F.lit(-1).alias("j"),
                                    "ids", F.col("x").alias("rows"))
        both = left.withColumn("grp", dealt).unionByName(passed)
        got = cut(both.repartitionById(many, "grp").sortWithinPartitions("grp", "kind", "j").mapInPandas(look, RANGED))
        out.append(got.where("kind = 2"))
        left = got.where("kind = 0")
    fills = spark.createDataFrame([], RANGED)
    for o in out:
        fills = fills.unionByName(o)
    return fills.mapInPandas(opened, "rid long, j int, f int, fill double")


class SimilarityPartialMeanModel(ImputerModel):
    def __init__(self, id_col, cols, fraction, means, block_rows, broadcast_bytes, metric="euclidean", leaf_rows=LEAF_ROWS):
        self.id_col, self.cols, self.fraction, self.metric = id_col, cols, fraction, metric
        self.means, self.block_rows, self.broadcast_bytes, self.leaf_rows = means, block_rows, broadcast_bytes, leaf_rows

    def _fills(self, df: DataFrame, fractions: list[float]) -> DataFrame:
        """(rid, j, f, fill) of rows numbered by __id for every fraction f: the distance histograms
        are computed once and shared; pass 2 emits the donors of every boundary bin."""
        cols = self.cols
        sel = ["__id"] + [clean(df, c).cast("double").alias(c) for c in cols]
        hole = None
        for c in cols:
            h = clean(df, c).isNull()
            hole = h if hole is None else (hole | h)
        rec = df.where(hole).select(*sel)
        don = df.select(*sel)
        n_avail = df.agg(*[F.count(clean(df, c)).alias(c) for c in cols]).first()
        available = [n_avail[c] for c in cols]
        if _is_small(don, len(cols), self.broadcast_bytes):
            return _shared_out(rec, don, cols, available, fractions, self.metric, self.block_rows)
        if _is_small(don, len(cols) - 1, HELD_BYTES):
            return _held_shares(rec, don, cols, available, fractions, self.metric, self.leaf_rows)
        return _counted(rec, don, cols, available, fractions, self.metric, self.leaf_rows)

    def _fallback(self):
        return {c: (self.means[c] if self.means.get(c) is not None else 0.0) for c in self.cols}

    def transform(self, df: DataFrame) -> DataFrame:
        numbered = _Ids(df, self.id_col).number(df)
        fills = self._fills(numbered, [self.fraction]).drop("f")
        return _apply_fills(numbered, df.columns, self.cols, fills, self._fallback())

    def sweep(self, df: DataFrame, fractions: list[float]) -> dict[float, DataFrame]:
        """Filled tables for several subset fractions from one pair of block passes (EVL23)."""
        numbered = _Ids(df, self.id_col).number(df)
        fills = cut(self._fills(numbered, list(fractions)))
        return {frac: _apply_fills(numbered, df.columns, self.cols, fills.where(F.col("f") == fi).drop("f"),
                                   self._fallback())
                for fi, frac in enumerate(fractions)}


class SimilarityPartialMeanImputer(Imputer):
    """Mean of the most similar fraction of donors (MOD3).

    Distance: unscaled Euclidean ('euclidean') or city-block ('manhattan') over the
    other columns both rows have (no shared column: infinitely far).  Ties go to the smaller donor id.
    """

    def __init__(self, id_col: str, subset_size: float = 0.3, similarity_metric: str = "euclidean",
                 columns=None, exclude=(), block_rows: int = BLOCK_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
                 leaf_rows: int = LEAF_ROWS):
        if similarity_metric not in ("euclidean", "manhattan"):
            raise ValueError(f"similarity_metric is euclidean or manhattan, not {similarity_metric!r}")
        if not 0 < subset_size <= 1:
            raise ValueError("subset_size must be in (0, 1]")
        self.id_col, self.fraction, self.metric = id_col, subset_size, similarity_metric
        self.columns, self.exclude = columns, tuple(exclude)
        self.block_rows, self.broadcast_bytes, self.leaf_rows = block_rows, broadcast_bytes, leaf_rows

    def fit(self, df):
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", list(self.exclude) + [self.id_col])
        row = df.agg(*[F.avg(clean(df, c)).alias(c) for c in cols]).first()
        return SimilarityPartialMeanModel(self.id_col, cols, self.fraction, row.asDict(),
                                          self.block_rows, self.broadcast_bytes, self.metric, self.leaf_rows)
