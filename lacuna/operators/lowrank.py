"""Low-rank (SVD) fills on pattern moments (MOD4-MOD6).

The right singular vectors of the (standardized or centered) completed table
are the eigenvectors of its d x d Gram matrix, which the per-pattern moments
give exactly; the rank-k reconstruction of the holes is an affine map per
pattern.  With more patterns than fit on the driver, each iteration is a pass
in which tasks build the maps of the patterns they meet: the same iteration,
the same answer.  Nothing of size n is ever on the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean, resolve_columns
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.operators.gaussian import MODES, table_pays
from lacuna.operators.moments import PatternMoments, TooManyPatterns, missing_patterns
from lacuna.session import cut


def _top_eig(G: np.ndarray, k: int):
    vals, vecs = np.linalg.eigh((G + G.T) / 2)
    order = np.argsort(vals)[::-1]
    return np.maximum(vals[order], 0.0), vecs[:, order][:, :k]


def _projection(G: np.ndarray, k: int, center: bool):
    """(mean, rank-k projection, singular values) from the Gram matrix of [1, u]."""
    n = G[0, 0]
    mu = G[0, 1:] / n if center else np.zeros(len(G) - 1)
    vals, vk = _top_eig(G[1:, 1:] - n * np.outer(mu, mu), k)
    return mu, vk @ vk.T, np.sqrt(vals)


def chain_map(miss: np.ndarray, chain) -> np.ndarray:
    """Map of a missing pattern on [1, u] (holes 0) after the given reconstructions: holes start
    at the mean, and each step replaces them by mu + P (u - mu)."""
    d = len(miss)
    W = np.hstack([np.zeros((d, 1)), np.diag((~miss).astype(float))])
    for mu, P in chain:
        W = one_step(W, miss, mu, P)
    return W


def one_step(W: np.ndarray, miss: np.ndarray, mu: np.ndarray, P: np.ndarray) -> np.ndarray:
    C = W.copy()
    C[:, 0] -= mu
    R = P[miss] @ C
    R[:, 0] += mu[miss]
    out = W.copy()
    out[miss] = R
    return out


class LowRankModel(ImputerModel):
    """The fitted chain of reconstructions; ``transform`` replays it for whatever patterns a task
    meets, so new rows, new patterns and newly missing columns are filled like fitted ones."""

    def __init__(self, cols, m_u, s_u, chain, singular_values):
        self.cols, self.m_u, self.s_u, self.chain = cols, m_u, s_u, chain
        self.n_iter_, self.singular_values_ = len(chain), singular_values

    def transform(self, df: DataFrame) -> DataFrame:
        cols = self.cols
        bc = df.sparkSession.sparkContext.broadcast((self.m_u, self.s_u, self.chain))
        names = df.columns
        base = df.select(*[clean(df, c).cast("double").alias(c) if c in cols else F.col(c) for c in names])

        def run(it):
            m_u, s_u, chain = bc.value
            known = {}
            for pdf in it:
                X = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
                filled = np.where(np.isnan(X), _replayed((X - m_u) / s_u, chain, known) * s_u + m_u, X)
                for j, c in enumerate(cols):
                    pdf[c] = filled[:, j]
                yield pdf
        return base.mapInPandas(run, base.schema)

    def explained_variance(self, spark) -> DataFrame:
        """Component, singular value, share of s^2 and running share (MOD6)."""
        s = np.asarray(self.singular_values_, dtype=float)
        tot = float((s ** 2).sum()) or 1.0
        cum = np.cumsum(s ** 2) / tot
        rows = [(i + 1, float(v), float(v * v / tot), float(c)) for i, (v, c) in enumerate(zip(s, cum))]
        return spark.createDataFrame(rows, "component int, singular_value double, explained_ratio double, "
                                           "cumulative_ratio double")


def _replayed(U: np.ndarray, chain, known: dict) -> np.ndarray:
    """Rows in working units (holes NaN) completed by the chain; maps are kept in ``known``."""
    M = np.isnan(U)
    out = np.where(M, 0.0, U)
    for rows, miss in missing_patterns(M):
        key = miss.tobytes()
        W = known.get(key)
        if W is None:
            if len(known) >= 4096:
                known.clear()
            W = known[key] = chain_map(miss, chain)[miss]
        out[np.ix_(rows, miss)] = W[:, 0] + out[rows] @ W[:, 1:].T
    return out


class SVDImputer(Imputer):
    """Rank-k matrix completion.

    ``center=False, scale=True`` (package variant): mean fill, standardize, then
    repeat the uncentered rank-k reconstruction of the holes until the Frobenius
    change (standardized units) is below ``tol``; rank is cut to <= d-1, n-1.
    ``center=True, scale=False`` (notebook variant): re-center every step,
    ``n_components=None`` means min(n, d) - 1, stop on the change of the filled
    cells.  Observed cells are never altered.
    """

    def __init__(self, n_components: int | None = 5, max_iter: int = 100, tol: float = 1e-4,
                 center: bool = False, scale: bool = True, columns=None, exclude=(), max_patterns: int = 4096,
                 mode: str = "auto"):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.mode = mode
        self.k, self.max_iter, self.tol = n_components, max_iter, tol
        self.center, self.scale = center, scale
        self.columns, self.exclude, self.max_patterns = columns, tuple(exclude), max_patterns

    def _rank(self, n: float, d: int) -> int:
        if self.center:
            k = (min(int(n), d) - 1) if self.k is None else min(self.k, d)
        else:
            k = min(self.k or d, d - 1, int(n) - 1)
        if k < 1:
            raise ValueError(f"a low-rank fill needs two columns and two rows or more; got {d} and {int(n)}")
        return k

    def fit(self, df: DataFrame) -> LowRankModel:
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        return self._fit(_moments(df, cols, self.mode, self.max_patterns))

    def sweep(self, df: DataFrame, ranks) -> dict[int, LowRankModel]:
        """One model per rank, all from one moment table or written copy of the columns (EVL23)."""
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        data = _moments(df, cols, self.mode, self.max_patterns)
        out, keep = {}, self.k
        try:
            for r in ranks:
                self.k = r
                out[r] = self._fit(data)
        finally:
            self.k = keep
        return out

    def _fit(self, data) -> LowRankModel:
        d = len(data.cols)
        if self.scale and not self.center:
            # units in which the mean-filled table has unit variance
            G, _ = data.gram([], np.ones(d))
            mean = G[0, 1:] / G[0, 0]
            sd = np.sqrt(np.maximum(np.diag(G)[1:] / G[0, 0] - mean ** 2, 0.0))
            s_u = np.where(sd == 0, 1.0, sd)
        else:
            s_u = np.ones(d)
        chain, sing = [], np.zeros(0)
        G, _ = data.gram(chain, s_u)
        k = self._rank(G[0, 0], d)
        for it in range(self.max_iter):
            mu, P, sing = _projection(G, k, self.center)
            chain.append((mu, P))
            G, change = data.gram(chain, s_u)
            if not (self.center and it == 0) and math.sqrt(change) < self.tol:
                break
        return LowRankModel(data.cols, data.m, s_u, chain, list(map(float, sing)))


def _moments(df: DataFrame, cols: list[str], mode: str, max_patterns: int):
    """Pattern moments where they fit on the driver, else passes over the data: the same sums of
    the same completed rows, so the same iteration."""
    table = mode == "table"
    if mode in ("auto", "patterns"):
        try:
            return _FromPatterns(PatternMoments(df, cols, max_patterns))
        except TooManyPatterns:
            if mode == "patterns":
                raise
            table = table_pays(df, cols)
    if table:
        from lacuna.operators.states import FromTable, MomentState
        return FromTable(MomentState.of(df, cols).table())
    return _FromRows(df, cols)


class _FromPatterns:
    def __init__(self, pm: PatternMoments):
        self.cols, self.m, self.pm = pm.cols, pm.m, pm
        self.miss = [pm.missing(p) for p in pm.patterns]
        self._maps: list = []

    def _step(self, chain):
        """Maps of all patterns after ``chain`` and before its last step (kept between calls)."""
        if not chain:
            self._maps = [chain_map(m, ()) for m in self.miss]
            return self._maps, self._maps
        before = self._maps
        self._maps = [one_step(W, m, *chain[-1]) for W, m in zip(before, self.miss)]
        return before, self._maps

    def gram(self, chain, s_u):
        """Gram of [1, u] of the table completed by ``chain``, and the squared change that its
        last step made.  Chains are handed in from the empty one on, a step longer each time."""
        pm, d = self.pm, len(self.cols)
        to_u = np.concatenate(([1.0], pm.s / s_u))
        G, change = np.zeros((d + 1, d + 1)), 0.0
        for old, new, Q in zip(*self._step(chain), pm.Q):
            Qu = Q * to_u[:, None] * to_u[None, :]
            W = np.vstack([np.eye(1, d + 1), new])
            G += W @ Qu @ W.T
            change += float(np.trace((new - old) @ Qu @ (new - old).T))
        return G, max(change, 0.0)


class _FromRows:
    def __init__(self, df: DataFrame, cols: list[str]):
        self.cols = cols
        self.data = cut(df.select(*[clean(df, c).cast("double").alias(c) for c in cols]))
        row = self.data.agg(*[F.avg(c).alias(c) for c in cols]).first()
        self.m = np.array([row[c] if row[c] is not None else 0.0 for c in cols])

    def gram(self, chain, s_u):
        """One pass; tasks return partial sums, (d+1)^2 + 1 numbers reach the driver."""
        cols, d = self.cols, len(self.cols)
        bc = self.data.sparkSession.sparkContext.broadcast((self.m, s_u, list(chain)))

        def run(it):
            m, s, steps = bc.value
            now, before = {}, {}
            for pdf in it:
                U = (pdf[cols].to_numpy(dtype="float64", na_value=np.nan) - m) / s
                cur = _replayed(U, steps, now)
                change = float(((cur - _replayed(U, steps[:-1], before)) ** 2).sum()) if steps else 0.0
                A = np.hstack([np.ones((len(U), 1)), cur])
                yield pd.DataFrame({"cell": np.arange((d + 1) ** 2 + 1, dtype="int32"), "v": np.append((A.T @ A).ravel(), change)})

        rows = self.data.mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
        vec = np.zeros((d + 1) ** 2 + 1)
        for r in rows:
            vec[r["cell"]] = r["v"]
        return vec[:-1].reshape(d + 1, d + 1), vec[-1]
