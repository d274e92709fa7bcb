"""Pattern moments: the engine behind EM, SVD and round-robin regression fills.

Rows with the same missing pattern p all receive the same *affine* map of
their observed cells in EM, low-rank and chained linear regression fills, and
that stays true after every iteration.  So the data enter those algorithms
only through, per pattern,

    Q_p = sum over rows of [1, z][1, z]^T      (z standardized, holes as 0)

which one grouped aggregation (one shuffle, one row per pattern) delivers.
The iterations then run on (d+1) x (d+1) matrices on the driver, whose size
depends on the number of columns only, and the final maps W_p are broadcast
to a ``mapInPandas`` that fills each Arrow batch pattern by pattern.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean, pattern_bits

MAX_PATTERNS = 4096
MAX_CELLS = 4_000_000  # patterns x (d+1)^2 numbers that may come to the driver
WIDE = 24  # above this many columns, Gram blocks come from numpy per Arrow batch


class TooManyPatterns(ValueError):
    """The table has more missing patterns than moments can be kept for on the driver."""


def missing_patterns(M: np.ndarray):
    """(row indices, missing mask) of each pattern among the rows of a boolean matrix that have
    holes; rows of any width are compared as packed bytes."""
    rows = np.flatnonzero(M.any(axis=1))
    if not len(rows):
        return
    packed = np.packbits(M[rows], axis=1)
    _, first, inverse = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(inverse.ravel(), kind="stable")
    cuts = np.cumsum(np.bincount(inverse.ravel()))[:-1]
    for k, part in zip(first, np.split(rows[order], cuts)):
        yield part, M[rows[k]]


def _wide_moments(zz: DataFrame, d: int):
    """Per-pattern [1, z][1, z]^T summed per batch in numpy, then across batches
    by a grouped sum over (pattern, cell) - partial Grams, never rows, move."""
    iu = np.triu_indices(d + 1)

    def part(it):
        for pdf in it:
            Z = pdf[[f"z{i}" for i in range(d)]].to_numpy(dtype="float64")
            A = np.hstack([np.ones((len(Z), 1)), Z])
            for p in pdf["__p"].unique():
                sel = pdf["__p"].to_numpy() == p
                G = A[sel].T @ A[sel]
                yield pd.DataFrame({"p": [p] * len(iu[0]),
                                    "cell": np.arange(len(iu[0]), dtype="int32"), "v": G[iu]})
    long = zz.mapInPandas(part, "p string, cell int, v double").groupBy("p", "cell").agg(F.sum("v").alias("v"))
    rows = long.collect()
    pats = sorted({r["p"] for r in rows})
    pos = {p: k for k, p in enumerate(pats)}
    Q = np.zeros((len(pats), d + 1, d + 1))
    for r in rows:
        i, j = iu[0][r["cell"]], iu[1][r["cell"]]
        Q[pos[r["p"]], i, j] = Q[pos[r["p"]], j, i] = r["v"]
    return Q, pats


def _sums(zz: DataFrame, d: int, max_patterns: int):
    """(patterns, Q): one matrix of sums per pattern."""
    # count first: only then is it known that the sums fit on the driver
    most = min(max_patterns, MAX_CELLS // (d + 1) ** 2)
    found = zz.select("__p").distinct().limit(most + 1).count()
    if found > most:
        raise TooManyPatterns(f"more than {most} missing patterns of {d} columns")
    if d > WIDE:
        Q, patterns = _wide_moments(zz, d)
        return patterns, Q
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(f"z{i}").alias(f"s{i}") for i in range(d)]
    aggs += [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = zz.groupBy("__p").agg(*aggs).collect()
    Q = np.zeros((len(rows), d + 1, d + 1))
    for k, r in enumerate(rows):
        Q[k, 0, 0] = r["n"]
        for i in range(d):
            Q[k, 0, i + 1] = Q[k, i + 1, 0] = r[f"s{i}"]
            for j in range(i, d):
                Q[k, i + 1, j + 1] = Q[k, j + 1, i + 1] = r[f"q{i}_{j}"]
    return [r["__p"] for r in rows], Q


class PatternMoments:
    """Per-pattern moments of standardized columns.

    Attributes: cols, mean (m), scale (s), patterns (strings of flags),
    Q (array P x (d+1) x (d+1)) in standardized units, n (rows).
    """

    def __init__(self, df: DataFrame, cols: list[str], max_patterns: int = MAX_PATTERNS):
        zz = self._standardized(df, cols)
        self.patterns, self.Q = _sums(zz, len(cols), max_patterns)
        self.n = float(self.Q[:, 0, 0].sum())

    @classmethod
    def by_group(cls, df: DataFrame, key: str, cols: list[str], max_patterns: int = MAX_PATTERNS) -> dict[str, "PatternMoments"]:
        """One object per value of ``key`` (as text), from the same scans as for one; all share
        the centre and scale of the whole table."""
        whole = cls.__new__(cls)
        zz = whole._standardized(df, cols, F.concat(F.col(key).cast("string"), F.lit("|")))
        patterns, Q = _sums(zz, len(cols), max_patterns)
        out: dict[str, PatternMoments] = {}
        for k in sorted({p.rsplit("|", 1)[0] for p in patterns}):
            at = [i for i, p in enumerate(patterns) if p.rsplit("|", 1)[0] == k]
            one = out[k] = cls.__new__(cls)
            one.cols, one.hole_idx, one.m, one.s = whole.cols, whole.hole_idx, whole.m, whole.s
            one.patterns, one.Q = [patterns[i].rsplit("|", 1)[1] for i in at], Q[at]
            one.n = float(one.Q[:, 0, 0].sum())
        return out

    def _standardized(self, df: DataFrame, cols: list[str], prefix=None) -> DataFrame:
        """(__p, z0, z1, ...): pattern and standardized values, holes 0; keeps centre and scale."""
        self.cols = cols
        d = len(cols)
        st = df.agg(F.count(F.lit(1)).alias("n"), *[x for i, c in enumerate(cols) for x in
                    (F.avg(clean(df, c)).alias(f"m{i}"), F.stddev_pop(clean(df, c)).alias(f"s{i}"),
                     F.count(clean(df, c)).alias(f"c{i}"))]).first()
        # a pattern has one flag for each column with holes
        self.hole_idx = [i for i in range(d) if st[f"c{i}"] < st["n"]]
        self.m = np.array([st[f"m{i}"] if st[f"m{i}"] is not None else 0.0 for i in range(d)])
        self.s = np.array([st[f"s{i}"] if st[f"s{i}"] else 1.0 for i in range(d)])
        z = [F.coalesce((clean(df, c).cast("double") - F.lit(self.m[i])) / F.lit(self.s[i]), F.lit(0.0))
             for i, c in enumerate(cols)]
        pat = pattern_bits(df, [cols[i] for i in self.hole_idx])
        pat = pat if prefix is None else F.concat(prefix, pat)
        return df.select(pat.alias("__p"), *[v.alias(f"z{i}") for i, v in enumerate(z)])

    def missing(self, p: str) -> np.ndarray:
        return decode(p, self.hole_idx, len(self.cols))

    def identity_maps(self) -> list[np.ndarray]:
        """W_p in z-space: completed z-row = W_p @ [1, z]; holes start at 0 (the mean)."""
        d = len(self.cols)
        out = []
        for p in self.patterns:
            W = np.zeros((d, d + 1))
            miss = self.missing(p)
            for i in range(d):
                if not miss[i]:
                    W[i, i + 1] = 1.0
            out.append(W)
        return out

    def mean_cov(self, W: list[np.ndarray], ddof: int = 1):
        """Mean and covariance (z-space) of the table completed by maps W."""
        S1 = sum(Wp @ Q[:, 0] for Wp, Q in zip(W, self.Q))
        S2 = sum(Wp @ Q @ Wp.T for Wp, Q in zip(W, self.Q))
        mu = S1 / self.n
        cov = (S2 - self.n * np.outer(mu, mu)) / (self.n - ddof)
        return mu, cov, S2

    def change_sq(self, W_new, W_old, scale=None) -> float:
        """Squared Frobenius norm of the change of the completed table (x-space by default)."""
        s = self.s if scale is None else scale
        tot = 0.0
        for a, b, Q in zip(W_new, W_old, self.Q):
            D = (a - b) * s[:, None]
            tot += float(np.trace(D @ Q @ D.T))
        return max(tot, 0.0)


def decode(p: str, hole_idx: list[int], d: int) -> np.ndarray:
    out = np.zeros(d, dtype=bool)
    for b, j in enumerate(hole_idx):
        out[j] = p[b] == "1"
    return out
