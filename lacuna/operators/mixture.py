"""Gaussian-mixture fill (MOD11) and component selection (MOD13).

The mixture is fitted on the standardized, mean-filled table by its own EM: each iteration is one
scan in which every Arrow batch computes the responsibilities of its rows and a task hands on one
row of sums (count, mean and cross-product sums per component, log-likelihood).  All numbers of
components that are asked for share the scans, and each stops by its own log-likelihood.  It starts
from the K rows with the smallest portable hash and the covariance of the whole table, so a
run can be repeated anywhere, in SQL too.

The fill is a per-row computation - responsibilities of the row under each component, then holes <-
sum_k r_k * conditional mean_k, repeated until the row settles - so it runs in ``mapInPandas`` with
the fitted parameters broadcast.  Responsibilities are not affine in the row, hence no pattern
moments here.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean, resolve_columns
from lacuna.functions.hashing import full_hash
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.operators.moments import missing_patterns
from lacuna.session import cut


def _standardized(df: DataFrame, cols: list[str]):
    st = df.agg(*[x for i, c in enumerate(cols) for x in
                  (F.avg(clean(df, c)).alias(f"m{i}"), F.stddev_pop(clean(df, c)).alias(f"s{i}"))]).first()
    m = np.array([st[f"m{i}"] or 0.0 for i in range(len(cols))])
    s = np.array([st[f"s{i}"] or 1.0 for i in range(len(cols))])
    return m, s


RIDGE = 1e-6  # fixed value: added to covariance diagonals before inversion


class Mixture:
    """Parameters of one mixture during the fit."""

    def __init__(self, weights, means, covs):
        self.weights, self.means, self.covs = weights, means, covs
        self.log_likelihood, self.done = -math.inf, False

    def log_density(self, Z: np.ndarray) -> np.ndarray:
        """ln w_k + ln N(z; mu_k, cov_k + ridge) per row and component."""
        d = Z.shape[1]
        out = np.empty((len(Z), len(self.weights)))
        for k, w in enumerate(self.weights):
            C = self.covs[k] + RIDGE * np.eye(d)
            diff = Z - self.means[k]
            quad = (diff * np.linalg.solve(C, diff.T).T).sum(axis=1)
            out[:, k] = (math.log(w) if w > 0 else -math.inf) - 0.5 * (d * math.log(2 * math.pi) + np.linalg.slogdet(C)[1] + quad)
        return out

    def sums(self, Z: np.ndarray) -> np.ndarray:
        """Log-likelihood, then per component count, sum and cross-products of the rows."""
        ll = self.log_density(Z)
        top = ll.max(axis=1, keepdims=True)
        r = np.exp(ll - top)
        norm = r.sum(axis=1, keepdims=True)
        r /= norm
        parts = [np.array([float((top + np.log(norm)).sum())])]
        for k in range(len(self.weights)):
            R = Z * r[:, k, None]
            parts += [np.array([r[:, k].sum()]), R.sum(axis=0), (R.T @ Z).ravel()]
        return np.concatenate(parts)

    def update(self, sums: np.ndarray, n: int, d: int, tol: float) -> None:
        done = abs(sums[0] - self.log_likelihood) < tol * n
        self.log_likelihood = float(sums[0])
        per = sums[1:].reshape(len(self.weights), 1 + d + d * d)
        if not done:
            count = np.maximum(per[:, 0], 1e-300)
            self.weights = per[:, 0] / n
            self.means = per[:, 1:1 + d] / count[:, None]
            self.covs = per[:, 1 + d:].reshape(-1, d, d) / count[:, None, None] - self.means[:, :, None] * self.means[:, None, :]
        self.done = done


def _starts(data: DataFrame, names: list[str], k: int) -> np.ndarray:
    """The k rows of smallest hash that differ: components that start alike would stay alike."""
    found, last = [], None
    for _ in range(16 * k):
        least = (data if last is None else data.where(F.col("h") > last)).agg(F.min(F.struct("h", *names)).alias("r")).first()["r"]
        if least is None or len(found) == k:
            break
        last, row = least["h"], [least[c] for c in names]
        if row not in found:
            found.append(row)
    return np.array(found)


def _loglik(cov, n) -> float:
    """Log-likelihood of one Gaussian at its maximum."""
    p = len(cov)
    _, logdet = np.linalg.slogdet(cov)
    return float(-0.5 * n * (p * math.log(2 * math.pi) + logdet + p))


def fit_mixtures(df: DataFrame, cols: list[str], m, s, ks, seed: int = 42, max_iter: int = 100, tol: float = 1e-3,
                 id_col: str | None = None) -> tuple[dict[int, Mixture], int]:
    """A mixture per number of components in ``ks`` from shared scans, and the number of rows.

    The hash that picks the starting rows is over ``id_col``, or over the values where there is none
    (then a run is repeatable on Spark only)."""
    d, kmax = len(cols), max(ks)
    z = [F.coalesce((clean(df, c).cast("double") - F.lit(m[i])) / F.lit(s[i]), F.lit(0.0)).alias(f"z{i}") for i, c in enumerate(cols)]
    names = [f"z{i}" for i in range(d)]
    key = full_hash(id_col, f"mixture{seed}") if id_col else F.xxhash64(*[clean(df, c) for c in cols], F.lit(seed))
    data = cut(df.select(key.alias("h"), *z))
    stats = data.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                     *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]).first()
    n = stats["n"]
    whole = np.array([[stats[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
    mean = np.array([stats[f"m{i}"] for i in range(d)])
    start = _starts(data, names, kmax) if kmax > 1 else mean[None, :]
    fits = {k: Mixture(np.full(k, 1.0 / k), start[np.arange(k) % len(start)], np.repeat(whole[None], k, axis=0)) for k in ks}
    if 1 in fits:  # its maximum is the moments
        fits[1].means, fits[1].done, fits[1].log_likelihood = mean[None, :], True, _loglik(whole, n)
    for step in range(max_iter + 1):  # the last scan is for the likelihood of the last parameters
        live = {k: f for k, f in fits.items() if not f.done}
        if not live:
            break
        bc = df.sparkSession.sparkContext.broadcast(live)

        def run(batches):
            total = None
            for b in batches:
                Z = np.column_stack([b.column(c).to_numpy() for c in names])
                if len(Z):
                    got = np.concatenate([f.sums(Z) for f in bc.value.values()])
                    total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["cell", "v"])

        rows = data.select(*names).mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).orderBy("cell").collect()
        sums, at = np.array([r["v"] for r in rows]), 0
        last = step == max_iter
        for k, f in live.items():
            size = 1 + k * (1 + d + d * d)
            part, at = sums[at:at + size], at + size
            if last:
                f.log_likelihood, f.done = float(part[0]), True
            else:
                f.update(part, n, d, tol)
    return fits, n


class MixtureModel(ImputerModel):
    def __init__(self, cols, m, s, weights, means, covs, max_iter, tol, loglik):
        self.cols, self.m, self.s = cols, m, s
        self.weights_, self.means_, self.covariances_ = weights, means, covs
        self.max_iter, self.tol, self.log_likelihood_ = max_iter, tol, loglik

    def transform(self, df: DataFrame) -> DataFrame:
        cols, d = self.cols, len(self.cols)
        params = {"w": self.weights_, "mu": self.means_, "cov": self.covariances_, "m": self.m, "s": self.s,
                  "it": self.max_iter, "tol": self.tol}
        bc = df.sparkSession.sparkContext.broadcast(params)
        names = df.columns
        base = df.select(*[clean(df, c).cast("double").alias(c) if c in cols else F.col(c) for c in names])

        def run(it):
            P = bc.value
            w, mu, cov = np.asarray(P["w"]), np.asarray(P["mu"]), np.asarray(P["cov"])
            K = len(w)
            inv = np.linalg.inv(cov + 1e-6 * np.eye(d))
            _, logdet = np.linalg.slogdet(cov + 1e-6 * np.eye(d))
            for pdf in it:
                X = (pdf[cols].to_numpy(dtype="float64", na_value=np.nan) - P["m"]) / P["s"]
                M = np.isnan(X)
                Z = np.where(M, 0.0, X)  # initial fill: the mean
                live = np.flatnonzero(M.any(axis=1))  # a row stops by its own change, whatever its neighbours do
                for _ in range(P["it"]):
                    if not len(live):
                        break
                    Zr, Mr = Z[live], M[live]
                    # responsibilities of the current completed rows
                    ll = np.stack([-0.5 * np.einsum("ij,jk,ik->i", Zr - mu[k], inv[k], Zr - mu[k])
                                   - 0.5 * logdet[k] + math.log(w[k]) for k in range(K)], axis=1)
                    ll -= ll.max(axis=1, keepdims=True)
                    r = np.exp(ll)
                    r /= r.sum(axis=1, keepdims=True)
                    new = np.zeros_like(Zr)
                    for k in range(K):
                        new += r[:, k, None] * _cond_means(Zr, Mr, mu[k], cov[k])
                    newZ = np.where(Mr, new, Zr)
                    Z[live] = newZ
                    live = live[np.abs(newZ - Zr).max(axis=1) >= P["tol"]]
                out = np.where(M, Z * P["s"] + P["m"], pdf[cols].to_numpy(dtype="float64", na_value=np.nan))
                for j, c in enumerate(cols):
                    pdf[c] = out[:, j]
                yield pdf
        return base.mapInPandas(run, base.schema)


def _cond_means(Z, M, mu, cov):
    """Conditional mean of the missing coordinates given the observed ones, row by pattern."""
    out = Z.copy()
    for sel, miss in missing_patterns(M):
        obs = ~miss
        if obs.any():
            B = np.linalg.solve(cov[np.ix_(obs, obs)] + 1e-6 * np.eye(obs.sum()), cov[np.ix_(miss, obs)].T).T
            out[np.ix_(sel, miss)] = mu[miss] + (Z[np.ix_(sel, obs)] - mu[obs]) @ B.T
        else:
            out[np.ix_(sel, miss)] = mu[miss]
    return out


class GaussianMixtureImputer(Imputer):
    """Fill from a K-component full-covariance Gaussian mixture (seed 42).

    ``fit_iter`` and ``fit_tol`` (change of the mean log-likelihood of a row) bound the fit, ``max_iter`` and ``tol``
    the fill of a row."""

    def __init__(self, n_components: int = 2, max_iter: int = 100, tol: float = 1e-4, columns=None, exclude=(),
                 seed: int = 42, id_col: str | None = None, fit_iter: int = 100, fit_tol: float = 1e-3):
        if n_components < 1:
            raise ValueError("n_components must be >= 1")
        self.k, self.max_iter, self.tol, self.seed = n_components, max_iter, tol, seed
        self.id_col, self.fit_iter, self.fit_tol = id_col, fit_iter, fit_tol
        self.columns, self.exclude = columns, tuple(exclude)

    def fit(self, df: DataFrame) -> MixtureModel:
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", [*self.exclude, *([self.id_col] if self.id_col else [])])
        m, s = _standardized(df, cols)
        fit = fit_mixtures(df, cols, m, s, [self.k], self.seed, self.fit_iter, self.fit_tol, self.id_col)[0][self.k]
        return MixtureModel(cols, m, s, list(fit.weights), fit.means, fit.covs, self.max_iter, self.tol, fit.log_likelihood)


def select_components(df: DataFrame, columns: list[str], ks=(1, 2, 3, 4, 5), seed: int = 42,
                      reference_count: bool = False, id_col: str | None = None, max_iter: int = 100, tol: float = 1e-3) -> DataFrame:
    """AIC / BIC per number of components (MOD13), all fitted in the same scans.  Parameters counted as
    K*p + K*p(p+1)/2 + K - 1; ``reference_count`` uses K(2p + p(p+1)/2) - 1."""
    m, s = _standardized(df, columns)
    p = len(columns)
    fits, n = fit_mixtures(df, columns, m, s, list(ks), seed, max_iter, tol, id_col)
    rows = []
    for k in ks:
        ll = fits[k].log_likelihood
        npar = k * (2 * p + p * (p + 1) // 2) - 1 if reference_count else k * p + k * p * (p + 1) // 2 + k - 1
        rows.append((k, ll, 2 * npar - 2 * ll, npar * math.log(n) - 2 * ll))
    return df.sparkSession.createDataFrame(rows, "n_components int, log_likelihood double, aic double, bic double")
