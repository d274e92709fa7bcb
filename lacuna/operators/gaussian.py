"""Model-based fills on pattern moments: Gaussian EM (MOD8-MOD10) and
round-robin Bayesian-ridge regression (MOD7).

All iterations run on per-pattern (d+1)x(d+1) moment matrices (see
``lacuna.operators.moments``); a data pass happens once for the moments and
once for the final fill.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lacuna.functions.columns import resolve_columns
from lacuna.functions.quantiles import exact_quantiles_multi
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.operators.moments import PatternMoments, TooManyPatterns, missing_patterns

RIDGE = 1e-6  # fixed value: ridge added to covariance blocks before inversion
MODES = ("auto", "patterns", "table", "scan")


def table_pays(df: DataFrame, cols: list[str]) -> bool:
    """Whether a row of moments per missing pattern is less than the rows themselves."""
    from pyspark.sql import functions as F
    from lacuna.functions.columns import pattern_bits
    n, patterns = df.agg(F.count(F.lit(1)), F.approx_count_distinct(pattern_bits(df, cols), 0.02)).first()
    return patterns * (len(cols) + 1) * (len(cols) + 2) // 2 < n * len(cols)


def conditional_maps(pm: PatternMoments, mu: np.ndarray, cov: np.ndarray, patterns) -> dict[str, np.ndarray]:
    """z-space E-step maps: holes <- mu_m + S_mo (S_oo + ridge)^-1 (z_o - mu_o).

    The ridge is 1e-6 in the original units, i.e. 1e-6 / s^2 in z units, so the
    result equals the computation on raw values."""
    return {p: conditional_map(pm.missing(p), mu, cov, pm.s) for p in patterns}


def conditional_map(miss: np.ndarray, mu: np.ndarray, cov: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The E-step map of one missing pattern on [1, z]."""
    d, obs = len(miss), ~miss
    W = np.zeros((d, d + 1))
    for i in np.nonzero(obs)[0]:
        W[i, i + 1] = 1.0
    if miss.any():
        if obs.any():
            Soo = cov[np.ix_(obs, obs)] + np.diag(RIDGE / s[obs] ** 2)
            Smo = cov[np.ix_(miss, obs)]
            try:
                B = np.linalg.solve(Soo, Smo.T).T
                W[np.ix_(miss, [0])] = (mu[miss] - B @ mu[obs])[:, None]
                W[np.ix_(miss, 1 + np.nonzero(obs)[0])] = B
            except np.linalg.LinAlgError:
                W[miss, 0] = mu[miss]
        else:
            W[miss, 0] = mu[miss]
    return W


def log_likelihood(pm: PatternMoments, W, ridge: float = RIDGE) -> float:
    """-1/2 (n p ln 2pi + n ln|S| + sum of quadratic forms) of the completed table
    under its own mean and covariance (+ ridge), in original units."""
    mu, cov, S2 = pm.mean_cov(W)
    n, p = pm.n, len(pm.cols)
    D = np.diag(pm.s)
    covx = D @ cov @ D + ridge * np.eye(p)
    scatter = D @ (S2 - n * np.outer(mu, mu)) @ D
    sign, logdet = np.linalg.slogdet(covx)
    if sign <= 0:
        return -math.inf
    quad = float(np.trace(np.linalg.solve(covx, scatter)))
    return -0.5 * (n * p * math.log(2 * math.pi) + n * logdet + quad)


def estep_batch(X: np.ndarray, mu: np.ndarray, cov: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Fill a batch (raw units): holes <- mu_m + S_mo (S_oo + ridge I)^-1 (x_o - mu_o),
    one solve per missing pattern present in the batch."""
    M = np.isnan(X)
    out = X.copy()
    if not M.any():
        return out
    for rows, miss in missing_patterns(M):
        obs = ~miss
        if obs.any():
            Soo = cov[np.ix_(obs, obs)] + ridge * np.eye(obs.sum())
            try:
                B = np.linalg.solve(Soo, cov[np.ix_(miss, obs)].T).T
                out[np.ix_(rows, miss)] = mu[miss] + (X[np.ix_(rows, obs)] - mu[obs]) @ B.T
            except np.linalg.LinAlgError:
                out[np.ix_(rows, miss)] = mu[miss]
        else:
            out[np.ix_(rows, miss)] = mu[miss]
    return out


def _estep_frame(df: DataFrame, cols: list[str], mu: np.ndarray, cov: np.ndarray) -> DataFrame:
    """Lazy fill of ``cols`` with fixed (mu, cov): works on tables and streams alike,
    for any number of missing patterns (maps are built inside each task)."""
    from pyspark.sql import functions as F
    from lacuna.functions.columns import clean
    bc = df.sparkSession.sparkContext.broadcast((np.asarray(mu), np.asarray(cov)))
    names = df.columns
    base = df.select(*[clean(df, c).cast("double").alias(c) if c in cols else F.col(c) for c in names])

    def run(it):
        m, S = bc.value
        for pdf in it:
            X = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
            filled = estep_batch(X, m, S)
            for j, c in enumerate(cols):
                pdf[c] = filled[:, j]
            yield pdf
    return base.mapInPandas(run, base.schema)


class GaussianModel(ImputerModel):
    _fit_only = ("pm", "mu_z", "cov_z")

    def __init__(self, pm, cols, mu_z, cov_z, history, n_iter, mu_x=None, sigma_x=None):
        self.pm, self.cols = pm, cols
        self.mu_z, self.cov_z = mu_z, cov_z
        if pm is not None:
            D = np.diag(pm.s)
            self.mu_ = pm.m + pm.s * mu_z
            self.sigma_ = D @ cov_z @ D
        else:
            self.mu_, self.sigma_ = np.asarray(mu_x), np.asarray(sigma_x)
        self.log_likelihood_history_ = history
        self.log_likelihood_ = history[-1] if history else None
        self.n_iter_ = n_iter

    def transform(self, df: DataFrame) -> DataFrame:
        """One E-step with the fitted mean and covariance: each row's fill depends
        only on its own observed cells, so this also works on new data and streams.
        Only (mu, sigma) are broadcast; each task solves once per pattern it meets."""
        return _estep_frame(df, self.cols, self.mu_, self.sigma_)

    def _stat_rows(self):
        rows = [(c, "mu", float(v)) for c, v in zip(self.cols, self.mu_)]
        rows += [(f"{a}|{b}", "sigma", float(self.sigma_[i, j])) for i, a in enumerate(self.cols)
                 for j, b in enumerate(self.cols)]
        return rows + [("*", "n_iter", self.n_iter_), ("*", "log_likelihood", self.log_likelihood_)]


class EMImputer(Imputer):
    """Multivariate-normal EM fill.

    ``stop='change'`` (default): stop when the Frobenius change of the completed
    table is below ``tol``; ``stop='loglik'``: when the log-likelihood changes
    by less than ``tol``.  ``init``: 'mean' | 'median' | 'zero' start for holes.
    """

    def __init__(self, max_iter: int = 100, tol: float = 1e-6, stop: str = "change", init: str = "mean",
                 columns=None, exclude=(), max_patterns: int = 4096, mode: str = "auto"):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.mode = mode
        if init not in ("mean", "median", "zero"):
            raise ValueError(f"init is mean, median or zero, not {init!r}")
        if stop not in ("change", "loglik"):
            raise ValueError("stop must be 'change' or 'loglik'")
        self.max_iter, self.tol, self.stop, self.init = max_iter, tol, stop, init
        self.columns, self.exclude, self.max_patterns = columns, tuple(exclude), max_patterns

    def fit(self, df: DataFrame) -> GaussianModel:
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        if not cols:
            raise ValueError("EM needs at least one numeric column")
        if self.mode == "scan":
            return self._fit_scan(df, cols)
        if self.mode == "table":
            return self._fit_table(df, cols)
        try:
            pm = PatternMoments(df, cols, self.max_patterns)
        except TooManyPatterns:
            if self.mode == "auto":
                return self._fit_table(df, cols) if table_pays(df, cols) else self._fit_scan(df, cols)
            raise
        return self.fit_moments(pm, self._start(df, cols, pm.m))

    def _start(self, df: DataFrame, cols: list[str], means: np.ndarray) -> np.ndarray | None:
        """Values that holes start at; None for the means."""
        if self.init == "median":
            q = exact_quantiles_multi(df, cols, [0.5])
            return np.array([(q[c][0] if q[c][0] is not None else means[i]) for i, c in enumerate(cols)])
        return np.zeros(len(cols)) if self.init == "zero" else None

    def _fit_table(self, df: DataFrame, cols: list[str]) -> GaussianModel:
        """More patterns than the driver should hold: their moments stay a table (states.py)."""
        from lacuna.operators.states import MomentState, em_over_patterns
        table = MomentState.of(df, cols).table()
        return em_over_patterns(table, self.max_iter, self.tol, self.stop, self._start(df, cols, table.m))

    def fit_moments(self, pm: PatternMoments, start: np.ndarray | None = None) -> GaussianModel:
        """The iteration on given moments; holes start at ``start``, or at the means."""
        cols = pm.cols
        W = pm.identity_maps()
        if start is not None:
            z0 = (start - pm.m) / pm.s
            for Wp, p in zip(W, pm.patterns):
                Wp[pm.missing(p), 0] = z0[pm.missing(p)]
        history, n_iter = [], 0
        mu, cov, _ = pm.mean_cov(W)
        for it in range(self.max_iter):
            mu, cov, _ = pm.mean_cov(W)
            maps = conditional_maps(pm, mu, cov, pm.patterns)
            W_new = [maps[p] for p in pm.patterns]
            history.append(log_likelihood(pm, W_new))
            change = math.sqrt(pm.change_sq(W_new, W))
            W = W_new
            n_iter = it + 1
            if self.stop == "change" and change < self.tol:
                break
            if self.stop == "loglik" and it > 0 and abs(history[-1] - history[-2]) < self.tol:
                break
        mu, cov, _ = pm.mean_cov(W)
        return GaussianModel(pm, cols, mu, cov, history, n_iter)

    def _fit_scan(self, df: DataFrame, cols: list[str]) -> GaussianModel:
        """EM without pattern moments: every iteration is one pass over a
        checkpointed copy of the columns, each task filling its rows with the
        current (mu, sigma) and the previous ones and returning only partial
        Gram matrices and the squared change.  For tables whose missing patterns
        exceed the cap; the result is the same fixed-point iteration."""
        from pyspark.sql import functions as F
        from lacuna.functions.columns import clean
        from lacuna.session import cut
        d = len(cols)
        data = cut(df.select(*[clean(df, c).cast("double").alias(c) for c in cols]))
        if self.init == "median":
            q = exact_quantiles_multi(data, cols, [0.5])
            start = np.array([q[c][0] if q[c][0] is not None else 0.0 for c in cols])
        elif self.init == "zero":
            start = np.zeros(d)
        else:
            row = data.agg(*[F.avg(c).alias(c) for c in cols]).first()
            start = np.array([row[c] if row[c] is not None else 0.0 for c in cols])
        sc = df.sparkSession.sparkContext

        def moments(prev, cur):
            """Gram of the fill with `cur` params, and ||fill(cur) - fill(prev)||^2."""
            bc = sc.broadcast((prev, cur, start))

            def run(it):
                pv, cu, st = bc.value
                ctr = st
                for pdf in it:
                    X = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
                    fp = np.where(np.isnan(X), st, X) if pv is None else estep_batch(X, *pv)
                    fc = np.where(np.isnan(X), st, X) if cu is None else estep_batch(X, *cu)
                    # Gram about the start means: no cancellation for large-mean columns
                    A = np.hstack([np.ones((len(fc), 1)), fc - ctr])
                    G = (A.T @ A).ravel()
                    chg = float(((fc - fp) ** 2).sum())
                    yield pd.DataFrame({"cell": np.arange(len(G) + 1, dtype="int32"), "v": np.append(G, chg)})
            # partial Grams are summed by Spark: (d+1)^2 + 1 numbers reach the driver
            rows = (data.mapInPandas(run, "cell int, v double").groupBy("cell")
                    .agg(F.sum("v").alias("v")).collect())
            vec = np.zeros((d + 1) ** 2 + 1)
            for r in rows:
                vec[r["cell"]] = r["v"]
            G = vec[:-1].reshape(d + 1, d + 1)
            chg = vec[-1]
            return G, chg

        def params(G):
            n = G[0, 0]
            dm = G[0, 1:] / n  # mean offset from the centring point
            cov = (G[1:, 1:] - n * np.outer(dm, dm)) / (n - 1)
            return start + dm, cov, n, G

        G, _ = moments(None, None)
        mu, cov, n, G0 = params(G)
        prev = None
        history, n_iter = [], 0
        for it in range(self.max_iter):
            cur = (mu, cov)
            G, chg = moments(prev, cur)
            mu_n, cov_n, n, _ = params(G)
            scatter = cov_n * (n - 1)
            covx = cov_n + RIDGE * np.eye(d)
            sign, logdet = np.linalg.slogdet(covx)
            history.append(-math.inf if sign <= 0 else
                           -0.5 * (n * d * math.log(2 * math.pi) + n * logdet +
                                   float(np.trace(np.linalg.solve(covx, scatter)))))
            prev = cur
            mu, cov = mu_n, cov_n
            n_iter = it + 1
            if self.stop == "change" and math.sqrt(chg) < self.tol:
                break
            if self.stop == "loglik" and it > 0 and abs(history[-1] - history[-2]) < self.tol:
                break
        # as in pattern mode, the model holds the moments of the final completed table
        return GaussianModel(None, cols, None, None, history, n_iter, mu_x=mu, sigma_x=cov)


# ---------------------------------------------------------------- MOD7 round-robin regression

def bayesian_ridge(XtX, Xty, yty, n, max_iter=300, tol=1e-3, a1=1e-6, a2=1e-6, l1=1e-6, l2=1e-6, var_y=None):
    """Bayesian ridge (evidence maximization) from centered Gram blocks."""
    eig, V = np.linalg.eigh(XtX)
    eig = np.maximum(eig, 0.0)
    alpha = 1.0 / (var_y + np.finfo(float).eps) if var_y is not None else 1.0
    lam = 1.0
    VtXy = V.T @ Xty
    coef_old = None
    coef = np.zeros_like(Xty)
    for it in range(max_iter):
        coef = V @ (VtXy / (eig + lam / alpha))
        rss = float(yty - 2 * coef @ Xty + coef @ XtX @ coef)
        rss = max(rss, 0.0)
        gamma = float(np.sum(alpha * eig / (lam + alpha * eig)))
        lam = (gamma + 2 * l1) / (float(coef @ coef) + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (rss + 2 * a2)
        if coef_old is not None and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef
    coef = V @ (VtXy / (eig + lam / alpha))
    return coef


def replay_steps(Z: np.ndarray, steps) -> np.ndarray:
    """Replay a regression chain on standardized rows (holes NaN): mean start
    (0), then for every step (j, others, coef, intercept) the rows missing j get
    intercept + coef . z_others of their current values."""
    M = np.isnan(Z)
    out = np.where(M, 0.0, Z)
    for j, others, coef, intercept in steps:
        rows = M[:, j]
        if rows.any():
            out[rows, j] = intercept + out[np.ix_(rows, others)] @ coef
    return out


class IterativeModel(ImputerModel):
    """The fitted chain of regressions (standardized units); ``transform`` replays
    it inside each task, so any missing pattern - on new tables or streams - is
    filled exactly as the fit would have filled it."""

    def __init__(self, cols, m, s, steps, n_iter, order):
        self.cols, self.m, self.s, self.steps = cols, np.asarray(m), np.asarray(s), steps
        self.n_iter_, self.order_ = n_iter, order

    def transform(self, df):
        from pyspark.sql import functions as F
        from lacuna.functions.columns import clean
        cols = self.cols
        bc = df.sparkSession.sparkContext.broadcast((self.m, self.s, self.steps))
        names = df.columns
        base = df.select(*[clean(df, c).cast("double").alias(c) if c in cols else F.col(c) for c in names])

        def run(it):
            m, s, steps = bc.value
            for pdf in it:
                X = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
                out = replay_steps((X - m) / s, steps) * s + m
                out = np.where(np.isnan(X), out, X)
                for j, c in enumerate(cols):
                    pdf[c] = out[:, j]
                yield pdf
        return base.mapInPandas(run, base.schema)


def _ridge_step(G: np.ndarray):
    """Bayesian ridge of the last column on the others from a [1, X, y] Gram."""
    n = G[0, 0]
    mean = G[0, 1:] / n
    cen = G[1:, 1:] - n * np.outer(mean, mean)
    XtX, Xty, yty = cen[:-1, :-1], cen[:-1, -1], cen[-1, -1]
    coef = bayesian_ridge(XtX, Xty, yty, n, var_y=yty / n)
    return coef, float(mean[-1] - mean[:-1] @ coef)


class IterativeImputer(Imputer):
    """Round-robin regression: mean start, columns in ascending missing count,
    each regressed (Bayesian ridge) on all others, for ``max_iter`` rounds or
    until the RMS change of the filled cells falls below ``tol`` times the
    largest observed magnitude.

    Pattern mode runs the whole chain on per-pattern moments (one data pass);
    above ``max_patterns`` (or with ``mode='table'``) each regression is a pass over the
    table of pattern moments; ``mode='scan'``, and tables with nearly as many patterns as rows, pass
    over the rows, where tasks replay the chain so far and return a partial Gram."""

    def __init__(self, max_iter: int = 10, tol: float = 1e-3, columns=None, exclude=(), max_patterns: int = 4096,
                 mode: str = "auto"):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.max_iter, self.tol, self.mode = max_iter, tol, mode
        self.columns, self.exclude, self.max_patterns = columns, tuple(exclude), max_patterns

    def fit(self, df):
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        table = self.mode == "table"
        if self.mode in ("auto", "patterns"):
            try:
                return self._fit_patterns(PatternMoments(df, cols, self.max_patterns))
            except TooManyPatterns:
                if self.mode == "patterns":
                    raise
                table = table_pays(df, cols)
        if table:
            from lacuna.operators.states import MomentState, iterative_over_patterns
            return iterative_over_patterns(MomentState.of(df, cols).table(), self.max_iter, self.tol)
        return self._fit_scan(df, cols)

    def _fit_patterns(self, pm):
        cols = pm.cols
        d = len(cols)
        W = pm.identity_maps()
        miss_count = np.zeros(d)
        for p, Q in zip(pm.patterns, pm.Q):
            miss_count += pm.missing(p) * Q[0, 0]
        order = [int(j) for j in np.argsort(miss_count, kind="stable") if miss_count[j] > 0]
        n_iter, steps = 0, []
        for it in range(self.max_iter):
            W_prev = [w.copy() for w in W]
            for j in order:
                others = [i for i in range(d) if i != j]
                G = np.zeros((d + 1, d + 1))
                for Wp, Q, p in zip(W, pm.Q, pm.patterns):
                    if pm.missing(p)[j]:
                        continue
                    C = np.vstack([np.eye(1, d + 1, 0), Wp[others], Wp[j]])
                    G += C @ Q @ C.T
                if G[0, 0] < 2:
                    continue
                coef, intercept = _ridge_step(G)
                steps.append((j, others, coef, intercept))
                for Wp, p in zip(W, pm.patterns):
                    if pm.missing(p)[j]:
                        row = coef @ Wp[others]
                        row[0] += intercept
                        Wp[j] = row
            n_iter = it + 1
            rms = math.sqrt(pm.change_sq(W, W_prev) / max(miss_count.sum(), 1))
            if rms < self.tol * float(np.max(np.abs(pm.m) + 3 * pm.s)):
                break
        return IterativeModel(cols, pm.m, pm.s, steps, n_iter, [cols[j] for j in order])

    def _fit_scan(self, df, cols):
        from pyspark.sql import functions as F
        from lacuna.functions.columns import clean
        from lacuna.session import cut
        d = len(cols)
        data = cut(df.select(*[clean(df, c).cast("double").alias(c) for c in cols]))
        st = data.agg(F.count(F.lit(1)).alias("n"), *[x for i, c in enumerate(cols) for x in
                      (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"), F.count(c).alias(f"c{i}"))]).first()
        m = np.array([st[f"m{i}"] if st[f"m{i}"] is not None else 0.0 for i in range(d)])
        s = np.array([st[f"s{i}"] if st[f"s{i}"] else 1.0 for i in range(d)])
        miss_count = np.array([st["n"] - st[f"c{i}"] for i in range(d)], dtype=float)
        order = [int(j) for j in np.argsort(miss_count, kind="stable") if miss_count[j] > 0]
        sc = df.sparkSession.sparkContext

        def pass_(steps, j, prev_len):
            """Gram for regressing column j (rows observing j), and the squared change
            of the completed table since the chain had ``prev_len`` steps."""
            bc = sc.broadcast((m, s, steps, j, prev_len))

            def run(it):
                mm, ss, stp, jj, pl = bc.value
                for pdf in it:
                    Z = (pdf[cols].to_numpy(dtype="float64", na_value=np.nan) - mm) / ss
                    cur = replay_steps(Z, stp)
                    chg = 0.0
                    if pl is not None:
                        chg = float((((cur - replay_steps(Z, stp[:pl])) * ss) ** 2).sum())
                    G = np.zeros((d + 1, d + 1))
                    if jj is not None:
                        others = [i for i in range(d) if i != jj]
                        keep = ~np.isnan(Z[:, jj])
                        A = np.hstack([np.ones((keep.sum(), 1)), cur[keep][:, others], cur[keep][:, [jj]]])
                        G = A.T @ A
                    v = np.append(G.ravel(), chg)
                    yield pd.DataFrame({"cell": np.arange(len(v), dtype="int32"), "v": v})
            rows = data.mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
            vec = np.zeros((d + 1) ** 2 + 1)
            for r in rows:
                vec[r["cell"]] = r["v"]
            return vec[:-1].reshape(d + 1, d + 1), vec[-1]

        steps, n_iter = [], 0
        for it in range(self.max_iter):
            start_len = len(steps)
            for j in order:
                G, _ = pass_(steps, j, None)
                if G[0, 0] < 2:
                    continue
                coef, intercept = _ridge_step(G)
                steps.append((j, [i for i in range(d) if i != j], coef, intercept))
            n_iter = it + 1
            _, chg = pass_(steps, None, start_len)
            rms = math.sqrt(chg / max(miss_count.sum(), 1))
            if rms < self.tol * float(np.max(np.abs(m) + 3 * s)):
                break
        return IterativeModel(cols, m, s, steps, n_iter, [cols[j] for j in order])
