"""Brute-force numpy references for the KNN family and the moment-based models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.operators.gaussian import EMImputer, IterativeImputer
from lacuna.operators.knn import EnhancedKNNImputer, KNNImputer, SimilarityPartialMeanImputer
from lacuna.operators.lowrank import SVDImputer
from lacuna.operators.mixture import GaussianMixtureImputer
from lacuna.operators import multiple as MI

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 300
    X = rng.integers(0, 30, size=(n, 3)).astype(float)
    X[:, 1] += X[:, 0]
    X[rng.random((n, 3)) < 0.25] = np.nan
    pdf = pd.DataFrame(X, columns=COLS)
    pdf["id"] = np.arange(n)
    return pdf, spark.createDataFrame(pdf)


def _sorted(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


def knn_ref(X, k, weights):
    n, d = X.shape
    M = ~np.isnan(X)
    out = X.copy()
    means = np.nanmean(X, axis=0)
    for j in range(d):
        for i in np.nonzero(~M[:, j])[0]:
            cands = []
            for s in np.nonzero(M[:, j])[0]:
                sh = M[i] & M[s]
                if sh.sum() == 0:
                    continue
                d2 = d * ((X[i, sh] - X[s, sh]) ** 2).sum() / sh.sum()
                cands.append((d2, s))
            cands.sort()
            top = cands[:k]
            if not top:
                out[i, j] = means[j]
                continue
            dist = np.sqrt([c[0] for c in top])
            vals = np.array([X[c[1], j] for c in top])
            if weights == "uniform":
                out[i, j] = vals.mean()
            elif (dist == 0).any():
                out[i, j] = vals[dist == 0].mean()
            else:
                out[i, j] = (vals / dist).sum() / (1 / dist).sum()
    return out


@pytest.mark.parametrize("weights", ["uniform", "distance"])
@pytest.mark.parametrize("blocked", [False, True])
def test_knn_matches_brute_force(table, weights, blocked):
    pdf, df = table
    kw = {"block_rows": 64, "broadcast_bytes": 0} if blocked else {}
    out = _sorted(KNNImputer("id", 5, weights, columns=COLS, features=COLS, **kw).fit_transform(df))
    ref = knn_ref(pdf[COLS].to_numpy(), 5, weights)
    assert np.allclose(out[COLS].to_numpy(), ref, atol=1e-9)


def test_similarity_partial_mean_matches_brute_force(table):
    pdf, df = table
    X = pdf[COLS].to_numpy()
    M = ~np.isnan(X)
    ref = X.copy()
    for j in range(3):
        avail = np.nonzero(M[:, j])[0]
        k = max(1, int(len(avail) * 0.3))
        for i in np.nonzero(~M[:, j])[0]:
            ds = []
            for s in avail:
                sh = M[i] & M[s]
                sh[j] = False
                ds.append((np.sqrt(((X[i, sh] - X[s, sh]) ** 2).sum()) if sh.any() else np.inf, s))
            ds.sort()
            ref[i, j] = X[[s for _, s in ds[:k]], j].mean()
    for kw in ({}, {"block_rows": 50, "broadcast_bytes": 0}):
        out = _sorted(SimilarityPartialMeanImputer("id", 0.3, columns=COLS, **kw).fit_transform(df))
        assert np.allclose(out[COLS].to_numpy(), ref, atol=1e-9)


def test_enhanced_knn_never_uses_self(table):
    pdf, df = table
    out = _sorted(EnhancedKNNImputer("id", 3, columns=COLS).fit_transform(df))
    assert out[COLS].isna().sum().sum() == 0
    obs = ~pdf[COLS].isna()
    assert np.allclose(out[COLS].to_numpy()[obs.to_numpy()], pdf[COLS].to_numpy()[obs.to_numpy()])


def test_em_matches_row_by_row(table):
    pdf, df = table
    X = pdf[COLS].to_numpy()
    M = np.isnan(X)
    Xf = np.where(M, np.nanmean(X, 0), X)
    for _ in range(100):
        prev = Xf.copy()
        mu, S = Xf.mean(0), np.cov(Xf, rowvar=False)
        for i in range(len(X)):
            m, o = M[i], ~M[i]
            if m.any() and o.any():
                Xf[i, m] = mu[m] + S[np.ix_(m, o)] @ np.linalg.solve(S[np.ix_(o, o)] + 1e-6 * np.eye(o.sum()),
                                                                      Xf[i, o] - mu[o])
            elif m.any():
                Xf[i, m] = mu[m]
        if np.linalg.norm(Xf - prev) < 1e-6:
            break
    model = EMImputer(columns=COLS).fit(df)
    out = _sorted(model.transform(df))
    assert np.allclose(out[COLS].to_numpy(), Xf, atol=1e-5)
    assert np.isfinite(model.log_likelihood_)


def test_svd_variants_match_numpy(table):
    pdf, df = table
    X = pdf[COLS].to_numpy()
    M = np.isnan(X)
    Xs = np.where(M, np.nanmean(X, 0), X)
    prev = Xs.copy()
    for it in range(100):
        mu = Xs.mean(0)
        U, s, Vt = np.linalg.svd(Xs - mu, full_matrices=False)
        R = U[:, :2] @ np.diag(s[:2]) @ Vt[:2] + mu
        Xs[M] = R[M]
        if it > 0 and np.linalg.norm(Xs[M] - prev[M]) < 1e-6:
            break
        prev = Xs.copy()
    out = _sorted(SVDImputer(None, tol=1e-6, center=True, scale=False, columns=COLS).fit_transform(df))
    assert np.allclose(out[COLS].to_numpy(), Xs, atol=1e-6)
    Xp = np.where(M, np.nanmean(X, 0), X)
    mz, sz = Xp.mean(0), Xp.std(0)
    Z = (Xp - mz) / sz
    prev = Z.copy()
    for _ in range(100):
        _, _, Vt = np.linalg.svd(Z, full_matrices=False)
        R = Z @ Vt[:1].T @ Vt[:1]
        Z[M] = R[M]
        if np.linalg.norm(Z - prev) < 1e-4:
            break
        prev = Z.copy()
    out = _sorted(SVDImputer(1, tol=1e-4, columns=COLS).fit_transform(df))
    assert np.allclose(out[COLS].to_numpy(), np.where(M, Z * sz + mz, X), atol=1e-8)


def test_iterative_and_mixture_fill_everything(table):
    pdf, df = table
    obs = ~pdf[COLS].isna().to_numpy()
    for imp in (IterativeImputer(columns=COLS), GaussianMixtureImputer(2, columns=COLS)):
        out = _sorted(imp.fit_transform(df))
        assert out[COLS].isna().sum().sum() == 0
        assert np.allclose(out[COLS].to_numpy()[obs], pdf[COLS].to_numpy()[obs])


def test_iterative_exact_on_linear_relation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    y = 2 * x + 1
    y[:50] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(500), "x": x, "y": y}))
    out = _sorted(IterativeImputer(columns=["x", "y"]).fit_transform(df))
    assert np.allclose(out["y"][:50], 2 * x[:50] + 1, atol=1e-3)


def test_multiple_imputation_and_rubin(table):
    pdf, df = table
    long = MI.multiple_after(df, "id", COLS, 4)
    assert long.count() == 4 * len(pdf)
    r = MI.rubin(long, COLS).toPandas().set_index("column_name")
    per = long.groupBy("imputation").agg(*[F.avg(c).alias(c) for c in COLS]).toPandas()
    for c in COLS:
        assert r.loc[c, "pooled_mean"] == pytest.approx(per[c].mean())
        assert r.loc[c, "between"] == pytest.approx(per[c].var(ddof=1), rel=1e-6, abs=1e-12)
    pooled = MI.pool(long, "id", COLS).toPandas()
    assert len(pooled) == len(pdf)


def test_em_scan_mode_equals_pattern_mode(table):
    pdf, df = table
    a = _sorted(EMImputer(columns=COLS).fit_transform(df))
    b = _sorted(EMImputer(columns=COLS, mode="scan").fit_transform(df))
    assert np.allclose(a[COLS].to_numpy(), b[COLS].to_numpy(), atol=1e-5)
    # the cap forces the scan path in auto mode
    c = _sorted(EMImputer(columns=COLS, max_patterns=2).fit_transform(df))
    assert np.allclose(b[COLS].to_numpy(), c[COLS].to_numpy(), atol=1e-9)


def _replay(model, x):
    """A row filled by the fitted chain, step by step."""
    u = (x - model.m_u) / model.s_u
    miss = np.isnan(u)
    u = np.where(miss, 0.0, u)
    for mu, P in model.chain:
        u = np.where(miss, mu + P @ (u - mu), u)
    return np.where(miss, u * model.s_u + model.m_u, x)


@pytest.mark.parametrize("kw", [{}, {"center": True, "scale": False}])
def test_svd_fills_unseen_patterns_and_new_holes(spark, table, kw):
    pdf, df = table
    complete = df.where(F.col("a").isNotNull() & F.col("b").isNotNull())  # holes only in c at fit
    model = SVDImputer(1, columns=COLS, **kw).fit(complete)
    rows = [(1000, None, 5.0, 3.0), (1001, None, 5.0, None), (1002, None, None, None), (1003, 1.0, None, 2.0)]
    out = model.transform(spark.createDataFrame(rows, "id long, a double, b double, c double")).orderBy("id").collect()
    for r, want in zip(out, rows):
        x = np.array([np.nan if v is None else v for v in want[1:]])
        assert np.allclose([r["a"], r["b"], r["c"]], _replay(model, x), atol=1e-9)


@pytest.mark.parametrize("kw", [{"n_components": 2}, {"n_components": 2, "center": True, "scale": False}])
def test_svd_scan_mode_equals_pattern_mode(spark, kw):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) + rng.normal(size=5) * 100
    X[rng.random(X.shape) < 0.2] = np.nan
    cols = list("vwxyz")
    pdf = pd.DataFrame(X, columns=cols).assign(id=np.arange(len(X)))
    df = spark.createDataFrame(pdf)
    out = [_sorted(SVDImputer(tol=1e-9, max_iter=40, mode=m, columns=cols, **kw).fit_transform(df))[cols].to_numpy()
           for m in ("patterns", "scan")]
    assert np.abs(out[0] - out[1]).max() < 1e-8


def test_wide_tables_have_no_column_limit(spark):
    rng = np.random.default_rng(5)
    d, n = 70, 120
    X = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) + 0.1 * rng.normal(size=(n, d))
    X[np.arange(n), rng.integers(0, d, n)] = np.nan
    X[0, [1, 65]] = X[1, [2, 66]] = np.nan  # 64 columns apart
    X[2:2 + d, :][np.arange(d), np.arange(d)] = np.nan  # every column has a hole
    cols = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(X, columns=cols).assign(id=np.arange(n)))
    for make in (lambda m: EMImputer(max_iter=3, columns=cols, mode=m), lambda m: SVDImputer(3, max_iter=3, columns=cols, mode=m),
                 lambda m: IterativeImputer(max_iter=1, columns=cols, mode=m)):
        for mode in ("auto", "scan") if make("auto").__class__ is not IterativeImputer else ("auto",):
            out = _sorted(make(mode).fit_transform(df))[cols].to_numpy()
            assert not np.isnan(out).any()
            assert np.array_equal(out[~np.isnan(X)], X[~np.isnan(X)])


def test_iterative_scan_equals_patterns_and_unseen_patterns(spark, table):
    pdf, df = table
    a = _sorted(IterativeImputer(columns=COLS).fit_transform(df))
    b = _sorted(IterativeImputer(columns=COLS, mode="scan").fit_transform(df))
    assert np.allclose(a[COLS].to_numpy(), b[COLS].to_numpy(), atol=1e-6)
    complete_a = df.where(F.col("a").isNotNull())
    model = IterativeImputer(columns=COLS).fit(complete_a)
    new = spark.createDataFrame([(1000, None, 5.0, None)], "id long, a double, b double, c double")
    out = model.transform(new).first()
    assert out["a"] is not None and out["c"] is not None


def test_enhanced_knn_categorical_mode(spark):
    rng = np.random.default_rng(8)
    n = 120
    x = rng.normal(size=n)
    lab = np.where(x > 0, "pos", "neg").astype(object)
    lab[rng.random(n) < 0.25] = None
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "lab": lab})
    out = _sorted(EnhancedKNNImputer("id", 3, columns=None, distance_features=["x"]).fit_transform(
        spark.createDataFrame(pdf)))
    z = (x - x.mean()) / x.std()
    for i in np.nonzero(pd.isna(lab))[0]:
        d = np.abs(z - z[i])
        d[i] = np.inf
        nb = np.lexsort((np.arange(n), d))[:3]
        vals = [lab[j] for j in nb if lab[j] is not None]
        if vals:
            counts = pd.Series(vals).value_counts()
            want = sorted(counts[counts == counts.max()].index)[0]
        else:
            want = pd.Series([v for v in lab if v is not None]).mode().iloc[0]
        assert out.loc[i, "lab"] == want


def test_knn_sees_small_differences_of_large_values(spark):
    """An exact twin outweighs a donor 1e-4 away, however large the values."""
    rows = [(0, 123456.789, 98765.4321, None), (1, 123456.789, 98765.4321, 7.0), (2, 123456.7891, 98765.4321, 100.0), (3, 1.0, 2.0, 50.0)]
    df = spark.createDataFrame(rows, "id long, p double, q double, v double")
    for kw in ({}, {"broadcast_bytes": 0, "block_rows": 2}):
        out = KNNImputer("id", 2, "distance", columns=["v"], features=["p", "q", "v"], **kw).fit_transform(df)
        assert out.where("id = 0").first()["v"] == 7.0


def test_mixture_fill_does_not_depend_on_partitions(spark, table):
    pdf, df = table
    model = GaussianMixtureImputer(2, columns=COLS, tol=1e-3).fit(df)
    a, b = (_sorted(model.transform(df.repartition(k)))[COLS].to_numpy() for k in (1, 37))
    assert np.abs(a - b).max() < 1e-9


@pytest.mark.parametrize("seed", range(3))
def test_pruned_search_equals_all_pairs(spark, monkeypatch, seed):
    from lacuna.operators import index
    rng = np.random.default_rng(seed)
    n = 500
    X = np.round(rng.normal(size=(n, 3)) * [1, 50, 0.1], 2)
    X[rng.random(X.shape) < 0.25] = np.nan
    X[:120] = [1.0, 2.0, np.nan]  # a hot cell of equal rows
    cols = list("pqr")
    df = spark.createDataFrame(pd.DataFrame(X, columns=cols).assign(id=np.arange(n)))
    want = _sorted(KNNImputer("id", 4, "distance", columns=cols, features=cols).fit_transform(df))[cols].to_numpy()
    for name, small in (("FAN", 3), ("TOP_NODES", 4 + 30 * seed), ("UNITS", 16)):
        monkeypatch.setattr(index, name, small)
    got = _sorted(KNNImputer("id", 4, "distance", columns=cols, features=cols, broadcast_bytes=0, leaf_rows=11).fit_transform(df))[cols].to_numpy()
    assert np.allclose(got, want, atol=1e-9, equal_nan=True)
