"""Mergeable statistics, pattern tables, frames paired by id, wide pair statistics, own mixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.operators import analysis, evaluate
from lacuna.operators.align import FrameScores
from lacuna.operators.gaussian import EMImputer, IterativeImputer
from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
from lacuna.operators.lowrank import SVDImputer
from lacuna.operators.mixture import GaussianMixtureImputer, select_components
from lacuna.operators.simple import MeanImputer
from lacuna.operators.states import GroupMeanState, MeanState, MomentState, load_state, merged

COLS = list("abcd")


@pytest.fixture(scope="module")
def holes(spark):
    rng = np.random.default_rng(12)
    n = 900
    x = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 4)) * [1, 30, 0.1, 5] + [0, 5000, -3, 1e6]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:300] += [1, 10, 0, 2]  # the parts differ
    pdf = pd.DataFrame(x, columns=COLS).assign(id=np.arange(n), g=[None if i % 11 == 0 else "uvw"[i % 3] for i in range(n)])
    df = spark.createDataFrame(pdf).cache()
    return pdf, df, [df.where("id < 300"), df.where("id >= 300 AND id < 500"), df.where("id >= 500")]


def _filled(model, df):
    return model.transform(df).orderBy("id").toPandas()[COLS].to_numpy(float)


def test_merged_means_equal_the_fit_on_all(spark, holes, tmp_path):
    _, df, parts = holes
    got = merged([MeanState.of(p, COLS) for p in parts])
    got.save(spark, str(tmp_path / "m"))
    want = MeanImputer(columns=COLS).fit(df)
    for state in (got, load_state(spark, str(tmp_path / "m"))):
        assert np.allclose(_filled(state.model(), df), _filled(want, df), rtol=1e-12)
    state = merged([GroupMeanState.of(p, "g", COLS) for p in parts])
    state.save(spark, str(tmp_path / "g"))
    want = GroupCenterImputer("g", columns=COLS).fit(df)
    for s in (state, load_state(spark, str(tmp_path / "g"))):
        assert np.allclose(_filled(s.model(), df), _filled(want, df), rtol=1e-12)
    with pytest.raises(ValueError):
        state.merge(GroupMeanState.of(df, "g", ["a"]))


def test_merged_moments_equal_the_fit_on_all(spark, holes, tmp_path):
    _, df, parts = holes
    state = merged([MomentState.of(p, COLS) for p in parts])
    state.save(spark, str(tmp_path / "s"))
    state = load_state(spark, str(tmp_path / "s"))
    for got, want in ((state.em(12, 1e-8), EMImputer(12, 1e-8, columns=COLS)), (state.svd(n_components=2, max_iter=10), SVDImputer(2, 10, columns=COLS)),
                      (state.svd(n_components=2, max_iter=6, center=True, scale=False), SVDImputer(2, 6, center=True, scale=False, columns=COLS)),
                      (state.iterative(3), IterativeImputer(3, columns=COLS))):
        assert np.allclose(_filled(got, df), _filled(want.fit(df), df), rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("make", [lambda **k: EMImputer(8, 1e-7, init="median", columns=COLS, **k), lambda **k: SVDImputer(2, 8, columns=COLS, **k),
                                  lambda **k: IterativeImputer(3, columns=COLS, **k)])
def test_pattern_table_equals_scan(holes, make):
    _, df, _ = holes
    a, b = _filled(make(mode="table").fit(df), df), _filled(make(mode="scan").fit(df), df)
    assert np.allclose(a, b, rtol=1e-8, atol=1e-8)
    assert np.allclose(_filled(make(max_patterns=3).fit(df), df), b, rtol=1e-8, atol=1e-8)


def test_many_patterns_from_two_scans(spark):
    """Thousands of patterns, too many for the driver by the given bound."""
    rng = np.random.default_rng(5)
    n, d = 6000, 13
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) + rng.normal(size=(n, d)) * 0.3
    x[rng.random(x.shape) < 0.45] = np.nan
    cols = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(id=np.arange(n))).cache()
    a, b = EMImputer(4, 0.0, columns=cols, mode="table").fit(df), EMImputer(4, 0.0, columns=cols, mode="scan").fit(df)
    assert len(np.unique(np.isnan(x), axis=0)) > 2000
    assert np.allclose(a.mu_, b.mu_, atol=1e-8) and np.allclose(a.sigma_, b.sigma_, atol=1e-8)
    assert np.allclose(a.log_likelihood_history_, b.log_likelihood_history_, rtol=1e-8)


def test_predicates_are_kept_as_text(spark, holes, tmp_path):
    from lacuna.operators.base import load_model
    _, df, _ = holes
    imp = PartialMeanImputer({"big": lambda t: (t["b"] > 5000) & t["g"].isin("u", "v"), "text": "a < 0", "dict": {"g": "w"}}, columns=["a", "d"])
    model = imp.fit(df)
    want = _filled(model, df)
    model.save(str(tmp_path / "m"))
    assert np.allclose(_filled(load_model(str(tmp_path / "m")), df), want, equal_nan=True)
    direct = PartialMeanImputer({"big": "b > 5000 AND g IN ('u', 'v')", "text": "a < 0", "dict": {"g": "w"}}, columns=["a", "d"]).fit(df)
    assert np.allclose(_filled(direct, df), want, equal_nan=True)


# --- frames

def _frames(spark, n=300):
    rng = np.random.default_rng(1)
    truth = pd.DataFrame({"id": [f"k{i}" for i in range(n)], "x": rng.normal(size=n), "y": rng.normal(size=n)})
    mask = pd.DataFrame({"id": truth["id"], "x": rng.random(n) < 0.3, "y": rng.random(n) < 0.3})
    fill = truth.assign(x=truth["x"] + 0.1, y=np.where(rng.random(n) < 0.2, np.nan, truth["y"] * 2))
    return truth, mask, fill


def test_frames_are_paired_by_id(spark):
    truth, mask, fill = _frames(spark)
    t, m, f = (spark.createDataFrame(p.sample(frac=1, random_state=k)) for k, p in enumerate((truth, mask, fill)))
    frames = FrameScores(t, m, "id", ["x", "y"], buckets=4).add("one", f).add("two", t.select("id", "x", "y"))
    scored = frames.scored()
    both = spark.createDataFrame(pd.concat([fill.rename(columns={}), truth[["x", "y"]].add_suffix("__truth"), mask[["x", "y"]].add_suffix("__mask")], axis=1))
    want = evaluate.numeric_scores(evaluate.stack_methods({"one": both}, ["x", "y"]), ["x", "y"]).orderBy("column_name").collect()
    got = evaluate.numeric_scores(scored.where("method = 'one'"), ["x", "y"]).orderBy("column_name").collect()
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert a == b or abs(a - b) < 1e-9
    assert all(r.rmse == 0 for r in evaluate.numeric_scores(scored.where("method = 'two'"), ["x", "y"]).collect())
    plan = scored.where("method = 'one'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # buckets meet side by side, or a small one is broadcast
    wide = evaluate.wide_scores(evaluate.numeric_scores(scored, ["x", "y"]), ["x", "y"], ("rmse",))
    assert set(wide.columns) == {"method", "x_rmse", "y_rmse"} and wide.count() == 2
    frames.close()


def test_unpaired_rows_are_reported(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (3, 4.0), (5, 5.0), (None, 9.0)], "id long, x double")
    m = spark.createDataFrame([(1, True), (2, None), (3, True), (9, True)], "id long, x boolean")
    f = spark.createDataFrame([(1, 1.5), (2, 2.5), (2, 2.6), (3, 3.0), (7, 1.0), (None, 1.0), (None, 2.0)], "id long, x double")
    frames = FrameScores(t, m, "id", ["x"], buckets=2).add("m", f)
    assert [tuple(r) for r in frames.scored().select("id", "x", "x__truth", "x__mask").collect()] == [(1, 1.5, 1.0, True)]
    got = frames.report().first().asDict()
    assert got == {"method": "m", "n_paired": 1, "n_without_fill": 1, "n_without_truth": 1, "n_without_mask": 1, "n_repeated": 2, "n_without_id": 2}
    with pytest.raises(ValueError):
        frames.add("bad", t.drop("x"))
    frames.close()


# --- pairs

def test_wide_pairs_equal_pandas(spark):
    rng = np.random.default_rng(7)
    n, d = 400, 60
    x = rng.normal(size=(n, 5)) @ rng.normal(size=(5, d)) * rng.uniform(0.1, 1000, d) + rng.uniform(-1e6, 1e6, d)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 7] = 4.0  # no spread
    x[:, 8] = np.nan
    x[1:, 9] = np.nan  # one value
    cols = [f"c{i}" for i in range(d)]
    pdf = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame(pdf.assign(method=np.where(np.arange(n) % 2, "p", "q"))).repartition(5)
    got = {(r.method, r.col_a, r.col_b): (r.corr, r.covariance) for r in analysis.pair_stats(df, cols).collect()}
    assert len(got) == 2 * d * (d - 1) // 2
    for k, part in (("p", pdf[1::2]), ("q", pdf[::2])):
        corr, cov = part.corr(min_periods=2).to_numpy(), part.cov(min_periods=2).to_numpy()
        for i in range(d):
            for j in range(i + 1, d):
                a, b = got[k, cols[i], cols[j]]
                assert (a is None and np.isnan(corr[i, j])) or abs(a - corr[i, j]) < 1e-9, (i, j, a, corr[i, j])
                spread = np.sqrt(np.nan_to_num(cov[i, i] * cov[j, j]))
                assert (b is None and np.isnan(cov[i, j])) or abs(b - cov[i, j]) <= 1e-9 * max(1, spread), (i, j)
    few = analysis.pair_stats(df, cols[:5]).collect()
    for r in few:  # the aggregates give the same
        assert abs(got[r.method, r.col_a, r.col_b][0] - r.corr) < 1e-9


def test_models_that_run_python_are_not_stacked(spark, holes):
    _, df, _ = holes
    with pytest.raises(TypeError):
        evaluate.stack_models(df, {"em": EMImputer(2, columns=COLS).fit(df)}, COLS)


# --- mixtures

def test_two_clusters_are_found(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (400, 2)), rng.normal(8, 1, (200, 2)) * [1, -1]])
    hole = rng.random(600) < 0.3
    pdf = pd.DataFrame(x, columns=["x", "y"]).assign(id=np.arange(600))
    pdf.loc[hole, "y"] = np.nan
    df = spark.createDataFrame(pdf).repartition(3)
    model = GaussianMixtureImputer(2, columns=["x", "y"], id_col="id").fit(df)
    again = GaussianMixtureImputer(2, columns=["x", "y"], id_col="id").fit(df.repartition(7))
    assert np.allclose(np.sort(model.weights_), np.sort(again.weights_), atol=1e-9)
    assert abs(max(model.weights_) - 2 / 3) < 0.03
    got = model.transform(df).orderBy("id").toPandas()["y"].to_numpy()
    assert np.abs(got[hole] - x[hole, 1]).mean() < 2.0
    table = {r.n_components: r for r in select_components(df, ["x", "y"], ks=(1, 2, 3), id_col="id").collect()}
    assert table[2].bic < table[1].bic and table[3].log_likelihood >= table[1].log_likelihood
    one = {r.n_components: r for r in select_components(df, ["x", "y"], ks=(2,), id_col="id").collect()}
    assert abs(one[2].log_likelihood - table[2].log_likelihood) < 1e-6  # shared scans change nothing
    assert select_components(df, ["x", "y"], ks=(2,)).count() == 1


def test_equal_rows_and_few_rows(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0 if i else None) for i in range(5)], "id long, x double, y double")
    out = GaussianMixtureImputer(3, columns=["x", "y"]).fit_transform(df).where("id = 0").first()
    assert abs(out["y"] - 2.0) < 1e-6
