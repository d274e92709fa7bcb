import numpy as np
import pandas as pd
import pytest

from lacuna.operators import evaluate as E


@pytest.fixture
def scored(spark):
    rng = np.random.default_rng(5)
    n = 200
    t = rng.normal(10, 3, n)
    f = t + rng.normal(0, 1, n)
    m = rng.random(n) < 0.4
    pdf = pd.DataFrame({"method": "m1", "x": f, "x__truth": t, "x__mask": m})
    return pdf, spark.createDataFrame(pdf)


def test_numeric_scores_match_numpy(scored):
    pdf, df = scored
    r = E.numeric_scores(df, ["x"]).first()
    sel = pdf[pdf["x__mask"]]
    e = sel["x"] - sel["x__truth"]
    assert r["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert r["mae"] == pytest.approx(e.abs().mean())
    r2 = 1 - (e ** 2).sum() / ((sel["x__truth"] - sel["x__truth"].mean()) ** 2).sum()
    assert r["r2"] == pytest.approx(r2)
    assert r["nrmse"] == pytest.approx(r["rmse"] / (sel["x__truth"].max() - sel["x__truth"].min()))


def test_js_divergence(spark):
    pdf = pd.DataFrame({"method": "m", "c": ["a", "a", "b", "b"], "c__truth": ["a", "b", "b", "b"],
                        "c__mask": [True] * 4})
    r = E.categorical_scores(spark.createDataFrame(pdf), ["c"]).first()
    p, q = np.array([0.25, 0.75]), np.array([0.5, 0.5])
    mm = (p + q) / 2
    kl = lambda a, b: np.sum((a + 1e-10) * np.log((a + 1e-10) / (b + 1e-10)))
    assert r["js_divergence"] == pytest.approx((kl(p, mm) + kl(q, mm)) / 2)
    assert r["accuracy"] == pytest.approx(0.75)


def test_average_rank_ties(spark):
    pdf = pd.DataFrame({"method": list("abcd"), "rmse": [1.0, 2.0, 2.0, 3.0], "mae": [1.0, 1.0, 1.0, 1.0],
                        "r2_score": [0.9, 0.5, 0.5, None], "mean_abs_bias": [0.1, 0.2, 0.3, 0.4]})
    r = {x["method"]: x for x in E.rank_methods(spark.createDataFrame(pdf)).collect()}
    assert [r[m]["rmse_rank"] for m in "abcd"] == [1.0, 2.5, 2.5, 4.0]
    assert r["a"]["mae_rank"] == 2.5
    assert r["d"]["r2_rank"] is None


def test_stacking_models_equals_stacking_their_tables(spark):
    from lacuna.operators import evaluate as E
    from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
    from lacuna.operators.simple import ConstantImputer, MeanImputer
    rows = [(i, "abc"[i % 3] if i % 7 else None, float(i * i % 11), float(i % 5)) for i in range(60)]
    m = E.holdout(spark.createDataFrame(rows, "id long, k string, x double, y double"), "id", {"x": 1, "y": 2}, 300)
    models = {"mean": MeanImputer(columns=["x", "y"]).fit(m), "group": GroupCenterImputer("k", columns=["x", "y"]).fit(m),
              "zero": ConstantImputer({"x": 0.0, "y": 0.0}).fit(m), "bands": PartialMeanImputer(columns=["x", "y"]).fit(m)}
    a = E.stack_models(m, models, ["x", "y"])
    b = E.stack_methods({n: model.transform(m) for n, model in models.items()}, ["x", "y"])
    assert sorted(map(tuple, a.select(b.columns).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
