import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.operators.curves import CurveInterpolationImputer, basis, knots_of, spline_at
from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
from lacuna.operators.ordered import ForwardBackwardFillImputer, InterpolationImputer


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(7)
    n = 600
    g = rng.integers(0, 3, n)
    v = rng.normal(size=n)
    v[rng.random(n) < 0.35] = np.nan
    v[:4] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "t": rng.permutation(n) * 10, "v": v})
    return pdf, spark.createDataFrame(pdf)


def _spark_sorted(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("method,limit", [("ffill", None), ("bfill", None), ("ffill", 1), ("bfill", 2)])
def test_fill_matches_pandas(series, buckets, method, limit):
    pdf, df = series
    out = _spark_sorted(ForwardBackwardFillImputer(method, ["t", "id"], "g", limit=limit, columns=["v"],
                                                   buckets=buckets).fit_transform(df))
    ref = pdf.sort_values(["g", "t", "id"]).copy()
    ref["v"] = ref.groupby("g")["v"].transform(
        lambda s: s.ffill(limit=limit) if method == "ffill" else s.bfill(limit=limit))
    ref = ref.sort_values("id").reset_index(drop=True)
    assert np.allclose(out["v"], ref["v"], equal_nan=True)


@pytest.mark.parametrize("buckets", [1, 5])
def test_global_and_linear_match_pandas(series, buckets):
    pdf, df = series
    out = _spark_sorted(InterpolationImputer("linear", ["t", "id"], columns=["v"], buckets=buckets).fit_transform(df))
    ref = pdf.sort_values(["t", "id"]).copy()
    ref["v"] = ref["v"].interpolate(method="linear")
    ref = ref.sort_values("id").reset_index(drop=True)
    assert np.allclose(out["v"], ref["v"], equal_nan=True, atol=1e-12)


def test_time_interpolation_matches_pandas(series):
    pdf, df = series
    d = df.withColumn("ts", F.timestamp_seconds(F.col("t")))
    out = _spark_sorted(InterpolationImputer("time", ["ts", "id"], "g", columns=["v"]).fit_transform(d))
    ref = pdf.sort_values(["g", "t", "id"]).copy()
    ref["ts"] = pd.to_datetime(ref["t"], unit="s")
    ref["v"] = ref.groupby("g", group_keys=False)[["ts", "v"]].apply(
        lambda x: x.set_index("ts")["v"].interpolate(method="time").set_axis(x.index))
    ref = ref.sort_values("id").reset_index(drop=True)
    assert np.allclose(out["v"], ref["v"], equal_nan=True, atol=1e-9)


def test_splines_are_exact_on_polynomials():
    xs = np.cumsum(np.random.default_rng(0).integers(1, 6, 700)).astype(float)
    q = np.array([2.5, 7.25, 18.5, 900.0, xs[-1] + 3])
    for k, f in ((2, lambda x: 3 * (x / 100) ** 2 - x + 2), (3, lambda x: (x / 100) ** 3 - x)):
        assert np.allclose(spline_at(xs, f(xs), q, k), f(q))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_blocks_equal_the_global_spline(order):
    rng = np.random.default_rng(order)
    xs = np.cumsum(rng.integers(1, 9, 1000)).astype(float)
    ys = rng.normal(size=1000)
    q = np.setdiff1d(np.arange(xs[0], xs[-1]), xs)
    t = knots_of(xs, order)
    want = basis(t, order, q) @ np.linalg.solve(basis(t, order, xs), ys)
    assert np.abs(spline_at(xs, ys, q, order) - want).max() < 1e-9


@pytest.mark.parametrize("method", ["polynomial", "spline"])
def test_curves_do_not_depend_on_the_number_of_chunks(spark, method):
    rng = np.random.default_rng(7)
    n = 1500
    s = rng.choice(["a", None], n, p=[0.8, 0.2])
    v = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
    rows = [(i, int(i), None if s[i] is None else str(s[i]), None if np.isnan(v[i]) else float(v[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, t long, s string, v double")
    out = [CurveInterpolationImputer(method, 3, ["t", "id"], "s", "v", buckets=b).fit_transform(df).orderBy("id").toPandas()["v"].to_numpy()
           for b in (1, 16)]
    assert np.array_equal(np.isnan(out[0]), np.isnan(out[1])) and np.nanmax(np.abs(out[0] - out[1])) < 1e-9


def test_group_center_null_key_drop_skip(spark):
    rows = [(0, "a", 1.0), (1, "a", None), (2, None, 5.0), (3, None, None), (4, "b", None), (5, "c", 9.0)]
    df = spark.createDataFrame(rows, "id long, k string, x double")
    get = lambda d: [r[0] for r in d.orderBy("id").select("x").collect()]
    overall = 5.0
    assert get(GroupCenterImputer("k", columns=["x"]).fit_transform(df)) == [1.0, 1.0, 5.0, 5.0, overall, 9.0]
    assert get(GroupCenterImputer("k", fallback_strategy="drop", columns=["x"]).fit_transform(df)) == \
        [1.0, 1.0, 5.0, 5.0, None, 9.0]
    assert get(GroupCenterImputer("k", null_group="skip", columns=["x"]).fit_transform(df)) == \
        [1.0, 1.0, 5.0, None, overall, 9.0]
    with pytest.raises(ValueError):
        GroupCenterImputer("k", strategy="max")


def test_partial_mean_first_condition_wins(spark):
    rows = [(i, "p" if i < 12 else "q", float(i)) for i in range(24)] + [(100, "p", None), (101, "q", None)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    conds = {"ps": {"s": "p"}, "all": lambda d: F.col("id") >= 0, "qs": {"s": ["q"]}}
    out = PartialMeanImputer(conds, min_subset_size=10, exclude=["id"]).fit_transform(df)
    got = {r[0]: r[1] for r in out.where(F.col("id") >= 100).select("id", "x").collect()}
    assert got[100] == pytest.approx(np.mean(range(12)))
    assert got[101] == pytest.approx(np.mean(range(24)))  # 'all' comes before 'qs'


def test_hot_series_is_split_and_still_exact(spark, monkeypatch):
    """One series holds a third of the rows; with a small chunk size the
    automatic bucketing splits it, and the fill still equals pandas."""
    import lacuna.operators.ordered as O
    monkeypatch.setattr(O, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(13)
    n = 900
    g = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))
    v = rng.normal(size=n)
    v[rng.random(n) < 0.4] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "t": rng.permutation(n), "v": v})
    df = spark.createDataFrame(pdf)
    out = _spark_sorted(InterpolationImputer("linear", ["t", "id"], "g", columns=["v"]).fit_transform(df))
    ref = pdf.sort_values(["g", "t", "id"]).copy()
    ref["v"] = ref.groupby("g")["v"].transform(lambda s: s.interpolate(method="linear"))
    ref = ref.sort_values("id").reset_index(drop=True)
    assert np.allclose(out["v"], ref["v"], equal_nan=True, atol=1e-12)


def test_group_median_exact_and_approx(spark):
    rng = np.random.default_rng(17)
    pdf = pd.DataFrame({"id": np.arange(2000), "k": rng.integers(0, 3, 2000), "x": rng.normal(size=2000)})
    pdf.loc[rng.random(2000) < 0.2, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    med = pdf.groupby("k")["x"].median()
    out = GroupCenterImputer("k", strategy="median", columns=["x"]).fit_transform(df).toPandas().sort_values("id")
    holes = pdf["x"].isna().to_numpy()
    assert np.allclose(out["x"].to_numpy()[holes], med.loc[pdf["k"][holes]].to_numpy(), atol=1e-12)
    apx = GroupCenterImputer("k", strategy="median", columns=["x"], approx=True).fit_transform(df).toPandas()
    apx = apx.sort_values("id")
    assert np.allclose(apx["x"].to_numpy()[holes], med.loc[pdf["k"][holes]].to_numpy(), atol=0.05)


@pytest.mark.parametrize("method,kw", [("ffill", {}), ("bfill", {"limit": 2}), ("linear", {}), ("time", {}), ("nearest", {})])
def test_fills_do_not_depend_on_the_number_of_chunks(spark, method, kw):
    """Null series keys, null order keys and one timestamp shared by many rows."""
    rng = np.random.default_rng(6)
    n = 400
    t = rng.integers(0, 40, n).astype(object)
    t[rng.random(n) < 0.4] = 17
    t[rng.random(n) < 0.2] = None
    s = rng.choice(["a", "b"], n).astype(object)
    s[rng.random(n) < 0.5] = None
    v = rng.normal(size=n).round(3).astype(object)
    v[rng.random(n) < 0.5] = None
    rows = [(i, None if t[i] is None else int(t[i]), s[i], v[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, t long, s string, v double")
    cls = ForwardBackwardFillImputer if method in ("ffill", "bfill") else InterpolationImputer
    for part in ("s", None):
        out = [cls(method, ["t", "id"], part, columns=["v"], buckets=b, **kw).fit_transform(df).orderBy("id").collect() for b in (1, 4, 64)]
        assert out[0] == out[1] == out[2]


def test_chunks_of_whole_series_ask_for_no_halo(spark):
    from lacuna.operators.curves import halo_ranks
    per = spark.createDataFrame([("whole", 0, 5, 0, 5), ("empty", 0, 0, 0, 0), ("cut", 0, 5, 0, 9), ("cut", 1, 0, 5, 9), ("cut", 2, 4, 5, 9)],
                                "__key string, __tb int, __nobs long, __off long, __all long")
    got = sorted((r["__key"], r["__tb"], r["__rank"]) for r in halo_ranks(per, 2).collect())
    assert got == [("cut", 0, 6), ("cut", 0, 7), ("cut", 1, 4), ("cut", 1, 5), ("cut", 1, 6), ("cut", 1, 7), ("cut", 2, 4), ("cut", 2, 5)]


def test_curve_of_chunks_without_observations(spark):
    rows = [(i, "a", float(i * i % 7) if i < 20 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string, v double")
    one, many = ([r["v"] for r in CurveInterpolationImputer("spline", 3, "id", "s", "v", buckets=b).fit_transform(df).orderBy("id").collect()] for b in (1, 9))
    assert None not in one and np.allclose(one, many)
