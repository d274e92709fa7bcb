import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.functions.quantiles import exact_quantiles_multi
from lacuna.operators import masks as M


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(v), float(w), "a" if i % 3 else "b") for i, (v, w) in
            enumerate(zip(rng.normal(size=3000), rng.integers(0, 20, 3000)))]
    return spark.createDataFrame(rows, "id long, x double, y double, s string")


def test_exact_quantiles_match_numpy(table):
    pdf = table.toPandas()
    got = exact_quantiles_multi(table, ["x", "y"], [0.0, 0.25, 0.5, 0.9, 1.0], max_collect=50)
    for c in ("x", "y"):
        want = np.quantile(pdf[c], [0.0, 0.25, 0.5, 0.9, 1.0])
        assert np.allclose(got[c], want, rtol=0, atol=1e-12)


def test_mcar_exact_count_and_stability(table):
    a = M.mcar(table, "id", ["x", "y"], rate=0.1, exact=True)
    assert a.where(F.col("x").isNull()).count() == 300
    assert a.where(F.col("y").isNull()).count() == 300
    b = M.mcar(table.repartition(7), "id", ["x", "y"], rate=0.1, exact=True)
    ids = lambda d: sorted(r[0] for r in d.where(F.col("x").isNull()).select("id").collect())
    assert ids(a) == ids(b)


def test_mcar_cells_exact(table):
    a = M.mcar_cells(table, "id", ["x", "y"], rate=0.2, exact=True)
    n = a.where(F.col("x").isNull()).count() + a.where(F.col("y").isNull()).count()
    assert n == int(3000 * 2 * 0.2)


def test_mar_only_in_condition(table):
    a = M.mar(table, "id", "x", "s", "b", rate=0.5, exact=True)
    assert a.where(F.col("x").isNull() & (F.col("s") != "b")).count() == 0
    assert a.where(F.col("x").isNull()).count() == int(1000 * 0.5)


def test_mnar_tail_and_middle(table):
    pdf = table.toPandas()
    t = M.mnar(table, "x", "tail", 0.2)
    q = np.quantile(pdf["x"], 0.8)
    assert t.where(F.col("x").isNull()).count() == int((pdf["x"] > q).sum())
    m = M.mnar(table, "x", "middle", 0.2)
    lo, hi = np.quantile(pdf["x"], [0.4, 0.6])
    assert m.where(F.col("x").isNull()).count() == int(((pdf["x"] >= lo) & (pdf["x"] <= hi)).sum())
    with pytest.raises(ValueError):
        M.mnar(table, "s", "tail", 0.2)


def test_dispatch_honors_mechanism(table):
    with pytest.raises(ValueError):
        M.introduce_missing(table, "id", "nonsense", 0.1)


def test_outliers(table):
    o = M.inject_outliers(table, "id", "x", 20, 10.0)
    mx = table.agg(F.max("x")).first()[0]
    assert o.where(F.col("x") == 10 * mx).count() == 20


def test_grouped_exact_quantiles_hot_group_and_null_key(spark):
    import pandas as pd
    from lacuna.functions.quantiles import grouped_exact_quantiles
    rng = np.random.default_rng(1)
    n = 20000
    g = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdef"), n)).astype(object)
    g[rng.random(n) < 0.01] = None
    pdf = pd.DataFrame({"g": g, "v": rng.normal(size=n).round(3)})
    res = grouped_exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", [0.5, 0.25],
                                  max_collect=100).toPandas()
    ref = pdf.groupby("g", dropna=False)["v"].quantile([0.5, 0.25]).unstack()
    assert len(res) == 8
    for _, r in res.iterrows():
        rr = ref.loc[r["g"]] if r["g"] is not None else ref.loc[ref.index.isna()].iloc[0]
        assert abs(rr[0.5] - r["q0"]) < 1e-12 and abs(rr[0.25] - r["q1"]) < 1e-12


def test_quantiles_with_infinities_wide_ranges_and_ties(spark):
    from lacuna.functions.quantiles import exact_quantiles, grouped_exact_quantiles
    rng = np.random.default_rng(2)
    v = np.concatenate([10.0 ** rng.uniform(-300, 300, 500), [np.inf] * 3, [-np.inf], np.full(400, 7.0), -(10.0 ** rng.uniform(-9, 9, 200))])
    df = spark.createDataFrame([("g" if i % 3 else None, float(x)) for i, x in enumerate(v)], "g string, v double")
    probs = [0.0, 0.1, 0.35, 0.5, 0.75, 0.999, 1.0]
    assert exact_quantiles(df, "v", probs, max_collect=5) == exact_quantiles(df, "v", probs, max_collect=10 ** 6)
    few = grouped_exact_quantiles(df, ["g"], "v", probs, max_collect=5).orderBy("g").collect()
    many = grouped_exact_quantiles(df, ["g"], "v", probs, max_collect=10 ** 6).orderBy("g").collect()
    assert len(few) == 2 and few == many
    g = np.sort(np.array([x for i, x in enumerate(v) if i % 3 == 0]))
    assert few[0]["q0"] == g[0] and few[0]["q6"] == g[-1]


def test_hash_has_no_period_and_takes_any_id(spark):
    from lacuna.functions.hashing import full_hash, gaussian_noise
    ids = [0, 1, 1_000_003, 2_000_006, 10 ** 13, 9 * 10 ** 17, 2 ** 63 - 1]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id long, s string")
    got = df.select(full_hash("id", 1).alias("a"), full_hash("s", 1).alias("b"), full_hash("id", "1|x").alias("c")).collect()
    assert len({r["a"] for r in got}) == len({r["c"] for r in got}) == len(ids) and all(r["a"] == r["b"] != r["c"] for r in got)
    big = spark.range(200_000)
    assert big.select(gaussian_noise("id", 3).alias("z")).distinct().count() == 200_000
    rare = M.mcar(big.withColumn("x", F.lit(1.0)), "id", ["x"], rate=0.0004)
    assert 40 < rare.where(F.col("x").isNull()).count() < 130
    exact = M.mcar(big.select((F.col("id") + 10 ** 15).alias("id"), F.lit(1.0).alias("x")), "id", ["x"], rate=0.001, exact=True)
    assert exact.where(F.col("x").isNull()).count() == 200
