"""The packed tree: bounds, neighbour search and range counting against all pairs, at every depth."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.operators import index, knn
from lacuna.operators.knn import EnhancedKNNImputer, KNNImputer, SimilarityPartialMeanImputer

COLS = list("pqr")


def _holes(seed, n=500, hot=120):
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, 3)) * [1, 50, 0.1], 2)
    X[rng.random(X.shape) < 0.25] = np.nan
    X[:hot] = [1.0, 2.0, np.nan]  # equal rows, a quarter of all
    X[hot:hot + 60, 2] = X[hot:hot + 60, 1] * 0 + 0.5
    return X


def _table(spark, X, key="id"):
    return spark.createDataFrame(pd.DataFrame(X, columns=COLS).assign(**{key: np.arange(len(X))}))


@pytest.fixture(params=[(3, 4), (64, 4096)])
def shape(request, monkeypatch):
    monkeypatch.setattr(index, "FAN", request.param[0])
    monkeypatch.setattr(index, "TOP_NODES", request.param[1])
    monkeypatch.setattr(index, "UNITS", 16)
    return request.param


def test_every_row_is_in_one_leaf_and_bounds_hold(spark, shape):
    X = _holes(5)
    tree = index.build(_table(spark, X).withColumnRenamed("id", "__id"), COLS, 11)
    ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in tree.leaves.collect()])
    assert sorted(ids) == list(range(len(X)))
    assert all(len(r.ids) <= 11 * 8 for r in tree.leaves.collect()) and len(tree.top.node) <= max(shape[1], 1)
    assert tree.top.n.sum() == len(X) and (tree.top.count.sum(axis=0) == (~np.isnan(X)).sum(axis=0)).all()
    assert np.allclose(tree.top.sum.sum(axis=0), np.nansum(X, axis=0))
    for level in tree.levels:
        kids = [k for r in level.collect() for k in r.kids]
        assert len({k.node for k in kids}) == len(kids) and sum(k.n for k in kids) == len(X)
        assert max(len(r.kids) for r in level.collect()) <= shape[0]
    low, top = tree.top.distances(X, [0, 1, 2])
    d = np.where(np.isnan(X[:, None] - X[None]), 0, X[:, None] - X[None]) ** 2
    some = (~np.isnan(X[:, None] - X[None])).any(axis=2)
    dist = np.where(some, d.sum(axis=2), np.inf)
    assert (low.min(axis=1) <= dist.min(axis=1) + 1e-9).all() and (top.max(axis=1) >= dist.max(axis=1) - 1e-9).all()


@pytest.mark.parametrize("shape, metric, few", [((3, 4), "euclidean", 9), ((64, 4096), "manhattan", 40)], indirect=["shape"])
def test_range_counting_equals_all_pairs(spark, shape, monkeypatch, metric, few):
    monkeypatch.setattr(knn, "FEW", few)
    df = _table(spark, _holes(7, 150, 40))
    want = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS).fit_transform(df).orderBy("id").toPandas()
    got = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS, broadcast_bytes=0, leaf_rows=13).fit_transform(df).orderBy("id").toPandas()
    assert np.allclose(got[COLS].to_numpy(float), want[COLS].to_numpy(float), atol=1e-9)


def test_any_fraction_and_rows_without_shared_features(spark, monkeypatch):
    monkeypatch.setattr(knn, "FEW", 9)
    rng = np.random.default_rng(2)
    X = rng.normal(size=(90, 3))
    X[::3, 0] = np.nan
    X[1::3, [1, 2]] = np.nan  # with the first: no feature in common
    df = _table(spark, X)
    fractions = [0.01, 1.0]
    a = SimilarityPartialMeanImputer("id", 0.3, columns=COLS).fit(df).sweep(df, fractions)
    b = SimilarityPartialMeanImputer("id", 0.3, columns=COLS, broadcast_bytes=0, leaf_rows=7).fit(df).sweep(df, fractions)
    for f in fractions:
        x, y = (t[f].orderBy("id").toPandas()[COLS].to_numpy(float) for t in (a, b))
        assert np.allclose(x, y, atol=1e-9)


def test_string_ids(spark):
    X = _holes(3, 150, 30)
    num = _table(spark, X)
    text = num.withColumn("id", F.format_string("k%05d", "id"))
    mixed = text.withColumn("s", F.when(F.col("p") > 0, "up").when(F.col("p") < 0, "down"))
    for kw in ({}, {"broadcast_bytes": 0, "leaf_rows": 9}):
        for make in (lambda **k: KNNImputer("id", 4, "distance", columns=COLS, features=COLS, **k),
                     lambda **k: SimilarityPartialMeanImputer("id", 0.3, columns=COLS, **k)):
            want = make().fit_transform(num).orderBy("id").toPandas()[COLS].to_numpy(float)
            got = make(**kw).fit_transform(text).orderBy("id").toPandas()
            assert got["id"].tolist() == [f"k{i:05d}" for i in range(150)]
            assert np.allclose(got[COLS].to_numpy(float), want, atol=1e-9)
        want = EnhancedKNNImputer("id", 4, columns=COLS).fit_transform(num).orderBy("id").toPandas()[COLS].to_numpy(float)
        got = EnhancedKNNImputer("id", 4, **kw).fit_transform(mixed).orderBy("id").toPandas()
        assert np.allclose(got[COLS].to_numpy(float), want, atol=1e-9) and not got["s"].isna().any()


def test_one_feature_equal_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else 1.0) for i in range(60)], "id long, p double")
    for make in (lambda: KNNImputer("id", 3, columns=["p"], features=["p"], broadcast_bytes=0, leaf_rows=4),
                 lambda: SimilarityPartialMeanImputer("id", 0.3, columns=["p"], broadcast_bytes=0, leaf_rows=4)):
        assert {r.p for r in make().fit_transform(df).collect()} == {1.0}
    two = spark.createDataFrame([(i, 2.0, None if i % 5 == 0 else float(i)) for i in range(60)], "id long, p double, q double")
    want = KNNImputer("id", 3, columns=["q"], features=["p", "q"]).fit_transform(two).orderBy("id").collect()
    assert KNNImputer("id", 3, columns=["q"], features=["p", "q"], broadcast_bytes=0, leaf_rows=4).fit_transform(two).orderBy("id").collect() == want
    model = KNNImputer("id", 3, columns=["q"], features=["p", "q"], broadcast_bytes=-1, leaf_rows=4).fit(two)
    assert model.transform(two.limit(0)).count() == 0


def test_blocks_hold_units_that_reach_the_same_leaves(spark, monkeypatch):
    monkeypatch.setattr(index, "UNITS", 16)
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"__id": rng.permutation(640), "p": rng.permutation(640) * 1.0})
    rows = spark.createDataFrame(pdf).repartition(1)
    tree = index.build(rows, ["p"], 20)
    units = index.units_of_holes(tree, rows, None)

    def inside(units, boxes):
        low, _ = boxes.distances(units.x, [0])
        return units.state, low == 0, None
    blocks = index.descend(tree, units, 0, inside, inside).collect()
    assert sum(b.m for b in blocks) == 640 and len(blocks) <= 2 * 640 / 16 + len(tree.top.node)

    def met(units, ids, x):
        assert sorted(units.rids) == sorted(i for i in units.rids if i in set(ids))
        return pd.DataFrame({"rid": units.rids})
    got = index.scanned(tree, index.descend(tree, units, 0, inside, inside), 0, met, "rid long").collect()
    assert sorted(r.rid for r in got) == list(range(640))


def test_many_donors_go_through_the_tree(spark, monkeypatch):
    df = _table(spark, _holes(11, 120, 30))
    makers = (lambda: KNNImputer("id", 4, columns=COLS, features=COLS), lambda: EnhancedKNNImputer("id", 4, columns=COLS))
    want = [m().fit_transform(df).orderBy("id").toPandas()[COLS].to_numpy(float) for m in makers]
    monkeypatch.setattr(knn, "FEW_DONORS", 100)
    monkeypatch.setattr(knn, "_shipped", None)
    for make, w in zip(makers, want):
        assert np.allclose(make().fit_transform(df).orderBy("id").toPandas()[COLS].to_numpy(float), w, atol=1e-9)


def _share_means(pdf, cols, fraction, metric):
    """Row by row: mean of the nearest share, ties by id, rows without a shared feature last."""
    x, out = pdf[cols].to_numpy(float), {}
    for j, c in enumerate(cols):
        don = np.flatnonzero(~np.isnan(x[:, j]))
        for i in np.flatnonzero(np.isnan(x[:, j])):
            diff = np.delete(x[don] - x[i], j, axis=1)
            dist = np.nansum(diff * diff if metric == "euclidean" else np.abs(diff), axis=1)
            dist[np.isnan(diff).all(axis=1)] = np.inf
            near = np.lexsort((pdf["id"].to_numpy()[don], dist))[:max(1, int(len(don) * fraction))]
            out[int(pdf["id"][i]), j] = x[don[near], j].mean()
    return out


def test_nearest_share_is_ranked_inside_the_task(spark, monkeypatch):
    """Only fills leave a task, no counts per block of donors; leaves of one donor up, ties, rows without a feature."""
    from lacuna.operators import knn
    monkeypatch.setattr(knn, "_shipped", None)
    rng = np.random.default_rng(8)
    x = np.round(rng.lognormal(3, 1, (300, 3)) * [10, 1, 0.1])
    x[rng.random(x.shape) < 0.3] = np.nan
    x[100:160] = x[100]  # equal rows: ties
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=rng.permutation(300) * 7)
    df = spark.createDataFrame(pdf)
    for leaf_rows, metric in ((1, "euclidean"), (17, "manhattan"), (256, "euclidean")):
        monkeypatch.setattr(knn, "SHARE_LEAF_ROWS", leaf_rows)
        got = SimilarityPartialMeanImputer("id", 0.3, metric, columns=["a", "b", "c"]).fit_transform(df).toPandas().set_index("id")
        for (i, j), v in _share_means(pdf, ["a", "b", "c"], 0.3, metric).items():
            assert abs(got.loc[i].iloc[j] - v) < 1e-9, (leaf_rows, i, j)


def test_nearest_share_looks_at_few_donors(monkeypatch):
    from lacuna.operators import knn
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=20_000), rng.lognormal(5, 1, 20_000), rng.normal(size=20_000)])
    laid = knn._Laid(x, np.arange(20_000), 0, *knn._leaf_order(x, 0, 64))
    seen, distances = [], knn._Laid.distances
    monkeypatch.setattr(knn._Laid, "distances", lambda self, row, at, metric: seen.append(len(at)) or distances(self, row, at, metric))
    rows = x[:20] * [np.nan, 1, 1]
    low, top = laid.bounds(rows, "euclidean")
    for r, a, b in zip(rows, low, top):
        dist = ((x[:, 1:] - r[1:]) ** 2).sum(axis=1)
        want = x[np.argsort(dist, kind="stable")[:6000], 0].mean()
        assert abs(laid.nearest_mean(r[None], a, b, [6000], "euclidean")[0] - want) < 1e-9
    assert max(seen) < 2_000


def test_nearest_share_writes_no_row_per_hole_and_leaf(spark, monkeypatch):
    written, cut = [], index.cut

    def counted(df):
        out = cut(df)
        raw = [F.coalesce(F.length(f.name), F.lit(0)) for f in out.schema.fields if f.dataType.typeName() == "binary"]
        if raw:
            written.append(out.agg(F.coalesce(F.sum(sum(raw[1:], raw[0])), F.lit(0))).first()[0])
        return out
    monkeypatch.setattr(index, "cut", counted)
    monkeypatch.setattr(knn, "cut", counted)
    rng = np.random.default_rng(6)
    X = np.round(rng.normal(size=(1200, 3)) * [1, 2, 1.5], 2)
    X[rng.random(X.shape) < 0.25] = np.nan
    df, holes = _table(spark, X), int(np.isnan(X).sum())
    monkeypatch.setattr(knn, "GROUP_UNITS", 128, raising=False)  # several groups
    got = SimilarityPartialMeanImputer("id", 0.3, columns=COLS, broadcast_bytes=0, leaf_rows=8).fit_transform(df).orderBy("id").toPandas()
    want = SimilarityPartialMeanImputer("id", 0.3, columns=COLS).fit_transform(df).orderBy("id").toPandas()
    assert np.allclose(got[COLS].to_numpy(float), want[COLS].to_numpy(float), atol=1e-9)
    assert max(written) <= 200 * (holes + len(X))  # some 150 leaves: before, 100 bytes for each that a hole reached


def test_a_wrong_guess_ties_and_repeated_ids_end_in_the_exact_share(spark):
    rng = np.random.default_rng(8)
    X = rng.integers(0, 4, size=(300, 2)).astype(float)  # many equal distances
    ids, v = rng.permutation(300) - 150, rng.normal(size=300)
    x = np.column_stack([X, v])
    unit = knn._unit_type(3)
    rows = np.zeros(7, unit)
    rows["rid"], rows["k"], rows["ilo"], rows["ihi"], rows["n"] = [1, 2, 3, 4, 5, 6, 6], [1, 90, 90, 150, 300, 120, 120], ids.min(), ids.max(), -1
    rows["x"] = [[i % 3, 1.0, np.nan] for i in range(7)]
    rows["lo"], rows["hi"], rows["slo"], rows["shi"] = [5, 7, 0, 0, 0, 3, 3], [6, 8, 0.1, 0, 0.5, 4, 4], 0, 100  # k-th below, above and in the range
    fills = {}
    for _ in range(60):
        work = knn._Ranged(2, rows, None, "euclidean", 4, 5)
        for at in range(0, 300, 11):
            work.visit(ids[at:at + 11], x[at:at + 11])
        rows, done, got = work.result()
        fills |= dict(zip(done["rid"].tolist(), got.tolist()))
        if not len(rows):
            break
    for rid, k, mine in ((1, 1, [0]), (2, 90, [1]), (3, 90, [2]), (4, 150, [0]), (5, 300, [1]), (6, 120, [2, 0])):
        pairs = sorted((((X[i, 0] - m) ** 2 + (X[i, 1] - 1) ** 2), ids[i], v[i]) for m in mine for i in range(300))
        assert abs(fills[rid] - np.mean([p[2] for p in pairs[:k]])) < 1e-9, rid


def _odd_rows(seed):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(60, 500)), int(rng.integers(2, 5))
    x = rng.lognormal(2, 1, (n, d)) * 10.0 ** rng.integers(-1, 3, d)
    if seed % 2:
        x = np.round(x / np.median(x, axis=0) * 2)  # many ties
    if seed % 3 == 0:
        x[:n // 3] = x[0]
    x[rng.random(x.shape) < 0.3] = np.nan
    return x, np.sort(rng.choice(10**6, n, replace=False)) - 500_000


@pytest.mark.parametrize("seed", range(6))
def test_held_shares_and_neighbours_equal_all_pairs(monkeypatch, seed):
    """Guesses that fail, leaves per set of features, equal rows taken whole with ties by id: always the exact donors."""
    x, ids = _odd_rows(seed)
    for name, values in {"POINT_ROWS": (1, 4, 32), "OWN_UNITS": (1, 20, 500), "LOOK_ROWS": (7, 64, 4096), "BLOCK_UNITS": (3, 32, 8),
                         "NEAR_LEAVES": (1, 2, 8), "DONOR_ROWS": (5, 8192, 40)}.items():
        monkeypatch.setattr(knn, name, values[seed % 3])
    for leaf_rows, j in ((1, 0), (7, 1), (64, x.shape[1] - 1)):
        don, u = np.flatnonzero(~np.isnan(x[:, j])), np.flatnonzero(np.isnan(x[:, j]))
        ks = [max(1, int(len(don) * f)) for f in (0.05, 0.3, 0.8, 1.0)]
        for metric in ("euclidean", "manhattan"):
            got = knn._share_fills(ids, x, j, u, x[u], ks, metric, leaf_rows).set_index(["rid", "f"])["fill"]
            for i in u:
                diff = np.delete(x[don] - x[i], j, axis=1)
                dist = np.nansum(diff * diff if metric == "euclidean" else np.abs(diff), axis=1)
                dist[np.isnan(diff).all(axis=1)] = np.inf
                near = x[don[np.lexsort((ids[don], dist))], j]
                assert np.allclose([got[i, f] for f in range(4)], [near[:k].mean() for k in ks], rtol=1e-10)
        for laid, b in knn._blocks(ids, x, j, x[u], leaf_rows):
            a, at, dist = laid.nearest(u[b], x[u[b]], 4, True, 0)
            for q, i in enumerate(u[b]):
                diff = x[don] - x[i]
                shared, ss = (~np.isnan(diff)).sum(axis=1), np.zeros(len(don))
                for c in range(x.shape[1]):
                    ss += np.nan_to_num(diff[:, c]) ** 2
                every = np.array([x.shape[1] * s / n if n else np.inf for s, n in zip(ss, shared)])
                want = [w for w in sorted(zip(every, ids[don]))[:4] if np.isfinite(w[0])]
                assert sorted(zip(dist[a == q], laid.ids[at[a == q]])) == want


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_shares_of_donors_too_large_to_ship_need_no_rounds(spark, monkeypatch, metric):
    """Donors stream into tasks that hold them; only beyond HELD_BYTES are ranges counted in rounds."""
    counted = knn._counted
    df, fractions = _table(spark, np.vstack([_holes(7, 150, 40), _holes(8, 50, 10)])), [0.3, 0.8]
    want = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS, broadcast_bytes=0, leaf_rows=13).fit(df)
    monkeypatch.setattr(knn, "HELD_BYTES", 0, raising=False)
    want = {f: t.orderBy("id").toPandas()[COLS].to_numpy(float) for f, t in want.sweep(df, fractions).items()}
    monkeypatch.undo()
    monkeypatch.setattr(knn, "_counted", None)
    got = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS, broadcast_bytes=0).fit(df).sweep(df, fractions)
    for f in fractions:
        assert np.allclose(got[f].orderBy("id").toPandas()[COLS].to_numpy(float), want[f], atol=1e-9)
    twice = df.unionByName(df.where("id % 3 = 0"))  # rows of one id share their fill
    got = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS, broadcast_bytes=0).fit_transform(twice).orderBy("id").toPandas()
    monkeypatch.setattr(knn, "_counted", counted)
    monkeypatch.setattr(knn, "HELD_BYTES", 0, raising=False)
    want = SimilarityPartialMeanImputer("id", 0.3, metric, columns=COLS, broadcast_bytes=0, leaf_rows=13).fit_transform(twice).orderBy("id").toPandas()
    assert np.allclose(got[COLS].to_numpy(float), want[COLS].to_numpy(float), atol=1e-9)


def test_neighbours_of_many_donors_need_no_descent(spark, monkeypatch):
    """Candidates leave a task as the k nearest of each hole; only beyond HELD_BYTES do blocks of units descend a tree."""
    df = _table(spark, _holes(11, 160, 40))
    mixed = df.unionByName(df.where("id % 4 = 0"))
    makers = (lambda: KNNImputer("id", 4, columns=COLS, features=COLS, broadcast_bytes=0, leaf_rows=9),
              lambda: KNNImputer("id", 3, "distance", columns=["q"], features=COLS, broadcast_bytes=0),
              lambda: EnhancedKNNImputer("id", 4, columns=COLS, broadcast_bytes=0, leaf_rows=9))
    monkeypatch.setattr(knn, "HELD_BYTES", 0, raising=False)
    want = [[m().fit_transform(t).orderBy("id", *COLS).toPandas()[COLS].to_numpy(float) for m in makers] for t in (df, mixed)]
    monkeypatch.undo()
    monkeypatch.setattr(knn, "_indexed", None)
    for t, ws in zip((df, mixed), want):
        for make, w in zip(makers, ws):
            assert np.allclose(make().fit_transform(t).orderBy("id", *COLS).toPandas()[COLS].to_numpy(float), w, atol=1e-9, equal_nan=True)
