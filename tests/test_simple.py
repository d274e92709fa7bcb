"""Single-value fills on a small table, plus invariants."""

import math

import pytest
from pyspark.sql import functions as F

from lacuna.operators.simple import ConstantImputer, MeanImputer, MedianImputer, ModeImputer


def _col(df, c):
    return [r[0] for r in df.orderBy("id").select(c).collect()]


def test_default_value(f1):
    out = ConstantImputer(0, numeric_only=True, exclude=["id"]).fit_transform(f1)
    assert _col(out, "x") == [4.0, 0.0, 7.0, 1.0, 6.0, 0.0, 2.0]
    assert _col(out, "y")[2] == 0.0 and _col(out, "colour")[3] is None


def test_constant_dict_keeps_types(f1):
    out = ConstantImputer({"x": -1.0, "colour": "none"}).fit_transform(f1)
    assert _col(out, "colour")[3] == "none"
    assert _col(out, "x")[5] == -1.0
    assert _col(out, "y")[5] is None  # not in the dict: untouched
    assert out.schema["colour"].dataType.simpleString() == "string"


def test_mean(f1):
    out = MeanImputer(exclude=["id"]).fit_transform(f1)
    assert _col(out, "x") == [4.0, 4.0, 7.0, 1.0, 6.0, 4.0, 2.0]
    assert _col(out, "y") == [1.5, 2.5, 4.0, 8.0, 3.0, 4.0, 5.0]


def test_median(f1):
    out = MedianImputer(exclude=["id"]).fit_transform(f1)
    assert _col(out, "x")[1] == 4.0
    assert _col(out, "y")[2] == 3.0


def test_mode_smallest_on_tie(f1):
    out = ModeImputer(columns=["colour", "shape"]).fit_transform(f1)
    assert _col(out, "colour")[3] == "red"
    assert _col(out, "shape")[1] == "cube"  # as often as disc, and smaller


def test_workflow_mean_then_mode(f1):
    out = ModeImputer(columns=["colour", "shape"]).fit_transform(
        MeanImputer(exclude=["id"]).fit_transform(f1))
    nulls = out.select(*[F.sum(F.col(c).isNull().cast("int")) for c in out.columns]).first()
    assert sum(nulls) == 0


def test_fit_then_transform_equals_fit_transform(f1):
    m = MeanImputer(exclude=["id"]).fit(f1)
    a = m.transform(f1).orderBy("id").collect()
    b = MeanImputer(exclude=["id"]).fit_transform(f1).orderBy("id").collect()
    assert a == b


def test_observed_cells_unchanged_and_order_kept(f1):
    out = MeanImputer(exclude=["id"]).fit_transform(f1)
    assert out.columns == f1.columns
    for a, b in zip(_col(f1, "x"), _col(out, "x")):
        if a is not None:
            assert a == b


def test_nan_and_null_are_the_same(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, None), (3, 10.0)], "id long, x double")
    b = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, float("nan")), (3, 10.0)], "id long, x double")
    for imp in (MeanImputer(exclude=["id"]), MedianImputer(exclude=["id"])):
        va = _col(imp.fit_transform(a), "x")
        vb = _col(imp.fit_transform(b), "x")
        assert va == vb and not any(math.isnan(v) for v in vb)


def test_all_missing_column_rules(spark):
    df = spark.createDataFrame([(0, None, None), (1, None, None)], "id long, x double, s string")
    assert _col(MeanImputer(exclude=["id"]).fit_transform(df), "x") == [0.0, 0.0]
    assert _col(MedianImputer(exclude=["id"]).fit_transform(df), "x") == [0.0, 0.0]
    assert _col(ModeImputer(columns=["s"]).fit_transform(df), "s") == [None, None]


def test_mean_fill_keeps_observed_mean(f1):
    out = MeanImputer(exclude=["id"]).fit_transform(f1)
    assert out.agg(F.avg("y")).first()[0] == pytest.approx(4.0)


def test_empty_input_rejected(spark):
    df = spark.createDataFrame([], "id long, x double")
    with pytest.raises(ValueError):
        MeanImputer().fit(df)


def test_model_json_roundtrip(f1, tmp_path):
    from lacuna.operators.base import load_model
    m = MeanImputer(exclude=["id"]).fit(f1)
    m.save(str(tmp_path / "mean"))
    back = load_model(str(tmp_path / "mean"))
    assert back.transform(f1).orderBy("id").collect() == m.transform(f1).orderBy("id").collect()


def test_every_model_saves_and_loads(spark, f1, tmp_path):
    from lacuna.operators.base import load_model
    from lacuna.operators.gaussian import EMImputer, IterativeImputer
    from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
    from lacuna.operators.knn import EnhancedKNNImputer, KNNImputer, SimilarityPartialMeanImputer
    from lacuna.operators.lowrank import SVDImputer
    from lacuna.operators.mixture import GaussianMixtureImputer
    from lacuna.operators.ordered import ForwardBackwardFillImputer
    xy = ["x", "y"]
    makers = [ConstantImputer({"x": 1.0}), MeanImputer(columns=xy), MedianImputer(columns=xy), ModeImputer(columns=["shape", "x"]),
              GroupCenterImputer("colour", columns=xy), GroupCenterImputer("colour", "mode", columns=["shape"]),
              PartialMeanImputer({"warm": {"colour": ["red"]}}, min_subset_size=1, columns=xy), PartialMeanImputer(columns=xy),
              KNNImputer("id", 2, columns=xy, features=xy), EnhancedKNNImputer("id", 2, columns=xy),
              SimilarityPartialMeanImputer("id", columns=xy), EMImputer(columns=xy), IterativeImputer(columns=xy),
              SVDImputer(1, columns=xy), GaussianMixtureImputer(1, columns=xy), ForwardBackwardFillImputer("ffill", "id", columns=["colour"])]
    for i, m in enumerate(makers):
        model = m.fit(f1)
        model.save(str(tmp_path / str(i)))
        back = load_model(str(tmp_path / str(i)))
        assert type(back) is type(model)
        assert back.transform(f1).orderBy("id").collect() == model.transform(f1).orderBy("id").collect(), type(model)
    with pytest.raises(TypeError):
        PartialMeanImputer({"f": lambda d: d["x"] > 1}, min_subset_size=1, columns=xy).fit(f1).save(str(tmp_path / "f"))


def test_mode_of_typed_columns_one_job(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 2, 3, 4, 5, 678000), dt.datetime(2023, 5, 6)
    rows = [(0, 10, True, t1, 2.5), (1, 9, True, t1, 2.5), (2, 10, False, t2, None), (3, 9, None, t2, 1.25),
            (4, None, False, None, 1.25)]
    df = spark.createDataFrame(rows, "id long, n int, b boolean, t timestamp, x double")
    out = ModeImputer(columns=["n", "b", "t", "x"]).fit_transform(df).orderBy("id").collect()
    # ties go to the smallest value in each column's own order (9 < 10, False < True, t2 < t1, 1.25 < 2.5)
    assert out[4]["n"] == 9 and out[3]["b"] is False and out[4]["t"] == t2 and out[2]["x"] == 1.25
    assert [f.dataType.simpleString() for f in ModeImputer(columns=["n"]).fit_transform(df).schema.fields][1] == "int"


def test_option_checks():
    from lacuna.operators.gaussian import EMImputer
    from lacuna.operators.knn import EnhancedKNNImputer, KNNImputer, SimilarityPartialMeanImputer
    from lacuna.operators.mixture import GaussianMixtureImputer
    from lacuna.operators.multiple import pool
    from lacuna.operators.ordered import ForwardBackwardFillImputer, InterpolationImputer
    with pytest.raises(ValueError):
        KNNImputer("id", weights="cosine")
    with pytest.raises(ValueError):
        KNNImputer("id", n_neighbors=0)
    with pytest.raises(ValueError):
        EnhancedKNNImputer("id", weights="x")
    with pytest.raises(ValueError):
        SimilarityPartialMeanImputer("id", subset_size=0)
    with pytest.raises(ValueError):
        GaussianMixtureImputer(0)
    with pytest.raises(ValueError):
        EMImputer(init="random")
    with pytest.raises(ValueError):
        ForwardBackwardFillImputer("pad", ["t"])
    with pytest.raises(ValueError):
        InterpolationImputer("quadratic", ["t"])
    with pytest.raises(ValueError):
        pool(None, "id", [], how="mode")


def test_missing_summary_and_totals(f1):
    from lacuna.operators.profile import missing_summary, missing_totals
    rows = {r["column_name"]: r for r in missing_summary(f1).collect()}
    assert rows["x"]["n_missing"] == 2 and rows["id"]["n_missing"] == 0
    assert rows["x"]["pct_missing"] == pytest.approx(200 / 7)
    assert rows["id"]["rank_pos"] == 5  # 0% sorts last; ties by name
    filled = ModeImputer(columns=["colour", "shape"]).fit_transform(
        MeanImputer(exclude=["id"]).fit_transform(f1))
    t = missing_totals(f1, filled).first()
    assert (t["n_cells"], t["missing_before"], t["missing_after"]) == (35, 7, 0)
