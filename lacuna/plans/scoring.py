"""Catalog: scoring and analysis of fills (Q06b, Q17-Q26)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lacuna.functions.hashing import full_hash_sql, missing_flag_sql
from lacuna.operators import evaluate as E
from lacuna.operators.group import GroupCenterImputer, PartialMeanImputer
from lacuna.operators.masks import inject_outliers
from lacuna.operators.simple import ConstantImputer, MeanImputer, MedianImputer, ModeImputer
from lacuna.plans.common import (DOC_COLS, DOC_FEATS, LINEITEM_ID, _mask, doc_masked, doc_masked_sql,
                                 masked, masked_sql)
from lacuna.plans.fills import LI_COLS, LI_MASKS, LI_NUM, ORD_COLS
from lacuna.plans.registry import query
from lacuna.plans.sqlgen import avg_rank_sql, cells_sql, numeric_scores_sql, pooled_scores_sql
from lacuna.session import checkpoint_dir, delete_on_exit
from lacuna.sources.tables import load

SCORE_COLS = ["method", "column_name", "n_scored", "n_unfilled", "mse", "rmse", "mae", "r2", "nrmse",
              "nmae", "bias"]


def _round_scores(df, mse_digits=4):
    r = {"mse": mse_digits, "rmse": 4, "mae": 4, "r2": 4, "nrmse": 6, "nmae": 6, "bias": 4}
    return df.select(*[F.round(c, r[c]).alias(c) if c in r else F.col(c) for c in SCORE_COLS])


def _round_scores_sql(inner: str, mse_digits=4) -> str:
    r = {"mse": mse_digits, "rmse": 4, "mae": 4, "r2": 4, "nrmse": 6, "nmae": 6, "bias": 4}
    # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's round does
    sel = ", ".join(f"round({c}, {r[c]}) + 0.0 AS {c}" if c in r else c for c in SCORE_COLS)
    return f"SELECT {sel} FROM ({inner}) s"


# ---- fills as SQL over a CTE `m` that carries c, c__truth, c__mask -----------------

def _pass(cols_all: list[str], targets: list[str]) -> list[str]:
    return [c for c in cols_all if c not in targets] + [f"{c}__truth" for c in targets] + \
           [f"{c}__mask" for c in targets]


def fill_sql(kind: str, cols_all: list[str], targets: list[str], key: str | None = None,
             src: str = "m") -> str:
    keep = ", ".join(f"{src}.{c}" for c in _pass(cols_all, targets))
    if kind in ("avg", "median"):
        s = ", ".join(f"{kind}({c}) AS s_{c}" for c in targets)
        if key is None:
            f = ", ".join(f"coalesce({src}.{c}, s.s_{c}) AS {c}" for c in targets)
            return f"SELECT {keep}, {f} FROM {src} CROSS JOIN (SELECT {s} FROM {src}) s"
        g = ", ".join(f"{kind}({c}) AS g_{c}" for c in targets)
        f = ", ".join(f"coalesce({src}.{c}, g.g_{c}, s.s_{c}) AS {c}" for c in targets)
        return (f"SELECT {keep}, {f} FROM {src} LEFT JOIN (SELECT {key}, {g} FROM {src} GROUP BY {key}) g "
                f"ON {src}.{key} IS NOT DISTINCT FROM g.{key} CROSS JOIN (SELECT {s} FROM {src}) s")
    if kind == "zero":
        f = ", ".join(f"coalesce({src}.{c}, 0.0) AS {c}" for c in targets)
        return f"SELECT {keep}, {f} FROM {src}"
    if kind == "quartile":
        parts = []
        for c in targets:
            parts.append(f"""coalesce({src}.{c}, (SELECT CASE WHEN count(CASE WHEN {c} > q1 AND {c} <= q3 THEN {c} END) >= 10
                   THEN avg(CASE WHEN {c} > q1 AND {c} <= q3 THEN {c} END) ELSE avg({c}) END
            FROM {src} x, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src}) q)) AS {c}""")
        return f"SELECT {keep}, {', '.join(parts)} FROM {src}"
    raise ValueError(kind)


# ---- documents: the feature matrix whose columns carry signal ----------------------

DOC_METHODS = ("mean", "median", "group_mean", "group_median", "zero", "quartile_partial_mean")


def _doc_models(m, names):
    makers = {
        "mean": lambda: MeanImputer(columns=DOC_FEATS),
        "median": lambda: MedianImputer(columns=DOC_FEATS),
        "group_mean": lambda: GroupCenterImputer("lang", columns=DOC_FEATS),
        "group_median": lambda: GroupCenterImputer("lang", strategy="median", columns=DOC_FEATS),
        "zero": lambda: ConstantImputer({c: 0.0 for c in DOC_FEATS}),
        "quartile_partial_mean": lambda: PartialMeanImputer(columns=DOC_FEATS),
    }
    return {n: makers[n]().fit(m) for n in names}


def doc_fills(spark, sf, names=DOC_METHODS, m=None):
    m = doc_masked(spark, sf) if m is None else m
    return {n: model.transform(m) for n, model in _doc_models(m, names).items()}


def doc_scored(spark, sf, names=DOC_METHODS):
    """All methods' fills of the document features, stacked from one scan."""
    m = doc_masked(spark, sf)
    return E.stack_models(m, _doc_models(m, names), DOC_FEATS)


def doc_fills_sql(names=DOC_METHODS) -> str:
    """CTE list: m (masked documents) and one CTE per method named f_<method>."""
    kinds = {"mean": ("avg", None), "median": ("median", None), "group_mean": ("avg", "lang"),
             "group_median": ("median", "lang"), "zero": ("zero", None),
             "quartile_partial_mean": ("quartile", None)}
    ctes = [f"m AS ({doc_masked_sql()})"]
    for n in names:
        k, key = kinds[n]
        ctes.append(f"f_{n} AS ({fill_sql(k, DOC_COLS, DOC_FEATS, key)})")
    return "WITH " + ",\n".join(ctes)


def _doc_cells(names=DOC_METHODS) -> str:
    return cells_sql({n: f"f_{n}" for n in names}, DOC_FEATS)


# ------------------------------------------------------------------ Q06b flagship scores
Q06_MASK = {"o_totalprice": (1, 250)}


def q06b(spark, sf):
    m = masked(spark, sf, "orders", "o_orderkey", Q06_MASK, truth=True)
    cols = ["o_totalprice"]
    res = {
        "group_mean": GroupCenterImputer("o_orderpriority", columns=cols).fit_transform(m),
        "mean": MeanImputer(columns=cols).fit_transform(m),
        "median": MedianImputer(columns=cols).fit_transform(m),
    }
    return _round_scores(E.numeric_scores(E.stack_methods(res, cols), cols), mse_digits=0)


def _q06b_sql():
    cols_all = ORD_COLS
    m = masked_sql("orders", ORD_COLS, "o_orderkey", Q06_MASK, truth=True)
    t = ["o_totalprice"]
    return f"""WITH m AS ({m}),
f_group_mean AS ({fill_sql('avg', cols_all, t, 'o_orderpriority')}),
f_mean AS ({fill_sql('avg', cols_all, t)}),
f_median AS ({fill_sql('median', cols_all, t)})
{_round_scores_sql(numeric_scores_sql(cells_sql({'group_mean': 'f_group_mean', 'mean': 'f_mean', 'median': 'f_median'}, t)), 0)}"""


query("q06b_group_mean_scores", _q06b_sql())(q06b)


# ------------------------------------------------------------------ Q17 numeric scores
LI_METHODS = {"mean": ("avg", None), "median": ("median", None), "group_mean": ("avg", "l_returnflag")}


def _li_scored(spark, sf):
    m = masked(spark, sf, "lineitem", LINEITEM_ID, LI_MASKS, truth=True)
    res = {
        "mean": MeanImputer(columns=LI_NUM).fit_transform(m),
        "median": MedianImputer(columns=LI_NUM).fit_transform(m),
        "group_mean": GroupCenterImputer("l_returnflag", columns=LI_NUM).fit_transform(m),
    }
    return E.stack_methods(res, LI_NUM)


def _li_ctes():
    ctes = [f"m AS ({masked_sql('lineitem', LI_COLS, LINEITEM_ID, LI_MASKS, truth=True)})"]
    for n, (k, key) in LI_METHODS.items():
        ctes.append(f"f_{n} AS ({fill_sql(k, LI_COLS, LI_NUM, key)})")
    return "WITH " + ",\n".join(ctes)


def q17(spark, sf):
    return _round_scores(E.numeric_scores(_li_scored(spark, sf), LI_NUM), mse_digits=0)


Q17_SQL = _li_ctes() + "\n" + _round_scores_sql(
    numeric_scores_sql(cells_sql({n: f"f_{n}" for n in LI_METHODS}, LI_NUM)), 0)
query("q17_numeric_scores", Q17_SQL)(q17)


def q17b(spark, sf):
    o = E.overall_scores(E.numeric_scores(_li_scored(spark, sf), LI_NUM))
    return o.select("method", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2_score", "mean_abs_bias")])


Q17B_SQL = _li_ctes() + f"""
SELECT method, round(avg(rmse), 4) AS rmse, round(avg(mae), 4) AS mae, round(avg(r2), 4) + 0.0 AS r2_score,
       round(avg(abs(bias)), 4) AS mean_abs_bias
FROM ({numeric_scores_sql(cells_sql({n: f"f_{n}" for n in LI_METHODS}, LI_NUM))}) s GROUP BY method"""
query("q17b_overall_scores", Q17B_SQL)(q17b)


# ------------------------------------------------------------------ Q18 categorical scores
Q18_MASKS = {"o_orderstatus": (2, 250), "o_orderpriority": (3, 250)}
Q18_COLS = ["o_orderstatus", "o_orderpriority"]


def _q18_scored(spark, sf):
    m = masked(spark, sf, "orders", "o_orderkey", Q18_MASKS, truth=True)
    res = {
        "mode": ModeImputer(columns=Q18_COLS).fit_transform(m),
        "group_mode": GroupCenterImputer("o_custkey", strategy="mode", columns=Q18_COLS).fit_transform(m),
        "unknown": ConstantImputer({c: "UNKNOWN" for c in Q18_COLS}).fit_transform(m),
    }
    return E.stack_methods(res, Q18_COLS)


def q18(spark, sf):
    s = E.categorical_scores(_q18_scored(spark, sf), Q18_COLS)
    return s.select("method", "column_name", "n_scored", F.round("accuracy", 6).alias("accuracy"),
                    F.round("js_divergence", 6).alias("js_divergence"))


def _q18_ctes(masks=None):
    src = "m"
    keep = ", ".join(_pass(ORD_COLS, Q18_COLS))
    modes = ", ".join(
        f"coalesce({c}, (SELECT {c} FROM m WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in Q18_COLS)
    gm = []
    for c in Q18_COLS:
        gm.append(f"""g_{c} AS (SELECT o_custkey, {c} AS g FROM (SELECT o_custkey, {c},
              row_number() OVER (PARTITION BY o_custkey ORDER BY cnt DESC, {c}) AS rn
              FROM (SELECT o_custkey, {c}, count(*) AS cnt FROM m WHERE {c} IS NOT NULL GROUP BY o_custkey, {c}) a) b
              WHERE rn = 1)""")
    gfill = ", ".join(
        f"coalesce(m.{c}, g_{c}.g, (SELECT {c} FROM m WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in Q18_COLS)
    gkeep = ", ".join(f"m.{c}" for c in _pass(ORD_COLS, Q18_COLS))
    gjoin = " ".join(f"LEFT JOIN g_{c} ON m.o_custkey IS NOT DISTINCT FROM g_{c}.o_custkey" for c in Q18_COLS)
    unk = ", ".join(f"coalesce({c}, 'UNKNOWN') AS {c}" for c in Q18_COLS)
    return (f"WITH m AS ({masked_sql('orders', ORD_COLS, 'o_orderkey', masks or Q18_MASKS, truth=True)}),\n"
            + ",\n".join(gm) + ",\n"
            f"f_mode AS (SELECT {keep}, {modes} FROM {src}),\n"
            f"f_group_mode AS (SELECT {gkeep}, {gfill} FROM m {gjoin}),\n"
            f"f_unknown AS (SELECT {keep}, {unk} FROM m),\n"
            "cells AS (" + " UNION ALL ".join(
                f"SELECT '{meth}' AS method, '{c}' AS column_name, {c} AS f, {c}__truth AS t FROM f_{meth} "
                f"WHERE {c}__mask AND {c}__truth IS NOT NULL"
                for meth in ("mode", "group_mode", "unknown") for c in Q18_COLS) + ")")


Q18_SQL = _q18_ctes() + """,
p AS (SELECT method, column_name, t AS v, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY method, column_name) AS p
      FROM cells GROUP BY method, column_name, t),
q AS (SELECT method, column_name, f AS v, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY method, column_name) AS q
      FROM cells WHERE f IS NOT NULL GROUP BY method, column_name, f),
pq AS (SELECT coalesce(p.method, q.method) AS method, coalesce(p.column_name, q.column_name) AS column_name,
              coalesce(p.p, 0.0) AS p, coalesce(q.q, 0.0) AS q
       FROM p FULL OUTER JOIN q ON p.method = q.method AND p.column_name = q.column_name AND p.v = q.v),
js AS (SELECT method, column_name,
              (sum((p + 1e-10) * ln((p + 1e-10) / ((p + q) / 2 + 1e-10)))
             + sum((q + 1e-10) * ln((q + 1e-10) / ((p + q) / 2 + 1e-10)))) / 2 AS js_divergence
       FROM pq GROUP BY method, column_name),
acc AS (SELECT method, column_name, count(*) AS n_scored,
               avg(CASE WHEN f = t THEN 1.0 ELSE 0.0 END) AS accuracy FROM cells GROUP BY method, column_name)
SELECT acc.method, acc.column_name, acc.n_scored, round(acc.accuracy, 6) AS accuracy,
       round(js.js_divergence, 6) AS js_divergence
FROM acc LEFT JOIN js ON acc.method = js.method AND acc.column_name = js.column_name"""
query("q18_categorical_scores", Q18_SQL)(q18)


def q18b(spark, sf):
    s = E.categorical_scores(_q18_scored(spark, sf), Q18_COLS)
    return s.groupBy("method").agg(F.round(F.avg("accuracy"), 6).alias("overall_accuracy"))


Q18B_SQL = _q18_ctes() + """
SELECT method, round(avg(accuracy), 6) AS overall_accuracy FROM (
  SELECT method, column_name, avg(CASE WHEN f = t THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM cells GROUP BY method, column_name) a GROUP BY method"""
query("q18b_overall_categorical_accuracy", Q18B_SQL)(q18b)


# ------------------------------------------------------------------ Q19 pooled + short scores
Q19_METHODS = ("mean", "median", "group_mean")


def q19(spark, sf):
    p = E.pooled_scores(doc_scored(spark, sf, Q19_METHODS), DOC_FEATS)
    return p.select("method", "n_scored", *[F.round(c, 4).alias(c) for c in
                                            ("rmse", "mae", "r2_score", "mean_abs_bias")])


Q19_SQL = doc_fills_sql(Q19_METHODS) + f"""
SELECT method, n_scored, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2_score, 4) AS r2_score,
       round(mean_abs_bias, 4) AS mean_abs_bias
FROM ({pooled_scores_sql(_doc_cells(Q19_METHODS))}) s"""
query("q19_pooled_scores", Q19_SQL)(q19)


def q19b(spark, sf):
    per_col = E.numeric_scores(doc_scored(spark, sf, Q19_METHODS), DOC_FEATS)
    o = E.overall_scores(per_col)
    return o.select("method", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2_score")],
                    F.lit(None).cast("double").alias("categorical_accuracy"),
                    F.round("mean_abs_bias", 4).alias("mean_abs_bias"))


Q19B_SQL = doc_fills_sql(Q19_METHODS) + f"""
SELECT method, round(avg(rmse), 4) AS rmse, round(avg(mae), 4) AS mae, round(avg(r2), 4) AS r2_score,
       CAST(NULL AS DOUBLE) AS categorical_accuracy, round(avg(abs(bias)), 4) AS mean_abs_bias
FROM ({numeric_scores_sql(_doc_cells(Q19_METHODS))}) s GROUP BY method"""
query("q19b_short_scores", Q19B_SQL)(q19b)


# numeric and text columns of one table together
Q19C_MASKS = {**Q18_MASKS, "o_totalprice": (1, 250)}


def _mixed_short(spark, sf):
    m = masked(spark, sf, "orders", "o_orderkey", Q19C_MASKS, truth=True)
    num = ["o_totalprice"]
    fills = {
        "overall": (MeanImputer(columns=num).fit_transform(m), ModeImputer(columns=Q18_COLS).fit_transform(m)),
        "group": (GroupCenterImputer("o_custkey", columns=num).fit_transform(m),
                  GroupCenterImputer("o_custkey", strategy="mode", columns=Q18_COLS).fit_transform(m)),
    }
    n = E.numeric_scores(E.stack_methods({k: v[0] for k, v in fills.items()}, num), num)
    c = E.categorical_scores(E.stack_methods({k: v[1] for k, v in fills.items()}, Q18_COLS), Q18_COLS)
    return E.short_scores(n, c)


def q19c(spark, sf):
    return _mixed_short(spark, sf).select("method", *[F.round(c, 4).alias(c) for c in (
        "rmse", "mae", "r2_score", "categorical_accuracy", "mean_abs_bias")])


def _mixed_short_sql() -> str:
    num = ("SELECT 'overall' AS method, 'o_totalprice' AS column_name, coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM m)) AS f, "
           "o_totalprice__truth AS t, o_totalprice__mask AS m FROM m UNION ALL "
           "SELECT 'group', 'o_totalprice', coalesce(m.o_totalprice, g.g, (SELECT avg(o_totalprice) FROM m)), o_totalprice__truth, o_totalprice__mask "
           "FROM m LEFT JOIN (SELECT o_custkey, avg(o_totalprice) AS g FROM m GROUP BY o_custkey) g ON m.o_custkey = g.o_custkey")
    return _q18_ctes(Q19C_MASKS) + f""",
ns AS (SELECT method, avg(rmse) AS rmse, avg(mae) AS mae, avg(r2) AS r2_score, avg(abs(bias)) AS mean_abs_bias
       FROM ({numeric_scores_sql(num)}) x GROUP BY method),
cs AS (SELECT CASE WHEN method = 'mode' THEN 'overall' ELSE 'group' END AS method, avg(accuracy) AS categorical_accuracy
       FROM (SELECT method, column_name, avg(CASE WHEN f = t THEN 1.0 ELSE 0.0 END) AS accuracy FROM cells
             WHERE method <> 'unknown' GROUP BY method, column_name) y GROUP BY 1),
s AS (SELECT * FROM ns JOIN cs USING (method))"""


query("q19c_short_scores_numeric_and_text", _mixed_short_sql() + """
SELECT method, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2_score, 4) AS r2_score,
       round(categorical_accuracy, 4) AS categorical_accuracy, round(mean_abs_bias, 4) AS mean_abs_bias FROM s""")(q19c)


def q21c(spark, sf):
    """Best method per metric, text columns included."""
    b = E.best_methods(_mixed_short(spark, sf))
    return b.select("metric", "best_method", F.round("best_value", 4).alias("best_value"))


query("q21c_best_methods_numeric_and_text", _mixed_short_sql() + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, (SELECT method FROM s ORDER BY {c} {o}, method LIMIT 1) AS best_method, "
    f"round((SELECT {'min' if o == 'ASC' else 'max'}({c}) FROM s), 4) AS best_value"
    for c, o in (("rmse", "ASC"), ("mae", "ASC"), ("r2_score", "DESC"), ("categorical_accuracy", "DESC"))))(q21c)


# ------------------------------------------------------------------ Q17c scores of separate frames
FRAME_METHODS = ("mean", "median", "group_mean")


def q17c(spark, sf):
    """Scores from separate Parquet folders of truth, mask and fills, paired by id."""
    from lacuna.operators.align import FrameScores
    base = delete_on_exit(spark, f"{checkpoint_dir(spark).rstrip('/')}/lacuna-frames/q17c-{uuid.uuid4().hex}")
    m = doc_masked(spark, sf)
    m.select("doc_id", *[F.col(f"{c}__truth").alias(c) for c in DOC_FEATS]).write.parquet(f"{base}/truth")
    m.select("doc_id", *[F.col(f"{c}__mask").alias(c) for c in DOC_FEATS]).write.parquet(f"{base}/mask")
    frames = FrameScores(spark.read.parquet(f"{base}/truth"), spark.read.parquet(f"{base}/mask"), "doc_id", DOC_FEATS)
    for name, fill in doc_fills(spark, sf, FRAME_METHODS, m).items():
        fill.select("doc_id", *DOC_FEATS).write.parquet(f"{base}/{name}")
        frames.add(name, spark.read.parquet(f"{base}/{name}"))
    return _round_scores(E.numeric_scores(frames.scored(), DOC_FEATS), mse_digits=0)


Q17C_SQL = doc_fills_sql(FRAME_METHODS) + "\n" + _round_scores_sql(numeric_scores_sql(_doc_cells(FRAME_METHODS)), 0)
query("q17c_aligned_frames", Q17C_SQL)(q17c)


# ------------------------------------------------------------------ Q20 compare and rank
def _pooled_all(spark, sf):
    return E.pooled_scores(doc_scored(spark, sf), DOC_FEATS)


def q20(spark, sf):
    r = E.rank_methods(_pooled_all(spark, sf))
    return r.select("method", "rmse", "mae", "r2_score", "mean_abs_bias", "rmse_rank", "mae_rank",
                    "r2_rank", "bias_rank", F.round("overall_rank", 4).alias("overall_rank"))


Q20_SQL = doc_fills_sql() + f""",
s AS (SELECT method, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2_score, 4) AS r2_score,
             round(mean_abs_bias, 4) AS mean_abs_bias FROM ({pooled_scores_sql(_doc_cells())}) x),
r AS (SELECT method, rmse, mae, r2_score, mean_abs_bias,
             {avg_rank_sql('rmse')} AS rmse_rank, {avg_rank_sql('mae')} AS mae_rank,
             {avg_rank_sql('r2_score', True)} AS r2_rank, {avg_rank_sql('mean_abs_bias')} AS bias_rank FROM s)
SELECT *, round((rmse_rank + mae_rank + r2_rank + bias_rank) / 4.0, 4) AS overall_rank FROM r"""
query("q20_compare_and_rank", Q20_SQL)(q20)


WIDE = ("rmse", "mae", "r2", "bias")


def q20b(spark, sf):
    """One row per method, the scores of every column beside each other."""
    w = E.wide_scores(E.numeric_scores(doc_scored(spark, sf), DOC_FEATS), DOC_FEATS, WIDE)
    return w.select("method", *[F.round(f"{c}_{m}", 4).alias(f"{c}_{m}") for c in DOC_FEATS for m in WIDE])


Q20B_SQL = doc_fills_sql() + f""",
s AS ({numeric_scores_sql(_doc_cells())})
SELECT method, """ + ", ".join(f"round(max(CASE WHEN column_name = '{c}' THEN {m} END), 4) + 0.0 AS {c}_{m}" for c in DOC_FEATS for m in WIDE) + """
FROM s GROUP BY method"""
query("q20b_compare_wide", Q20B_SQL)(q20b)


# ------------------------------------------------------------------ Q21 best methods, improvement
def q21(spark, sf):
    b = E.best_methods(_pooled_all(spark, sf))
    return b.select("metric", "best_method", F.round("best_value", 4).alias("best_value"))


Q21_SQL = doc_fills_sql() + f""",
s AS ({pooled_scores_sql(_doc_cells())})
SELECT 'rmse' AS metric, (SELECT method FROM s ORDER BY rmse, method LIMIT 1) AS best_method,
       round((SELECT min(rmse) FROM s), 4) AS best_value
UNION ALL SELECT 'mae', (SELECT method FROM s ORDER BY mae, method LIMIT 1), round((SELECT min(mae) FROM s), 4)
UNION ALL SELECT 'r2_score', (SELECT method FROM s ORDER BY r2_score DESC, method LIMIT 1),
       round((SELECT max(r2_score) FROM s), 4)"""
query("q21_best_methods", Q21_SQL)(q21)


def q21b(spark, sf):
    i = E.improvement_over(_pooled_all(spark, sf), "mean")
    return i.select("method", F.round("rmse", 4).alias("rmse"), F.round("improvement_pct", 4).alias("improvement_pct"))


Q21B_SQL = doc_fills_sql() + f""",
s AS ({pooled_scores_sql(_doc_cells())})
SELECT method, round(rmse, 4) AS rmse,
       round(((SELECT rmse FROM s WHERE method = 'mean') - rmse) / (SELECT rmse FROM s WHERE method = 'mean') * 100, 4)
         AS improvement_pct
FROM s"""
query("q21b_improvement_over_mean", Q21B_SQL)(q21b)


# ------------------------------------------------------------------ Q22-Q24 documents analyses
from lacuna.operators import analysis as A  # noqa: E402

Q22_METHODS = ("mean", "median")


def _doc_views(spark, sf, names=Q22_METHODS, extra=()):
    """truth / observed / filled views of the document features, stacked by method."""
    m = doc_masked(spark, sf)
    parts = {"truth": m.select(*[F.col(c + "__truth").alias(c) for c in DOC_FEATS], "lang"),
             "observed": m.select(*DOC_FEATS, "lang")}
    fills = doc_fills(spark, sf, names, m=m)
    for n, d in fills.items():
        parts[n] = d.select(*DOC_FEATS, "lang")
    return A.stack(parts)


def _doc_views_sql(names=Q22_METHODS) -> str:
    sel = ", ".join(DOC_FEATS)
    parts = [f"SELECT 'truth' AS method, {', '.join(f'{c}__truth AS {c}' for c in DOC_FEATS)}, lang FROM m",
             f"SELECT 'observed' AS method, {sel}, lang FROM m"]
    parts += [f"SELECT '{n}' AS method, {sel}, lang FROM f_{n}" for n in names]
    return doc_fills_sql(names) + ",\nviews AS (" + " UNION ALL ".join(parts) + ")"


def q22(spark, sf):
    mt = A.moment_table(A.long_values(_doc_views(spark, sf), DOC_FEATS))
    tv = mt.where(F.col("method") == "truth").select("column_name", F.col("variance").alias("tvar"))
    out = mt.join(F.broadcast(tv), "column_name")
    return out.select("method", "column_name", "n", F.round("mean", 4).alias("mean"),
                      F.round("median", 4).alias("median"), F.round("variance", 2).alias("variance"),
                      F.round("skewness", 4).alias("skewness"), F.round("kurtosis", 4).alias("kurtosis"),
                      F.round((F.col("tvar") - F.col("variance")) / F.col("tvar") * 100, 4).alias("var_change_pct"))


Q22_SQL = _doc_views_sql() + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT method, '{c}' AS column_name, {c} AS v FROM views" for c in DOC_FEATS) + """),
mom AS (SELECT l.method, l.column_name, count(v) AS n, avg(v) AS mean, median(v) AS median, var_samp(v) AS variance,
               avg(power(v - mu, 3)) / power(avg(power(v - mu, 2)), 1.5) AS skewness,
               avg(power(v - mu, 4)) / power(avg(power(v - mu, 2)), 2) - 3 AS kurtosis
        FROM long l JOIN (SELECT method, column_name, avg(v) AS mu FROM long GROUP BY 1, 2) a
          ON l.method = a.method AND l.column_name = a.column_name
        WHERE v IS NOT NULL GROUP BY l.method, l.column_name)
SELECT m.method, m.column_name, m.n, round(m.mean, 4) AS mean, round(m.median, 4) AS median,
       round(m.variance, 2) AS variance, round(m.skewness, 4) + 0.0 AS skewness, round(m.kurtosis, 4) + 0.0 AS kurtosis,
       round((t.variance - m.variance) / t.variance * 100, 4) + 0.0 AS var_change_pct
FROM mom m JOIN mom t ON t.method = 'truth' AND t.column_name = m.column_name"""
query("q22_moment_preservation", Q22_SQL)(q22)


def q23(spark, sf):
    ps = A.pair_stats(_doc_views(spark, sf), DOC_FEATS)
    return ps.select("method", "col_a", "col_b", F.round("corr", 6).alias("corr"),
                     F.round("covariance", 2).alias("covariance"))


def q23b(spark, sf):
    """The pairs from matrix products, as for wide tables."""
    ps = A.pair_stats(_doc_views(spark, sf), DOC_FEATS, gram_columns=1)
    return ps.select("method", "col_a", "col_b", (F.round("corr", 6) + 0.0).alias("corr"),
                     (F.round("covariance", 2) + 0.0).alias("covariance"))


def _pairs():
    from itertools import combinations
    return list(combinations(DOC_FEATS, 2))


Q23_SQL = _doc_views_sql() + "\n" + " UNION ALL ".join(
    f"SELECT method, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0.0 AS corr, "
    f"round(covar_samp({a}, {b}), 2) + 0.0 AS covariance FROM views GROUP BY method" for a, b in _pairs())
query("q23_correlation_covariance", Q23_SQL)(q23)
query("q23b_correlation_covariance_gram", Q23_SQL)(q23b)

Q24_METHODS = ("group_mean", "mean")


def q24(spark, sf):
    v = _doc_views(spark, sf, Q24_METHODS).where(F.col("method") != "observed")
    return A.between_group_variance(v, "lang", "n_words").select(
        "method", F.round("between_var", 4).alias("between_var"))


Q24_SQL = _doc_views_sql(Q24_METHODS) + """
SELECT method, round(var_pop(gm), 4) AS between_var
FROM (SELECT method, lang, avg(n_words) AS gm FROM views WHERE method <> 'observed' GROUP BY method, lang) g
GROUP BY method"""
query("q24_group_difference", Q24_SQL)(q24)


def q24b(spark, sf):
    v = _doc_views(spark, sf, Q24_METHODS)
    return A.group_table(v, "lang", "n_words").select(
        "method", "lang", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


Q24B_SQL = _doc_views_sql(Q24_METHODS) + """
SELECT method, lang, count(n_words) AS n, round(avg(n_words), 4) AS mean, round(stddev_samp(n_words), 4) AS std
FROM views GROUP BY method, lang"""
query("q24b_group_table", Q24B_SQL)(q24b)


# ------------------------------------------------------------------ Q25 outliers
def q25(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    o = inject_outliers(o, "o_orderkey", "o_totalprice", 20, 10.0, salt=97)
    m = _mask(o.withColumn("__id", F.col("o_orderkey")), {"o_totalprice": (1, 250)}, truth=True)
    cols = ["o_totalprice"]
    mean_m = MeanImputer(columns=cols).fit(m)
    med_m = MedianImputer(columns=cols).fit(m)
    res = {"mean": mean_m.transform(m), "median": med_m.transform(m)}
    sc = E.numeric_scores(E.stack_methods(res, cols), cols)
    fv = spark.createDataFrame([("mean", float(mean_m.statistics_["o_totalprice"])),
                                ("median", float(med_m.statistics_["o_totalprice"]))],
                               "method string, fill_value double")
    return sc.join(fv, "method").select("method", F.round("fill_value", 4).alias("fill_value"),
                                        F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"))


Q25_SQL = f"""
WITH mx AS (SELECT max(o_totalprice) AS mx FROM orders),
pick AS (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (
           ORDER BY {full_hash_sql('o_orderkey', 97)}, o_orderkey) AS rn FROM orders) t WHERE rn <= 20),
o AS (SELECT o.o_orderkey, CASE WHEN pick.o_orderkey IS NOT NULL THEN 10.0 * mx.mx ELSE o.o_totalprice END AS t
      FROM orders o LEFT JOIN pick ON o.o_orderkey = pick.o_orderkey CROSS JOIN mx),
m AS (SELECT o_orderkey, t, CASE WHEN {missing_flag_sql('o_orderkey', 1, 250)} THEN NULL ELSE t END AS v FROM o),
s AS (SELECT 'mean' AS method, avg(v) AS fv FROM m UNION ALL SELECT 'median', median(v) FROM m)
SELECT s.method, round(s.fv, 4) AS fill_value, round(sqrt(avg((s.fv - m.t) * (s.fv - m.t))), 4) AS rmse,
       round(avg(abs(s.fv - m.t)), 4) AS mae
FROM m CROSS JOIN s WHERE m.v IS NULL GROUP BY s.method, s.fv"""
query("q25_outlier_robustness", Q25_SQL)(q25)


# ------------------------------------------------------------------ Q26 distributions and errors
Q26_COL = "l_extendedprice"
Q26_METHODS = ("mean", "median")


def _q26_scored(spark, sf):
    m = masked(spark, sf, "lineitem", LINEITEM_ID, LI_MASKS, truth=True)
    cols = [Q26_COL]
    return m, {"mean": MeanImputer(columns=cols).fit_transform(m),
               "median": MedianImputer(columns=cols).fit_transform(m)}


def _q26_ctes():
    ctes = [f"m AS ({masked_sql('lineitem', LI_COLS, LINEITEM_ID, LI_MASKS, truth=True)})"]
    for n in Q26_METHODS:
        ctes.append(f"f_{n} AS ({fill_sql('avg' if n == 'mean' else 'median', LI_COLS, [Q26_COL])})")
    ctes.append("held AS (" + " UNION ALL ".join(
        f"SELECT '{n}' AS method, l_orderkey, l_partkey, l_suppkey, l_linenumber, {Q26_COL}__truth AS t, "
        f"{Q26_COL} AS f FROM f_{n} WHERE {Q26_COL}__mask" for n in Q26_METHODS) + ")")
    return "WITH " + ",\n".join(ctes)


def q26(spark, sf):
    m, res = _q26_scored(spark, sf)
    lo, hi = m.agg(F.min(Q26_COL + "__truth"), F.max(Q26_COL + "__truth")).first()
    parts = []
    for n, d in res.items():
        h = d.where(F.col(Q26_COL + "__mask"))
        parts.append(h.select(F.lit(n).alias("method"), F.lit("truth").alias("series"),
                              F.col(Q26_COL + "__truth").alias("v")))
        parts.append(h.select(F.lit(n).alias("method"), F.lit("fill").alias("series"), F.col(Q26_COL).alias("v")))
    from functools import reduce
    long = reduce(lambda a, b: a.unionByName(b), parts)
    return A.histogram(long, lo, hi, 20)


Q26_SQL = _q26_ctes() + """,
r AS (SELECT min(l_extendedprice__truth) AS lo, max(l_extendedprice__truth) AS hi FROM m),
long AS (SELECT method, 'truth' AS series, t AS v FROM held UNION ALL SELECT method, 'fill', f FROM held)
SELECT method, series, CAST(least(floor((v - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, count(*) AS n
FROM long CROSS JOIN r WHERE v IS NOT NULL GROUP BY 1, 2, 3"""
query("q26_distribution_histogram", Q26_SQL)(q26)


def q26b(spark, sf):
    _, res = _q26_scored(spark, sf)
    from functools import reduce
    long = reduce(lambda a, b: a.unionByName(b), [
        d.where(F.col(Q26_COL + "__mask")).select(
            F.lit(n).alias("method"), F.abs(F.col(Q26_COL) - F.col(Q26_COL + "__truth")).alias("v"))
        for n, d in res.items()])
    q = A.grouped_quantiles(long, ["method"], "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["p0", "p25", "p50", "p75", "p100"]
    return q.select("method", *[F.round(f"q{i}", 4).alias(n) for i, n in enumerate(names)])


Q26B_SQL = _q26_ctes() + """
SELECT method, round(quantile_cont(abs(f - t), 0.0), 4) AS p0, round(quantile_cont(abs(f - t), 0.25), 4) AS p25,
       round(quantile_cont(abs(f - t), 0.5), 4) AS p50, round(quantile_cont(abs(f - t), 0.75), 4) AS p75,
       round(quantile_cont(abs(f - t), 1.0), 4) AS p100
FROM held GROUP BY method"""
query("q26b_error_spread", Q26B_SQL)(q26b)


def q26c(spark, sf):
    _, res = _q26_scored(spark, sf)
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), [
        d.where(F.col(Q26_COL + "__mask")).select(
            F.lit(n).alias("method"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.round(F.col(Q26_COL + "__truth"), 4).alias("truth"), F.round(Q26_COL, 4).alias("fill"))
        for n, d in res.items()])


Q26C_SQL = _q26_ctes() + """
SELECT method, l_orderkey, l_partkey, l_suppkey, l_linenumber, round(t, 4) AS truth, round(f, 4) AS fill FROM held"""
query("q26c_true_vs_imputed", Q26C_SQL)(q26c)


def q26d(spark, sf):
    m = doc_masked(spark, sf)
    fills = doc_fills(spark, sf, ("mean", "group_mean"), m=m)
    first = m.where(F.col("n_words__mask")).agg(F.min("doc_id")).first()[0]
    a = fills["mean"].where(F.col("doc_id") == first).select("doc_id", F.col("n_words__truth").alias("truth"),
                                                             F.col("n_words").alias("mean_fill"))
    b = fills["group_mean"].where(F.col("doc_id") == first).select("doc_id", F.col("n_words").alias("group_fill"))
    j = a.join(b, "doc_id")
    return j.select("doc_id", F.round("truth", 4).alias("truth"), F.round("mean_fill", 4).alias("mean_fill"),
                    F.round("group_fill", 4).alias("group_fill"),
                    F.round(F.abs(F.col("mean_fill") - F.col("truth")), 4).alias("abs_err_mean"),
                    F.round(F.abs(F.col("group_fill") - F.col("truth")), 4).alias("abs_err_group"))


Q26D_SQL = doc_fills_sql(("mean", "group_mean")) + """,
first AS (SELECT min(doc_id) AS d FROM m WHERE n_words__mask)
SELECT a.doc_id, round(a.n_words__truth, 4) AS truth, round(a.n_words, 4) AS mean_fill, round(b.n_words, 4) AS group_fill,
       round(abs(a.n_words - a.n_words__truth), 4) AS abs_err_mean, round(abs(b.n_words - a.n_words__truth), 4) AS abs_err_group
FROM f_mean a JOIN f_group_mean b ON a.doc_id = b.doc_id JOIN first ON a.doc_id = first.d"""
query("q26d_cell_audit", Q26D_SQL)(q26d)
