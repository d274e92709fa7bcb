"""Catalog: model-based fills on the document features (Q36-Q44)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.functions.hashing import full_hash_sql, gaussian_noise_sql, missing_flag, missing_flag_sql
from lacuna.operators.gaussian import EMImputer, IterativeImputer
from lacuna.operators.lowrank import SVDImputer
from lacuna.operators.mixture import GaussianMixtureImputer, select_components
from lacuna.operators import multiple as MI
from lacuna.operators.simple import MeanImputer
from lacuna.plans.common import DOC_FEATS, doc_masked, doc_masked_sql
from lacuna.plans.registry import query
from lacuna.sources.tables import load


def _docs(spark, sf):
    return doc_masked(spark, sf, truth=False).select("doc_id", "lang", *DOC_FEATS)


def _out(df):
    return df.select("doc_id", *[F.round(c, 4).alias(c) for c in DOC_FEATS])


# ------------------------------------------------------------------ Q36-Q38: low rank, iterative
def q36(spark, sf):
    return _out(SVDImputer(2, tol=1e-4, columns=DOC_FEATS).fit_transform(_docs(spark, sf)))


query("q36_svd_fill")(q36)


def q37(spark, sf):
    return _out(SVDImputer(None, tol=1e-6, center=True, scale=False, columns=DOC_FEATS).fit_transform(_docs(spark, sf)))


query("q37_svd_centered_fill")(q37)

def _embeddings(spark, sf):
    """The embedding as columns, as many as the longest has, with holes in four of them."""
    e = load(spark, sf, "embeddings")
    dims = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    cols = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(dims)]
    df = e.select("vec_id", *cols)
    # holes in four of the dimensions (portable hash), the rest complete
    sel = [F.when(missing_flag("vec_id", 60 + i, 200), F.lit(None).cast("double")).otherwise(F.col(f"e{i}")).alias(f"e{i}")
           if i < 4 else F.col(f"e{i}") for i in range(dims)]
    return df.select("vec_id", *sel)


def q37b(spark, sf):
    df = _embeddings(spark, sf)
    m = SVDImputer(None, tol=1e-6, center=True, scale=False, columns=df.columns[1:]).fit(df)
    ev = m.explained_variance(spark)
    return ev.select("component", F.round("singular_value", 6).alias("singular_value"),
                     F.round("explained_ratio", 6).alias("explained_ratio"),
                     F.round("cumulative_ratio", 6).alias("cumulative_ratio"))


query("q37b_explained_variance")(q37b)


def q38(spark, sf):
    return _out(IterativeImputer(columns=DOC_FEATS).fit_transform(_docs(spark, sf)))


query("q38_iterative_fill")(q38)


# ------------------------------------------------------------------ Q39-Q40: EM
def q39(spark, sf):
    return _out(EMImputer(columns=DOC_FEATS).fit_transform(_docs(spark, sf)))


query("q39_em_fill")(q39)


def q39b(spark, sf):
    """Two columns, holes only in n_words: EM's fixed point is the complete-case regression."""
    d = doc_masked(spark, sf, truth=False, masks={"n_words": (42, 250)}).select("doc_id", "n_chars", "n_words")
    out = EMImputer(columns=["n_chars", "n_words"]).fit_transform(d)
    return out.select("doc_id", F.round("n_words", 2).alias("n_words"))


Q39B_SQL = f"""WITH m AS ({doc_masked_sql(truth=False, masks={'n_words': (42, 250)})}),
r AS (SELECT regr_slope(n_words, n_chars) AS b, regr_intercept(n_words, n_chars) AS a FROM m)
SELECT doc_id, round(coalesce(n_words, a + b * n_chars), 2) AS n_words FROM m, r"""
query("q39b_em_two_column", Q39B_SQL)(q39b)


def q39c(spark, sf):
    """EM fit statistics: iterations, final log-likelihood, fitted means."""
    m = EMImputer(columns=DOC_FEATS, stop="loglik", tol=1e-4).fit(_docs(spark, sf))
    rows = [(c, float(v)) for c, v in zip(DOC_FEATS, m.mu_)]
    rows += [("__n_iter", float(m.n_iter_)), ("__log_likelihood", float(m.log_likelihood_))]
    return spark.createDataFrame(rows, "name string, value double")


query("q39c_em_fit_stats")(q39c)


def q40(spark, sf):
    d = _docs(spark, sf)
    half = missing_flag("doc_id", 50, 500)
    model = EMImputer(columns=DOC_FEATS, stop="loglik", tol=1e-4).fit(d.where(half))
    return _out(model.transform(d.where(~half)))


query("q40_em_transform")(q40)


# ------------------------------------------------------------------ Q41: mixture
def q41(spark, sf):
    return _out(GaussianMixtureImputer(2, columns=DOC_FEATS).fit_transform(_docs(spark, sf)))


query("q41_mixture_fill")(q41)


def q41b(spark, sf):
    s = select_components(_docs(spark, sf).select(*DOC_FEATS), DOC_FEATS)
    return s.select("n_components", F.round("log_likelihood", 2).alias("log_likelihood"),
                    F.round("aic", 2).alias("aic"), F.round("bic", 2).alias("bic"))


query("q41b_mixture_components")(q41b)


# ------------------------------------------------------------------ Q42-Q44: multiple imputation
M_IMP = 5


def q42(spark, sf):
    d = _docs(spark, sf)
    after = MI.multiple_after(d, "doc_id", DOC_FEATS, M_IMP).withColumn("variant", F.lit("noise_after"))
    before = MI.multiple_before(d, "doc_id", DOC_FEATS, 3, em_max_iter=50).withColumn("variant", F.lit("noise_before"))
    cols = ["variant", "imputation", "doc_id", *DOC_FEATS]
    return after.select(*cols).unionByName(before.select(*cols)).select(
        "variant", "imputation", "doc_id", *[F.round(c, 4).alias(c) for c in DOC_FEATS])


query("q42_multiple_imputation")(q42)


def _mean_noise_long(spark, sf):
    """M completed tables: mean fill plus portable noise on the filled cells."""
    d = _docs(spark, sf)
    return MI.multiple_after(d, "doc_id", DOC_FEATS, M_IMP, base_imputer=MeanImputer(columns=DOC_FEATS))


def _mean_noise_sql() -> str:
    from lacuna.operators.multiple import NOISE_SCALE, noise_salt
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}" for c in DOC_FEATS)
    parts = []
    for m in range(1, M_IMP + 1):
        sel = ", ".join(
            f"CASE WHEN {c} IS NULL THEN mu_{c} + {NOISE_SCALE} * sd_{c} * {gaussian_noise_sql('doc_id', noise_salt(m, c))} "
            f"ELSE {c} END AS {c}" for c in DOC_FEATS)
        parts.append(f"SELECT {m} AS imputation, doc_id, {sel} FROM m, s")
    return f"""WITH m AS ({doc_masked_sql(truth=False)}),
s AS (SELECT {stats} FROM m),
long AS ({' UNION ALL '.join(parts)})"""


def q43(spark, sf):
    lg = _mean_noise_long(spark, sf)
    a = MI.pool(lg, "doc_id", DOC_FEATS, "mean")
    b = MI.pool(lg, "doc_id", DOC_FEATS, "median")
    return a.select("doc_id", *[F.round(c, 4).alias(f"{c}_mean") for c in DOC_FEATS]).join(
        b.select("doc_id", *[F.round(c, 4).alias(f"{c}_median") for c in DOC_FEATS]), "doc_id")


Q43_SQL = _mean_noise_sql() + "\nSELECT doc_id, " + ", ".join(
    f"round(avg({c}), 4) AS {c}_mean, round(median({c}), 4) AS {c}_median" for c in DOC_FEATS) + \
    " FROM long GROUP BY doc_id"
query("q43_pool", Q43_SQL)(q43)


def q44(spark, sf):
    r = MI.rubin(_mean_noise_long(spark, sf), DOC_FEATS)
    return r.select("column_name", "m", *[F.round(c, 6).alias(c) for c in
                                          ("pooled_mean", "within", "between", "total", "se", "ci_low", "ci_high")],
                    _sig6(F.col("df")).alias("df"))


def _sig6(x):
    """Six significant digits (df is ill-conditioned when the between variance is tiny)."""
    e = F.floor(F.log10(x)) - 5
    return F.round(x / F.pow(F.lit(10.0), e), 0) * F.pow(F.lit(10.0), e)


Q44_SQL = _mean_noise_sql() + ",\ncells AS (" + " UNION ALL ".join(
    f"SELECT imputation, '{c}' AS column_name, {c} AS v FROM long" for c in DOC_FEATS) + """),
per AS (SELECT column_name, imputation, avg(v) AS q, var_samp(v) / count(v) AS u FROM cells GROUP BY 1, 2),
agg AS (SELECT column_name, count(*) AS m, avg(q) AS pooled_mean, avg(u) AS within, var_samp(q) AS between FROM per GROUP BY 1)
SELECT column_name, m, round(pooled_mean, 6) AS pooled_mean, round(within, 6) AS within, round(between, 6) AS between,
       round(within + (1 + 1.0 / m) * between, 6) AS total, round(sqrt(within + (1 + 1.0 / m) * between), 6) AS se,
       round(pooled_mean - 1.96 * sqrt(within + (1 + 1.0 / m) * between), 6) AS ci_low,
       round(pooled_mean + 1.96 * sqrt(within + (1 + 1.0 / m) * between), 6) AS ci_high,
       round(df / power(10.0, floor(log10(df)) - 5), 0) * power(10.0, floor(log10(df)) - 5) AS df
FROM (SELECT *, CASE WHEN between > 0 THEN (m - 1) * power(1 + within / ((1 + 1.0 / m) * between), 2) END AS df FROM agg) a"""
query("q44_rubin", Q44_SQL)(q44)


# ------------------------------------------------------------------ Q36b rank sweep
def q36b(spark, sf):
    """RMSE of the standardized SVD fill per rank; all ranks share one moment table."""
    from lacuna.operators import evaluate as E
    d = doc_masked(spark, sf, truth=True)
    feats = d.select("doc_id", *DOC_FEATS, *[f"{c}__truth" for c in DOC_FEATS], *[f"{c}__mask" for c in DOC_FEATS])
    models = SVDImputer(2, tol=1e-4, columns=DOC_FEATS).sweep(feats, [1, 2, 3, 4])
    res = {f"rank={r}": m.transform(feats) for r, m in models.items()}
    p = E.pooled_scores(E.stack_methods(res, DOC_FEATS), DOC_FEATS)
    return p.select(F.regexp_extract("method", r"=(\d+)", 1).cast("int").alias("rank"),
                    F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"))


query("q36b_svd_rank_sweep")(q36b)


# ------------------------------------------------------------------ Q47 method comparison
def q47(spark, sf):
    """Every fill on the same held-out document cells, scored per column
    (NRMSE, RMSE, R2): the project's counterpart of the reference's method
    comparison (BASELINE B1-B5)."""
    from lacuna.operators import evaluate as E
    from lacuna.operators.group import GroupCenterImputer
    from lacuna.operators.knn import EnhancedKNNImputer, KNNImputer
    from lacuna.operators.simple import MedianImputer
    d = doc_masked(spark, sf, truth=True)
    aux = [c for c in d.columns if "__" in c]
    feats = DOC_FEATS
    makers = {
        "mean": lambda: MeanImputer(columns=feats),
        "median": lambda: MedianImputer(columns=feats),
        "group_mean": lambda: GroupCenterImputer("lang", columns=feats),
        "knn": lambda: KNNImputer("doc_id", 5, "distance", columns=feats, features=feats),
        "enhanced_knn": lambda: EnhancedKNNImputer("doc_id", 5, columns=feats, exclude=aux),
        "svd": lambda: SVDImputer(2, tol=1e-4, columns=feats),
        "em": lambda: EMImputer(columns=feats),
        "iterative": lambda: IterativeImputer(columns=feats),
        "mixture": lambda: GaussianMixtureImputer(2, columns=feats),
    }
    res = {name: make().fit_transform(d) for name, make in makers.items()}
    lg = MI.multiple_after(d.select("doc_id", *feats), "doc_id", feats, 3)
    pooled = MI.pool(lg, "doc_id", feats)
    truth = d.select("doc_id", *[f"{c}__truth" for c in feats], *[f"{c}__mask" for c in feats])
    res["multiple_em"] = pooled.join(truth, "doc_id")
    sc = E.numeric_scores(E.stack_methods(res, feats), feats)
    return sc.select("method", "column_name", "n_scored", F.round("rmse", 4).alias("rmse"),
                     F.round("nrmse", 6).alias("nrmse"), F.round("r2", 4).alias("r2"))


query("q47_method_comparison")(q47)


# ------------------------------------------------------------------ closed forms
# Two document columns, holes in one of them: each model family has a formula there, so a plain
# SQL engine checks the same code that the general queries above run.
TWO = ["n_chars", "n_words"]
TWO_MASK = {"n_words": (42, 250)}
TWO_CTE = f"m AS ({doc_masked_sql(truth=False, masks=TWO_MASK)})"
REGR = "SELECT regr_slope(n_words, n_chars) AS b, regr_intercept(n_words, n_chars) AS a FROM"


def _two(spark, sf):
    return doc_masked(spark, sf, truth=False, masks=TWO_MASK).select("doc_id", *TWO)


def _words(df, digits=2):
    return df.select("doc_id", F.round("n_words", digits).alias("n_words"))


def q36c(spark, sf):
    """One step of the standardized rank-1 fill: half the other column's score, signed."""
    return _words(SVDImputer(1, max_iter=1, columns=TWO).fit_transform(_two(spark, sf)))


#: means over observed cells; u, v: deviations of the mean-filled columns
DEVIATIONS = """c AS (SELECT avg(n_chars) AS mx, avg(n_words) AS my FROM m),
d AS (SELECT doc_id, n_words, n_chars - mx AS u, coalesce(n_words - my, 0.0) AS v, mx, my FROM m, c)"""

Q36C_SQL = f"""WITH {TWO_CTE}, {DEVIATIONS},
s AS (SELECT stddev_pop(u) AS su, stddev_pop(v) AS sv, sign(covar_pop(u, v)) AS g FROM d)
SELECT doc_id, round(coalesce(n_words, my + sv * 0.5 * g * u / su), 2) AS n_words FROM d, s"""
query("q36c_svd_two_columns", Q36C_SQL)(q36c)


def q37c(spark, sf):
    """One step of the centered rank-1 fill: projection on the first eigenvector."""
    return _words(SVDImputer(1, max_iter=1, center=True, scale=False, columns=TWO).fit_transform(_two(spark, sf)))


EIGEN = """e AS (SELECT a, b, c, (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS l1, (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS l2
      FROM (SELECT sum(u * u) AS a, sum(v * v) AS b, sum(u * v) AS c FROM d) x)"""

Q37C_SQL = f"""WITH {TWO_CTE}, {DEVIATIONS}, {EIGEN}
SELECT doc_id, round(coalesce(n_words, my + u * c * (l1 - a) / (c * c + (l1 - a) * (l1 - a))), 2) AS n_words FROM d, e"""
query("q37c_svd_centered_two_columns", Q37C_SQL)(q37c)


def q37d(spark, sf):
    model = SVDImputer(1, max_iter=1, center=True, scale=False, columns=TWO).fit(_two(spark, sf))
    return model.explained_variance(spark).select(
        "component", F.round("singular_value", 4).alias("singular_value"), F.round("explained_ratio", 6).alias("explained_ratio"),
        F.round("cumulative_ratio", 6).alias("cumulative_ratio"))


Q37D_SQL = f"""WITH {TWO_CTE}, {DEVIATIONS}, {EIGEN}
SELECT 1 AS component, round(sqrt(l1), 4) AS singular_value, round(l1 / (l1 + l2), 6) AS explained_ratio, round(l1 / (l1 + l2), 6) AS cumulative_ratio FROM e
UNION ALL SELECT 2, round(sqrt(l2), 4), round(l2 / (l1 + l2), 6), 1.0 FROM e"""
query("q37d_explained_variance_two_columns", Q37D_SQL)(q37d)


def q38b(spark, sf):
    """Round-robin regression with one hole column: a Bayesian ridge on the complete rows."""
    return _words(IterativeImputer(columns=TWO).fit_transform(_two(spark, sf)))


Q38B_SQL = f"""WITH RECURSIVE {TWO_CTE},
c AS (SELECT avg(n_chars) AS mx, stddev_pop(n_chars) AS sx, avg(n_words) AS my, stddev_pop(n_words) AS sy FROM m),
z AS (SELECT (n_chars - mx) / sx AS x, (n_words - my) / sy AS y FROM m, c WHERE n_words IS NOT NULL),
g AS (SELECT count(*) AS n, avg(x) AS ax, avg(y) AS ay, var_pop(x) * count(*) AS xx, covar_pop(x, y) * count(*) AS xy,
             var_pop(y) * count(*) AS yy FROM z),
r AS (
  SELECT 0 AS it, 1.0::DOUBLE / (yy / n + 2.220446049250313e-16) AS alpha, 1.0::DOUBLE AS lam, NULL::DOUBLE AS coef, false AS done FROM g
  UNION ALL
  SELECT it + 1, (n - alpha * xx / (lam + alpha * xx) + 2e-6) / (greatest(yy - 2 * b * xy + b * b * xx, 0.0) + 2e-6),
         (alpha * xx / (lam + alpha * xx) + 2e-6) / (b * b + 2e-6), b, coalesce(abs(coef - b) < 1e-3, false)
  FROM (SELECT r.*, xy / (xx + lam / alpha) AS b, n, xx, xy, yy FROM r, g WHERE NOT done AND it < 300) q),
f AS (SELECT xy / (xx + lam / alpha) AS b, ax, ay FROM r, g ORDER BY it DESC LIMIT 1)
SELECT doc_id, round(coalesce(n_words, my + sy * (ay - b * ax + b * (n_chars - mx) / sx)), 2) AS n_words FROM m, c, f"""
query("q38b_iterative_two_columns", Q38B_SQL)(q38b)


def q39d(spark, sf):
    """EM's fitted means and final log-likelihood: those of the regression-completed table."""
    m = EMImputer(columns=TWO).fit(_two(spark, sf))
    rows = [(c, float(v)) for c, v in zip(TWO, m.mu_)] + [("log_likelihood", float(m.log_likelihood_))]
    return spark.createDataFrame(rows, "name string, value double").select("name", F.round("value", 2).alias("value"))


Q39D_SQL = f"""WITH {TWO_CTE},
r AS ({REGR} m),
f AS (SELECT n_chars AS x, coalesce(n_words, a + b * n_chars) AS y FROM m, r),
s AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS c FROM f),
t AS (SELECT *, (vx + 1e-6) * (vy + 1e-6) - c * c AS det FROM s)
SELECT 'n_chars' AS name, round(mx, 2) AS value FROM t UNION ALL SELECT 'n_words', round(my, 2) FROM t UNION ALL
SELECT 'log_likelihood', round(-0.5 * (n * 2 * ln(2 * pi()) + n * ln(det)
  + (n - 1) * (vx * (vy + 1e-6) - 2 * c * c + vy * (vx + 1e-6)) / det), 2) FROM t"""
query("q39d_em_log_likelihood_two_columns", Q39D_SQL)(q39d)


def q40b(spark, sf):
    """EM fitted on one half of the rows, applied to the other."""
    d = _two(spark, sf)
    half = missing_flag("doc_id", 50, 500)
    return _words(EMImputer(columns=TWO).fit(d.where(half)).transform(d.where(~half)))


Q40B_SQL = f"""WITH {TWO_CTE},
r AS ({REGR} m WHERE {missing_flag_sql('doc_id', 50, 500)})
SELECT doc_id, round(coalesce(n_words, a + b * n_chars), 2) AS n_words FROM m, r WHERE NOT {missing_flag_sql('doc_id', 50, 500)}"""
query("q40b_em_transform_two_columns", Q40B_SQL)(q40b)


def q41c(spark, sf):
    """A mixture of one component: the regression of its covariance."""
    return _words(GaussianMixtureImputer(1, columns=TWO).fit_transform(_two(spark, sf)))


Q41C_SQL = f"""WITH {TWO_CTE},
c AS (SELECT avg(n_chars) AS mx, stddev_pop(n_chars) AS sx, avg(n_words) AS my, stddev_pop(n_words) AS sy FROM m),
z AS (SELECT (n_chars - mx) / sx AS x, coalesce((n_words - my) / sy, 0.0) AS y FROM m, c),
s AS (SELECT covar_pop(x, y) / (var_pop(x) + 1e-6) AS b FROM z)
SELECT doc_id, round(coalesce(n_words, my + sy * b * (n_chars - mx) / sx), 2) AS n_words FROM m, c, s"""
query("q41c_mixture_one_component", Q41C_SQL)(q41c)


def q41d(spark, sf):
    s = select_components(_two(spark, sf).select(*TWO), TWO, ks=(1,))
    return s.select("n_components", *[F.round(c, 2).alias(c) for c in ("log_likelihood", "aic", "bic")])


Q41D_SQL = f"""WITH {TWO_CTE},
c AS (SELECT avg(n_chars) AS mx, stddev_pop(n_chars) AS sx, avg(n_words) AS my, stddev_pop(n_words) AS sy FROM m),
z AS (SELECT (n_chars - mx) / sx AS x, coalesce((n_words - my) / sy, 0.0) AS y FROM m, c),
s AS (SELECT count(*) AS n, var_pop(x) * var_pop(y) - covar_pop(x, y) * covar_pop(x, y) AS det FROM z),
l AS (SELECT n, -0.5 * n * (2 * ln(2 * pi()) + ln(det) + 2) AS ll FROM s)
SELECT 1 AS n_components, round(ll, 2) AS log_likelihood, round(2 * 5 - 2 * ll, 2) AS aic, round(5 * ln(n) - 2 * ll, 2) AS bic FROM l"""
query("q41d_mixture_information_criteria", Q41D_SQL)(q41d)


MIX_STEPS, MIX_FILLS = 6, 3


def q41e(spark, sf):
    """Two components: a fixed number of EM steps from the hash-picked start, then of fill steps."""
    imp = GaussianMixtureImputer(2, MIX_FILLS, tol=0.0, columns=TWO, id_col="doc_id", fit_iter=MIX_STEPS, fit_tol=0.0)
    return _words(imp.fit_transform(_two(spark, sf)))


def q41f(spark, sf):
    s = select_components(_two(spark, sf), TWO, ks=(1, 2), id_col="doc_id", max_iter=MIX_STEPS, tol=0.0)
    return s.select("n_components", *[F.round(c, 2).alias(c) for c in ("log_likelihood", "aic", "bic")])


def _mixture_sql() -> str:
    """CTEs z (rows in standard units), p<i> (parameters after i steps) and e<i> (log densities under them)."""
    def density(k, norm=True):
        a, b, c = f"(vxx{k} + 1e-6)", f"vxy{k}", f"(vyy{k} + 1e-6)"
        dx, dy, det = f"(x - mx{k})", f"(y - my{k})", f"({a} * {c} - {b} * {b})"
        quad = f"({c} * {dx} * {dx} - 2 * {b} * {dx} * {dy} + {a} * {dy} * {dy}) / {det}"
        return f"ln(w{k}) - 0.5 * ({'2 * ln(2 * pi()) + ' if norm else ''}ln({det}) + {quad})"

    def after(k, r):
        mean = {v: f"sum({r} * {v}) / sum({r})" for v in "xy"}
        cov = {u + v: f"sum({r} * {u} * {v}) / sum({r}) - ({mean[u]}) * ({mean[v]})" for u, v in ("xx", "xy", "yy")}
        return f"sum({r}) / count(*) AS w{k}, {mean['x']} AS mx{k}, {mean['y']} AS my{k}, " + ", ".join(f"{e} AS v{n}{k}" for n, e in cov.items())

    ctes = [TWO_CTE, f"""c AS (SELECT avg(n_chars) AS ax, stddev_pop(n_chars) AS sx, avg(n_words) AS ay, stddev_pop(n_words) AS sy FROM m),
z AS MATERIALIZED (SELECT doc_id, (n_chars - ax) / sx AS x, coalesce((n_words - ay) / sy, 0.0) AS y, n_words IS NULL AS hole,
  {full_hash_sql('doc_id', 'mixture42')} AS h FROM m, c)""",
            """s AS (SELECT x, y, row_number() OVER (ORDER BY h) AS k FROM z QUALIFY k <= 2)""",
            "p0 AS MATERIALIZED (SELECT " + ", ".join(
                f"0.5::DOUBLE AS w{k}, (SELECT x FROM s WHERE k = {k}) AS mx{k}, (SELECT y FROM s WHERE k = {k}) AS my{k}, "
                f"covar_pop(x, x) AS vxx{k}, covar_pop(x, y) AS vxy{k}, covar_pop(y, y) AS vyy{k}" for k in (1, 2)) + " FROM z)"]
    for i in range(MIX_STEPS + 1):
        ctes.append(f"e{i} AS MATERIALIZED (SELECT x, y, {density(1)} AS l1, {density(2)} AS l2 FROM z, p{i})")
        if i < MIX_STEPS:
            ctes.append(f"p{i + 1} AS MATERIALIZED (SELECT {after(1, 'r')}, {after(2, '(1 - r)')} FROM (SELECT x, y, 1 / (1 + exp(l2 - l1)) AS r FROM e{i}))")
    last = f"p{MIX_STEPS}"
    y = "f0 AS MATERIALIZED (SELECT doc_id, hole, x, y FROM z)"
    ctes.append(y)
    for i in range(MIX_FILLS):
        given = ", ".join(f"my{k} + vxy{k} / (vxx{k} + 1e-6) * (x - mx{k}) AS g{k}" for k in (1, 2))
        ctes.append(f"f{i + 1} AS MATERIALIZED (SELECT doc_id, hole, x, CASE WHEN hole THEN (g1 + g2 * exp(l2 - l1)) / (1 + exp(l2 - l1)) ELSE y END AS y "
                    f"FROM (SELECT f{i}.*, {density(1, False)} AS l1, {density(2, False)} AS l2, {given} FROM f{i}, {last}))")
    return "WITH " + ",\n".join(ctes)


Q41E_SQL = _mixture_sql() + f"""
SELECT m.doc_id, round(coalesce(m.n_words, ay + sy * f.y), 2) AS n_words FROM m JOIN f{MIX_FILLS} f USING (doc_id), c"""
query("q41e_mixture_two_components", Q41E_SQL)(q41e)

Q41F_SQL = _mixture_sql() + f""",
one AS (SELECT count(*) AS n, var_pop(x) * var_pop(y) - covar_pop(x, y) * covar_pop(x, y) AS det FROM z),
l AS (SELECT 1 AS k, 5 AS q, -0.5 * n * (2 * ln(2 * pi()) + ln(det) + 2) AS ll FROM one
      UNION ALL SELECT 2, 11, sum(greatest(l1, l2) + ln(1 + exp(-abs(l1 - l2)))) FROM e{MIX_STEPS})
SELECT k AS n_components, round(ll, 2) AS log_likelihood, round(2 * q - 2 * ll, 2) AS aic, round(q * ln(n) - 2 * ll, 2) AS bic FROM l, one"""
query("q41f_mixture_two_components_criteria", Q41F_SQL)(q41f)


def q42b(spark, sf):
    """Noise before EM: each replicate's fill is the regression on its noisy complete rows."""
    out = MI.multiple_before(_two(spark, sf), "doc_id", TWO, 3, em_max_iter=100)
    return out.select("imputation", "doc_id", F.round("n_words", 2).alias("n_words"))


def _q42b_sql() -> str:
    from lacuna.operators.multiple import NOISE_SCALE, noise_salt
    noisy = ", ".join(f"{c} + {NOISE_SCALE} * sd_{c} * {{{c}}} AS {c}" for c in TWO)
    parts = []
    for i in range(1, 4):
        draws = noisy.format(**{c: gaussian_noise_sql("doc_id", noise_salt(i, c)) for c in TWO})
        parts.append(f"SELECT {i} AS imputation, doc_id, round(coalesce(n_words, a + b * n_chars), 2) AS n_words "
                     f"FROM m, ({REGR} (SELECT {draws} FROM m, s) y) r")
    sds = ", ".join(f"stddev_samp({c}) AS sd_{c}" for c in TWO)
    return f"WITH {TWO_CTE}, s AS (SELECT {sds} FROM m) " + " UNION ALL ".join(parts)


query("q42b_noise_before_em_two_columns", _q42b_sql())(q42b)


def q47b(spark, sf):
    """The comparison of the methods that SQL can compute, per column as in q47."""
    from lacuna.operators import evaluate as E
    from lacuna.plans.scoring import Q19_METHODS, doc_scored
    sc = E.numeric_scores(doc_scored(spark, sf, Q19_METHODS), DOC_FEATS)
    return sc.select("method", "column_name", "n_scored", F.round("rmse", 4).alias("rmse"),
                     F.round("nrmse", 6).alias("nrmse"), F.round("r2", 4).alias("r2"))


def _q47b_sql() -> str:
    from lacuna.plans.scoring import Q19_METHODS, _doc_cells, doc_fills_sql
    from lacuna.plans.sqlgen import numeric_scores_sql
    return doc_fills_sql(Q19_METHODS) + f"""
SELECT method, column_name, n_scored, round(rmse, 4) AS rmse, round(nrmse, 6) AS nrmse, round(r2, 4) AS r2
FROM ({numeric_scores_sql(_doc_cells(Q19_METHODS))}) s"""


query("q47b_closed_form_comparison", _q47b_sql())(q47b)
