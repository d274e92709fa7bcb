"""Scoring fills against held-out truth (EVL1-EVL29).

Layout: a *scored table* has, for every scored column ``c``, the filled value
``c``, the truth ``c__truth`` and the held-out flag ``c__mask`` on the same
row (truth travels with the row from the mask, so no join is needed), plus a
``method`` column when several fills are stacked with ``unionByName``.
Every metric family is one ``groupBy(method).agg`` over that table with
partial aggregation; the outputs are long tables with one row per
(method, column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.ranking import average_rank
from lacuna.operators.masks import TRUTH

MASK = "__mask"


def holdout(df: DataFrame, id_col: str, columns: dict[str, int], permille: int) -> DataFrame:
    """Mask columns by the portable hash, keeping truth and held-out flag beside them."""
    from lacuna.functions.hashing import missing_flag
    from lacuna.functions.columns import clean
    out = []
    for name in df.columns:
        if name in columns:
            m = missing_flag(id_col, columns[name], permille)
            out.append(F.when(m, F.lit(None).cast(df.schema[name].dataType))
                       .otherwise(clean(df, name)).alias(name))
        else:
            out.append(F.col(name))
    for name in columns:
        out.append(clean(df, name).alias(name + TRUTH))
    for name in columns:
        out.append(F.coalesce(missing_flag(id_col, columns[name], permille), F.lit(False)).alias(name + MASK))
    return df.select(*out)


def stack_methods(results: dict[str, DataFrame], columns: list[str], keys: list[str] = ()) -> DataFrame:
    """One long scored table: (method, keys..., c, c__truth, c__mask ...) per method (SET2/SET3)."""
    parts = []
    for name, d in results.items():
        sel = [F.lit(name).alias("method"), *keys]
        for c in columns:
            sel += [F.col(c), F.col(c + TRUTH), F.col(c + MASK)]
        parts.append(d.select(*sel))
    return reduce(lambda a, b: a.unionByName(b), parts)


def stack_models(df: DataFrame, models: dict, columns: list[str]) -> DataFrame:
    """``stack_methods`` of several fitted models over one table in one scan: each model fills the
    observed columns in turn, its fills are set aside, and one explode stacks them (as doubles).
    For models whose ``transform`` is a projection or a join on the row's own columns; the others,
    which run Python over the rows or shuffle them, are refused."""
    for name, model in models.items():
        if not getattr(model, "PER_ROW", False):
            raise TypeError(f"{name}: {type(model).__name__} is no projection; stack its transform with stack_methods")
    raw = {c: f"__raw{i}" for i, c in enumerate(columns)}
    rest = [c for c in df.columns if c not in columns]
    cur, fills = df.select("*", *[F.col(c).alias(r) for c, r in raw.items()]), []
    for i, model in enumerate(models.values()):
        own = {c: f"__fill{i}_{j}" for j, c in enumerate(columns)}
        cur = model.transform(cur).select(*rest, *raw.values(), *fills, *[F.col(r).alias(c) for c, r in raw.items()],
                                          *[F.col(c).cast("double").alias(f) for c, f in own.items()])
        fills += own.values()
    per = F.array(*[F.struct(F.lit(name).alias("method"), *[F.col(f"__fill{i}_{j}").alias(f"f{j}") for j in range(len(columns))])
                    for i, name in enumerate(models)])
    extra = [x for c in columns for x in (c + TRUTH, c + MASK)]
    return (cur.select(*extra, F.explode(per).alias("x"))
            .select("x.method", *[F.col(f"x.f{j}").alias(c) for j, c in enumerate(columns)], *extra))


def _unpivot(scored: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("f"),
                               F.col(c + TRUTH).cast(kind).alias("t"), F.col(c + MASK).alias("m"))
                      for c in columns])
    return (scored.select("method", F.explode(cells).alias("x"))
            .select("method", "x.column_name", "x.f", "x.t", "x.m").where(F.col("m")))


def numeric_scores(scored: DataFrame, columns: list[str]) -> DataFrame:
    """Per (method, column): n_scored, n_unfilled, mse, rmse, mae, r2, nrmse, nmae, bias (EVL1-3, EVL9).

    Only held-out cells count; pairs with a missing fill are dropped and counted
    (``n_unfilled``).  r2 is null when the truth has no spread.
    """
    cells = _unpivot(scored, columns)
    valid = F.col("f").isNotNull() & F.col("t").isNotNull()
    e = F.when(valid, F.col("f") - F.col("t"))
    tv = F.when(valid, F.col("t"))
    agg = cells.groupBy("method", "column_name").agg(
        F.count(e).alias("n_scored"),
        F.sum(F.when(F.col("f").isNull() & F.col("t").isNotNull(), 1).otherwise(0)).cast("long").alias("n_unfilled"),
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"),
        F.sum(e * e).alias("sse"), (F.var_pop(tv) * F.count(tv)).alias("sst"),
        F.stddev_samp(tv).alias("sd_t"), (F.max(tv) - F.min(tv)).alias("range_t"))
    rmse = F.sqrt(F.col("mse"))
    return agg.select(
        "method", "column_name", "n_scored", "n_unfilled", "mse", rmse.alias("rmse"), "mae",
        F.when(F.col("sd_t") > 0, 1 - F.col("sse") / F.col("sst")).alias("r2"),
        F.when(F.col("range_t") > 0, rmse / F.col("range_t")).alias("nrmse"),
        F.when(F.col("range_t") > 0, F.col("mae") / F.col("range_t")).alias("nmae"),
        "bias")


def wide_scores(per_column: DataFrame, columns: list[str], metrics: tuple[str, ...] = ("rmse", "mae", "r2", "bias")) -> DataFrame:
    """One row per method with a column per scored column and metric, ``<column>_<metric>`` (EVL12)."""
    cells = [F.max(F.when(F.col("column_name") == c, F.col(m))).alias(f"{c}_{m}") for c in columns for m in metrics]
    return per_column.groupBy("method").agg(*cells)


def overall_scores(per_column: DataFrame) -> DataFrame:
    """Unweighted mean over columns per method (EVL4, EVL9); null r2 skipped."""
    return per_column.groupBy("method").agg(
        F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"), F.avg("r2").alias("r2_score"),
        F.avg(F.abs("bias")).alias("mean_abs_bias"))


def short_scores(numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    """One row per method (EVL10): means over numeric columns, and over categorical ones of the
    accuracy; both inputs are per (method, column).  A method without one kind has nulls there."""
    num = overall_scores(numeric)
    cat = categorical.groupBy("method").agg(F.avg("accuracy").alias("categorical_accuracy"))
    return num.join(cat, "method", "full").select("method", "rmse", "mae", "r2_score", "categorical_accuracy", "mean_abs_bias")


def categorical_scores(scored: DataFrame, columns: list[str]) -> DataFrame:
    """Per (method, column): accuracy and Jensen-Shannon divergence of the
    held-out value distributions (EVL5-EVL7, SET1, AGG16)."""
    cells = _unpivot(scored, columns, "string").where(F.col("t").isNotNull())
    acc = cells.groupBy("method", "column_name").agg(
        F.count("*").alias("n_scored"),
        F.avg(F.coalesce((F.col("f") == F.col("t")), F.lit(False)).cast("double")).alias("accuracy"))
    p = _shares(cells, "t", "p")
    q = _shares(cells.where(F.col("f").isNotNull()), "f", "q")
    k = ["method", "column_name", "v"]
    pq = p.join(q, k, "full").select(*k, F.coalesce("p", F.lit(0.0)).alias("p"),
                                     F.coalesce("q", F.lit(0.0)).alias("q"))
    js = pq.groupBy("method", "column_name").agg(_js_expr().alias("js_divergence"))
    return acc.join(js, ["method", "column_name"], "left")


def _shares(cells: DataFrame, col: str, name: str) -> DataFrame:
    k = ["method", "column_name"]
    counts = cells.groupBy(*k, F.col(col).alias("v")).agg(F.count("*").alias("n"))
    totals = cells.groupBy(*k).agg(F.count("*").alias("total"))  # one row per method and column
    return counts.join(totals, k).select(*k, "v", (F.col("n") / F.col("total")).alias(name))


EPS = 1e-10  # fixed value: smoothing added to both distributions in KL


def _js_expr() -> Column:
    m = (F.col("p") + F.col("q")) / 2
    kl_pm = F.sum((F.col("p") + EPS) * F.log((F.col("p") + EPS) / (m + EPS)))
    kl_qm = F.sum((F.col("q") + EPS) * F.log((F.col("q") + EPS) / (m + EPS)))
    return (kl_pm + kl_qm) / 2


def pooled_scores(scored: DataFrame, columns: list[str]) -> DataFrame:
    """All held-out cells of all columns pooled (EVL11): rmse, mae, r2_score, mean_abs_bias."""
    cells = _unpivot(scored, columns).where(F.col("f").isNotNull() & F.col("t").isNotNull())
    e = F.col("f") - F.col("t")
    agg = cells.groupBy("method").agg(
        F.count("*").alias("n_scored"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("sse"), (F.var_pop("t") * F.count("t")).alias("sst"),
        (F.min("t") < F.max("t")).alias("spread"))
    return agg.select(
        "method", "n_scored", F.sqrt("mse").alias("rmse"), "mae",
        F.when(F.col("spread"), 1 - F.col("sse") / F.col("sst")).otherwise(F.lit(0.0)).alias("r2_score"),
        F.col("mae").alias("mean_abs_bias"))


def rank_methods(metrics: DataFrame, decimals: int = 4) -> DataFrame:
    """Average-tie ranks on rmse, mae, r2 (descending) and bias, and their mean (EVL14, WIN9, TOP5).

    Metrics are rounded first so that ties do not depend on summation order.
    A table of one row per method; its windows run on that small table only.
    """
    m = metrics.select("method", *[F.round(c, decimals).alias(c) for c in
                                   ("rmse", "mae", "r2_score", "mean_abs_bias")])
    r = m.select("method", "rmse", "mae", "r2_score", "mean_abs_bias",
                 average_rank("rmse").alias("rmse_rank"), average_rank("mae").alias("mae_rank"),
                 average_rank("r2_score", ascending=False).alias("r2_rank"),
                 average_rank("mean_abs_bias").alias("bias_rank"))
    ranks = ["rmse_rank", "mae_rank", "r2_rank", "bias_rank"]
    return r.withColumn("overall_rank", reduce(lambda a, b: a + b, [F.col(x) for x in ranks]) / 4.0)


def best_methods(per_method: DataFrame) -> DataFrame:
    """Best method per metric (TOP3): lowest rmse/mae, highest r2 and, where the table has it,
    highest categorical accuracy (nulls dropped, TOP2)."""
    parts = []
    metrics = [("rmse", True), ("mae", True), ("r2_score", False)]
    metrics += [(c, False) for c in ("accuracy", "categorical_accuracy") if c in per_method.columns]
    for metric, lowest in metrics:
        d = per_method.where(F.col(metric).isNotNull())
        key = F.struct(F.col(metric) if lowest else -F.col(metric), F.col("method"))
        parts.append(d.agg(F.min_by("method", key).alias("best_method"),
                           (F.min(metric) if lowest else F.max(metric)).alias("best_value"))
                     .select(F.lit(metric).alias("metric"), "best_method", "best_value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def improvement_over(per_method: DataFrame, baseline: str, metric: str = "rmse") -> DataFrame:
    """(baseline - x) / baseline * 100 per method (EVL28)."""
    # the baseline is one number of a one-row-per-method table
    b = per_method.where(F.col("method") == baseline).select(metric).first()
    base = F.lit(None).cast("double") if b is None else F.lit(b[0])
    return per_method.select("method", F.col(metric),
                             F.when(base != 0, (base - F.col(metric)) / base * 100).alias("improvement_pct"))
