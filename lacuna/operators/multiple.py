"""Multiple imputation (MOD14-MOD19): M completed tables as one long table,
pooling and Rubin's rules.

Noise is hash-seeded per (row, imputation, column), so the replicates do
not depend on partitioning.  Noise after the fill makes all M replicates in one
pass with ``explode(sequence(1, M))``; noise before it takes one scan for the moments
of all replicates and one for their fills.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean
from lacuna.functions.hashing import gaussian_noise
from lacuna.operators.gaussian import EMImputer, estep_batch
from lacuna.operators.moments import PatternMoments, TooManyPatterns

NOISE_SCALE = 0.01  # fixed value: noise sd as a share of each column's sd


def noise_salt(m: int, column: str, seed: int = 0) -> str:
    """One salt per (seed, imputation, column); no two of them are equal."""
    return f"noise|{seed}|{m}|{column}"


def replicate(df: DataFrame, M: int) -> DataFrame:
    return df.withColumn("imputation", F.explode(F.sequence(F.lit(1), F.lit(M))))


def add_noise(df: DataFrame, id_col: str, cols: list[str], sds: dict, M: int,
              holes: dict | None = None, seed: int = 0) -> DataFrame:
    """x + NOISE_SCALE * sd * N(0,1) on the chosen cells of a replicated table."""
    out = df
    for c in cols:
        z = F.lit(0.0)
        for m in range(1, M + 1):
            z = F.when(F.col("imputation") == m, gaussian_noise(id_col, noise_salt(m, c, seed))).otherwise(z)
        noisy = F.col(c) + F.lit(NOISE_SCALE * (sds[c] or 0.0)) * z
        if holes is not None:
            noisy = F.when(holes[c], noisy).otherwise(F.col(c))
        out = out.withColumn(c, noisy)
    return out


def multiple_after(df: DataFrame, id_col: str, cols: list[str], M: int = 5, base_imputer=None,
                   seed: int = 0) -> DataFrame:
    """MOD15: fill once (EM by default), then per replicate add noise to the filled cells."""
    base_imputer = base_imputer or EMImputer(max_iter=50, columns=cols)
    sds = df.agg(*[F.stddev_samp(clean(df, c)).alias(c) for c in cols]).first().asDict()
    flagged = df.select("*", *[clean(df, c).isNull().alias(f"__h{j}") for j, c in enumerate(cols)])
    filled = base_imputer.fit(df).transform(flagged)
    rep = replicate(filled, M)
    out = add_noise(rep, id_col, cols, sds, M, holes={c: F.col(f"__h{j}") for j, c in enumerate(cols)}, seed=seed)
    return out.drop(*[f"__h{j}" for j in range(len(cols))])


def multiple_before(df: DataFrame, id_col: str, cols: list[str], M: int = 5, em_max_iter: int = 50,
                    seed: int = 0) -> DataFrame:
    """MOD14: per replicate, noise on the observed training cells, an EM fit, and
    the fill of the original table.  One scan sums the pattern moments of all replicates, one
    fills them; with more patterns than moments are kept for, each replicate is fitted by passes."""
    sds = df.agg(*[F.stddev_samp(clean(df, c)).alias(c) for c in cols]).first().asDict()
    em = EMImputer(max_iter=em_max_iter, columns=cols)
    held = df.select(id_col, *[clean(df, c).cast("double").alias(c) for c in cols])
    noisy = add_noise(replicate(held, M), id_col, cols, sds, M, seed=seed)
    try:
        fitted = {int(m): em.fit_moments(pm) for m, pm in PatternMoments.by_group(noisy, "imputation", cols).items()}
    except TooManyPatterns:
        fitted = {m: em.fit(noisy.where(F.col("imputation") == m)) for m in range(1, M + 1)}
    params = {m: (np.asarray(g.mu_), np.asarray(g.sigma_)) for m, g in fitted.items()}
    bc = df.sparkSession.sparkContext.broadcast(params)  # (d + 1) d numbers per replicate
    rep = replicate(df.select(*[clean(df, c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns]), M)

    def fill(it):
        for pdf in it:
            X = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
            which = pdf["imputation"].to_numpy()
            for m in np.unique(which):
                X[which == m] = estep_batch(X[which == m], *bc.value[int(m)])
            for j, c in enumerate(cols):
                pdf[c] = X[:, j]
            yield pdf

    return rep.mapInPandas(fill, rep.schema)


def pool(long: DataFrame, id_col: str, cols: list[str], how: str = "mean") -> DataFrame:
    """Cell-wise mean or median over the M completed tables (MOD16)."""
    if how not in ("mean", "median"):
        raise ValueError(f"pooling takes the mean or the median, not {how!r}")
    f = F.avg if how == "mean" else F.median  # groups have M rows each
    return long.groupBy(id_col).agg(*[f(c).alias(c) for c in cols])


def rubin(long: DataFrame, cols: list[str], z: float = 1.96, within: str = "mean") -> DataFrame:
    """Rubin's rules for the mean of each column (MOD17-MOD19).

    Per imputation: estimate Q_m = mean, U_m = var/n (``within='mean'``) or var
    (``within='variable'``, the reference's form).  Pooled Q = avg Q_m,
    W = avg U_m, B = var_samp(Q_m), T = W + (1 + 1/M) B, se = sqrt(T),
    df = (M - 1)(1 + W / ((1 + 1/M) B))^2, and the 95% interval Q +- z se.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])
    lg = long.select("imputation", F.explode(cells).alias("x")).select("imputation", "x.column_name", "x.v")
    per = lg.groupBy("column_name", "imputation").agg(
        F.avg("v").alias("q"), F.var_samp("v").alias("var"), F.count("v").alias("n"))
    u = (F.col("var") / F.col("n")) if within == "mean" else F.col("var")
    per = per.withColumn("u", u)
    agg = per.groupBy("column_name").agg(
        F.count("*").alias("m"), F.avg("q").alias("pooled_mean"), F.avg("u").alias("within"),
        F.var_samp("q").alias("between"))
    M = F.col("m")
    total = F.col("within") + (1 + 1 / M) * F.col("between")
    se = F.sqrt(total)
    dfree = (M - 1) * F.pow(1 + F.col("within") / ((1 + 1 / M) * F.col("between")), 2)
    return agg.select("column_name", "m", "pooled_mean", "within", "between", total.alias("total"),
                      se.alias("se"), F.when(F.col("between") > 0, dfree).alias("df"),
                      (F.col("pooled_mean") - z * se).alias("ci_low"), (F.col("pooled_mean") + z * se).alias("ci_high"))
