"""Distribution-level analysis of fills (EVL15-EVL27, AGG19-AGG22).

All inputs are long or stacked tables keyed by ``method``; every statistic is
a grouped aggregate (exact quantiles through distributed selection), so a
method's column is never gathered in one task.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.quantiles import grouped_exact_quantiles
from lacuna.operators import gram
from lacuna.session import cut


def long_values(stacked: DataFrame, columns: list[str]) -> DataFrame:
    """(method, column_name, v) from a stacked (method, c1, c2, ...) table."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                      for c in columns])
    return stacked.select("method", F.explode(cells).alias("x")).select("method", "x.column_name", "x.v")


def grouped_quantiles(long: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact linear quantiles per group of a long table, one row per group (keys of any type,
    null keys are a group); nothing is collected.  The selection scans the values several times, so they are
    written once (keys and value only): the fits and masks behind a long table are not computed again by each scan."""
    return grouped_exact_quantiles(cut(long.select(*keys, value)), keys, value, probs)


def moment_table(long: DataFrame) -> DataFrame:
    """Per (method, column): n, mean, median, variance (ddof=1), skewness, kurtosis (EVL15-18)."""
    mom = long.where(F.col("v").isNotNull()).groupBy("method", "column_name").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("variance"),
        F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis"))
    med = grouped_quantiles(long.where(F.col("v").isNotNull()), ["method", "column_name"], "v", [0.5])
    return mom.join(med.withColumnRenamed("q0", "median"), ["method", "column_name"], "left")


#: above this many columns, pairs come from matrix products of Arrow batches instead of an aggregate each
GRAM_COLUMNS = 12


def pair_stats(stacked: DataFrame, columns: list[str], gram_columns: int = GRAM_COLUMNS) -> DataFrame:
    """Per method and column pair: Pearson correlation and sample covariance over
    pairwise-complete rows (EVL19, EVL20, AGG19, AGG20); one aggregation job."""
    if len(columns) > gram_columns:
        return gram.pair_stats(stacked, columns, "method")
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs += [F.corr(a, b).alias(f"c{i}"), F.covar_samp(a, b).alias(f"v{i}")]
    wide = stacked.groupBy("method").agg(*aggs)
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                               F.col(f"c{i}").alias("corr"), F.col(f"v{i}").alias("covariance"))
                      for i, (a, b) in enumerate(pairs)])
    return wide.select("method", F.explode(cells).alias("x")).select(
        "method", "x.col_a", "x.col_b", "x.corr", "x.covariance")


def group_table(stacked: DataFrame, key: str, column: str) -> DataFrame:
    """Per (method, group): n, mean, std (ddof=1) of a column (AGG21)."""
    return stacked.groupBy("method", key).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def between_group_variance(stacked: DataFrame, key: str, column: str) -> DataFrame:
    """Population variance of the group means, per method (AGG22, EVL21)."""
    return (stacked.groupBy("method", key).agg(F.avg(column).alias("gm"))
            .groupBy("method").agg(F.var_pop("gm").alias("between_var")))


def histogram(long: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bin counts per (method, series) (EVL24)."""
    if hi == lo:  # one value: everything in the first bin
        b = F.lit(0)
    else:
        b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
    return long.where(F.col("v").isNotNull()).groupBy("method", "series", b.alias("bin")).agg(
        F.count("*").alias("n"))


def stack(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [d.select(F.lit(m).alias("method"), *d.columns) for m, d in parts.items()])
