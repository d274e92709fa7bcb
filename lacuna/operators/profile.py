"""Column profiles: missing summary and totals (AGG12, TOP1, EVL29)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import clean


def missing_summary(df: DataFrame) -> DataFrame:
    """Per column: dtype, n_rows, n_missing, pct_missing, rank_pos (by pct desc).

    One aggregation job; the per-column unpivot and the ranking run on a table
    with one row per column.
    """
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(clean(df, c)).alias(f"__c{i}") for i, c in enumerate(cols)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                               (F.col("__n") - F.col(f"__c{i}")).alias("n_missing"))
                      for i, c in enumerate(cols)])
    long = row.select(F.col("__n").alias("n_rows"), F.explode(cells).alias("x")).select(
        "x.column_name", "x.dtype", "n_rows", "x.n_missing")
    pct = F.when(F.col("n_rows") > 0, F.col("n_missing") * 100.0 / F.col("n_rows"))
    w = Window.orderBy(pct.desc(), F.col("column_name"))
    return long.select("column_name", "dtype", "n_rows", "n_missing", pct.alias("pct_missing"),
                       F.row_number().over(w).cast("long").alias("rank_pos"))


def missing_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing cells in a table before and after a fill (EVL29), one row."""
    def total(d):
        return sum((F.count(F.lit(1)) - F.count(clean(d, c))) for c in d.columns)
    after_total = after.agg(total(after).cast("long")).first()[0]
    return before.agg((F.count(F.lit(1)) * len(before.columns)).cast("long").alias("n_cells"),
                      total(before).cast("long").alias("missing_before"),
                      F.lit(after_total).cast("long").alias("missing_after"))


def preview(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (TOP6): a top-n, so no global sort."""
    return df.orderBy(order_by).limit(n)
