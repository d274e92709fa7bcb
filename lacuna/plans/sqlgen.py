"""SQL text for the oracle side of the scoring queries (the same definitions
as ``lacuna.operators.evaluate``, written for a plain SQL engine)."""

from __future__ import annotations


def cells_sql(method_tables: dict[str, str], columns: list[str]) -> str:
    """Long (method, column_name, f, t, m) rows from per-method filled tables that
    carry c, c__truth, c__mask."""
    parts = []
    for meth, tbl in method_tables.items():
        for c in columns:
            parts.append(f"SELECT '{meth}' AS method, '{c}' AS column_name, CAST({c} AS DOUBLE) AS f, "
                         f"CAST({c}__truth AS DOUBLE) AS t, {c}__mask AS m FROM {tbl}")
    return " UNION ALL ".join(parts)


def numeric_scores_sql(cells: str) -> str:
    return f"""SELECT method, column_name, count(e) AS n_scored,
  CAST(sum(CASE WHEN f IS NULL AND t IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unfilled,
  avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
  CASE WHEN stddev_samp(tv) > 0 THEN 1 - sum(e * e) / (var_pop(tv) * count(tv)) END AS r2,
  CASE WHEN max(tv) - min(tv) > 0 THEN sqrt(avg(e * e)) / (max(tv) - min(tv)) END AS nrmse,
  CASE WHEN max(tv) - min(tv) > 0 THEN avg(abs(e)) / (max(tv) - min(tv)) END AS nmae,
  avg(e) AS bias
FROM (SELECT method, column_name, f, t,
             CASE WHEN f IS NOT NULL AND t IS NOT NULL THEN f - t END AS e,
             CASE WHEN f IS NOT NULL AND t IS NOT NULL THEN t END AS tv
      FROM ({cells}) c0 WHERE m) c1
GROUP BY method, column_name"""


def pooled_scores_sql(cells: str) -> str:
    return f"""SELECT method, count(*) AS n_scored, sqrt(avg((f - t) * (f - t))) AS rmse, avg(abs(f - t)) AS mae,
  CASE WHEN min(t) < max(t) THEN 1 - sum((f - t) * (f - t)) / (var_pop(t) * count(t)) ELSE 0.0 END AS r2_score,
  avg(abs(f - t)) AS mean_abs_bias
FROM ({cells}) c0 WHERE m AND f IS NOT NULL AND t IS NOT NULL
GROUP BY method"""


def avg_rank_sql(col: str, desc: bool = False) -> str:
    d = " DESC" if desc else ""
    return (f"CASE WHEN {col} IS NOT NULL THEN CAST(rank() OVER (ORDER BY {col}{d} NULLS LAST) AS DOUBLE) + "
            f"(count(*) OVER (PARTITION BY {col}) - 1) / 2.0 END")


def rnd(cols: dict[str, int], src_cols: list[str]) -> str:
    """Select list rounding the named columns."""
    return ", ".join(f"round({c}, {cols[c]}) AS {c}" if c in cols else c for c in src_cols)
