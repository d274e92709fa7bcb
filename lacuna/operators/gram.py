"""Pairwise-complete moments of many columns in one scan (AGG19, AGG20).

For values Z (0 where missing) and presence M of a batch of rows, four matrix products hold all pairs:
M'M counts rows with both, Z'M sums one column over rows that have the other, (Z*Z)'M its squares,
Z'Z the products.  A task adds its batches up and hands on one row of arrays per column and group, so
what is shuffled is columns squared per task, whatever the rows.  Values are shifted by a rough
centre first, which leaves the result as it is and its rounding small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean

CENTRE_ROWS = 200


def _centres(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """Rough size of each column, from a few rows: any number gives the same result but for rounding."""
    few = rows.limit(CENTRE_ROWS).agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return np.array([0.0 if v is None else float(v) for v in few])


def pair_moments(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, i, j, n, si, sj, qi, qj, p) for all i < j: rows that have both columns, sums, squares and
    products of both over these rows (shifted values)."""
    d = len(columns)
    kind = rows.schema[key].dataType.simpleString()
    vals = rows.select(F.col(key).alias("k"), *[clean(rows, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    centre = _centres(vals, [f"c{i}" for i in range(d)])

    def run(batches):
        sums: dict = {}
        for b in batches:
            keys = b.column("k").to_pylist()
            x = np.column_stack([b.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(d)]).astype(float)
            groups: dict = {}
            for n, k in enumerate(keys):
                groups.setdefault(k, []).append(n)
            for k, at in groups.items():
                m = ~np.isnan(x[at])
                z = np.where(m, x[at] - centre, 0.0)
                m = m.astype(float)
                got = (m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z)
                sums[k] = got if k not in sums else tuple(a + b for a, b in zip(sums[k], got))
        for k, (n, s, q, p) in sums.items():
            kinds = pa.list_(pa.float64())
            # row i: over rows that have j, for each j; and column i of the same matrices for j's side
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * d), pa.array(range(d), pa.int32()), *[pa.array(list(m), kinds) for m in (n, s, s.T.copy(), q, q.T.copy(), p)]],
                ["k", "i", "n", "si", "sj", "qi", "qj", "p"])

    arrays = ("n", "si", "sj", "qi", "qj", "p")
    packed = vals.mapInArrow(run, f"k {kind}, i int, " + ", ".join(f"{a} array<double>" for a in arrays))
    # dealt by (k, i) while packed; the sums below need no further exchange
    cells = packed.repartition("k", "i").select("k", "i", F.posexplode(F.arrays_zip(*arrays)).alias("j", "x")).where("j > i")
    return cells.groupBy("k", "i", "j").agg(*[F.sum(f"x.{a}").alias(a) for a in arrays]).withColumnRenamed("k", key)


def pair_stats(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, col_a, col_b, corr, covariance) over pairwise-complete rows, sample covariance; null
    where there are too few rows or, for the correlation, no spread."""
    m = pair_moments(rows, columns, key)
    n = F.col("n")
    cab, caa, cbb = F.col("p") - F.col("si") * F.col("sj") / n, F.col("qi") - F.col("si") ** 2 / n, F.col("qj") - F.col("sj") ** 2 / n
    # what is left of equal values is rounding of their squares
    spread = (caa > 1e-13 * F.col("qi")) & (cbb > 1e-13 * F.col("qj"))
    names = F.array(*[F.lit(c) for c in columns])
    return m.select(key, F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"),
                    F.when((n > 1) & spread, cab / F.sqrt(caa * cbb)).alias("corr"), F.when(n > 1, cab / (n - 1)).alias("covariance"))
