"""Single-value fills: constant, mean, median, mode (AGG1-AGG4).

Each ``fit`` is a single aggregation job over all target columns; the fitted
values become literals in a lazy ``coalesce`` projection.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import clean, resolve_columns
from lacuna.functions.quantiles import exact_quantiles_multi
from lacuna.operators.base import Imputer, ImputerModel, fill_with


class ConstantModel(ImputerModel):
    PER_ROW = True

    def __init__(self, values: dict):
        self.statistics_ = values

    def transform(self, df):
        fills = {c: v for c, v in self.statistics_.items() if c in df.columns}
        return fill_with(df, fills, keep_type=True)

    def _stat_rows(self):
        return [(c, "constant", v) for c, v in self.statistics_.items()]



def _compatible(dtype: T.DataType, value) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


class ConstantImputer(Imputer):
    """Fill with a fixed value: a scalar for every compatible column, or a dict per column.

    ``numeric_only=True`` restricts a scalar to numeric columns (the notebook
    variant).  A scalar is never forced into a column of another type.
    """

    def __init__(self, default_value=0, numeric_only: bool = False, exclude=()):
        self.default_value = default_value
        self.numeric_only = numeric_only
        self.exclude = tuple(exclude)

    def fit(self, df: DataFrame) -> ConstantModel:
        self._check_input(df)
        if isinstance(self.default_value, dict):
            vals = {c: v for c, v in self.default_value.items() if c in df.columns}
        else:
            vals = {}
            for f in df.schema.fields:
                if f.name in self.exclude:
                    continue
                if self.numeric_only and not isinstance(f.dataType, T.NumericType):
                    continue
                if _compatible(f.dataType, self.default_value):
                    vals[f.name] = self.default_value
                elif not self.numeric_only:
                    warnings.warn(f"constant {self.default_value!r} does not fit column "
                                  f"{f.name!r} ({f.dataType.simpleString()}); skipped")
        return ConstantModel(vals)


class ValueModel(ImputerModel):
    PER_ROW = True

    def __init__(self, statistic: str, values: dict, keep_type: bool = False):
        self.statistic = statistic
        self.statistics_ = values
        self.keep_type = keep_type

    def transform(self, df):
        fills = {c: v for c, v in self.statistics_.items() if c in df.columns and v is not None}
        return fill_with(df, fills, keep_type=self.keep_type)

    def _stat_rows(self):
        return [(c, self.statistic, v) for c, v in self.statistics_.items()]



class MeanImputer(Imputer):
    """Column mean of observed cells; an all-missing column is filled with 0."""

    def __init__(self, columns=None, exclude=()):
        self.columns = columns
        self.exclude = tuple(exclude)

    def fit(self, df):
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        if not cols:
            return ValueModel("mean", {})
        row = df.agg(*[F.avg(clean(df, c)).alias(c) for c in cols]).first()
        return ValueModel("mean", {c: (0.0 if row[c] is None else row[c]) for c in cols})


class MedianImputer(Imputer):
    """Exact median (even count: mean of the middle pair); all-missing → 0.

    The median is found by distributed histogram refinement
    (`lacuna.functions.quantiles`), which never gathers a column in one task.
    ``approx=True`` uses ``percentile_approx`` instead (one pass, rank error
    1/accuracy).
    """

    def __init__(self, columns=None, exclude=(), approx: bool = False, accuracy: int = 10000):
        self.columns = columns
        self.exclude = tuple(exclude)
        self.approx = approx
        self.accuracy = accuracy

    def fit(self, df):
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "numeric", self.exclude)
        if not cols:
            return ValueModel("median", {})
        if self.approx:
            row = df.agg(*[F.percentile_approx(clean(df, c).cast("double"), 0.5, self.accuracy).alias(c)
                           for c in cols]).first()
            meds = {c: row[c] for c in cols}
        else:
            meds = {c: q[0] for c, q in exact_quantiles_multi(df, cols, [0.5]).items()}
        return ValueModel("median", {c: (0.0 if v is None else v) for c, v in meds.items()})


class ModeImputer(Imputer):
    """Most frequent value, any type; ties go to the smallest value.

    All-missing columns stay missing.  Each column is a ``groupBy(value)``
    count with map-side partial aggregation, so a hot value costs one counter
    per task, then a max-by over the (distinct value) table.
    """

    def __init__(self, columns=None, exclude=()):
        self.columns = columns
        self.exclude = tuple(exclude)

    def fit(self, df):
        self._check_input(df)
        cols = resolve_columns(df, self.columns, "any", self.exclude)
        return ValueModel("mode", column_modes(df, cols), keep_type=True)


def mode_expr(value: str, count: str = "cnt"):
    """Aggregate over a (value, cnt) table: highest count, smallest value on ties."""
    return F.min_by(F.col(value), F.struct((-F.col(count)).alias("nc"), F.col(value).alias("v")))


def _sort_key(df: DataFrame, c: str):
    """A double that orders the column's values as the column type does, or None."""
    t = df.schema[c].dataType
    v = clean(df, c)
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return v.cast("double")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(v.cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(v).cast("double")
    return F.lit(None).cast("double")


def _from_string(t: T.DataType, s):
    if s is None or isinstance(t, T.StringType):
        return s
    if isinstance(t, T.BooleanType):
        return s == "true"
    if isinstance(t, T.IntegralType):
        return int(s)
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return float(s)
    return s  # decimals, dates, timestamps: cast by the fill expression


def column_modes(df: DataFrame, cols: list[str]) -> dict:
    """Mode per column (ties: smallest value), all columns in one job.

    Cells go to a long (column, value) table; a (column, value) count and a
    per-column ``min_by`` over (-count, typed key, value) both shuffle with
    map-side partial aggregation, so high-cardinality columns and hot values
    spread (``F.mode`` would keep one hash map of all values per column).
    Values travel as strings (Spark's casts round-trip them) next to a typed
    sort key, so ties still go to the smallest value in the column's own order.
    """
    if not cols:
        return {}
    simple = [c for c in cols if not isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType,
                                                                       T.BinaryType))]
    out = {}
    if simple:
        cells = F.array(*[F.struct(F.lit(i).alias("k"), clean(df, c).cast("string").alias("s"),
                                   _sort_key(df, c).alias("o")) for i, c in enumerate(simple)])
        long = df.select(F.explode(cells).alias("x")).select("x.k", "x.s", "x.o").where(F.col("s").isNotNull())
        counts = long.groupBy("k", "s", "o").agg(F.count("*").alias("cnt"))
        best = counts.groupBy("k").agg(F.min_by("s", F.struct(-F.col("cnt"), F.col("o"), F.col("s"))).alias("m"))
        got = {r["k"]: r["m"] for r in best.collect()}
        for i, c in enumerate(simple):
            out[c] = _from_string(df.schema[c].dataType, got.get(i))
    for c in cols:
        if c not in out:  # nested or binary values: one job for the column
            counts = (df.select(clean(df, c).alias(c)).where(F.col(c).isNotNull())
                      .groupBy(c).agg(F.count("*").alias("cnt")))
            out[c] = counts.agg(mode_expr(c).alias("m")).first()["m"]
    return {c: out[c] for c in cols}
