"""Column selection and the NULL/NaN normalization every operator relies on."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(df: DataFrame, name: str) -> T.StructField:
    return df.schema[name]


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(_field(df, name).dataType, T.NumericType)


def is_string(df: DataFrame, name: str) -> bool:
    return isinstance(_field(df, name).dataType, T.StringType)


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(_field(df, name).dataType, (T.FloatType, T.DoubleType))


def clean(df: DataFrame, name: str) -> Column:
    """The column with float NaN turned into NULL, so there is one missing marker."""
    c = F.col(name)
    if is_fractional(df, name):
        return F.nanvl(c, F.lit(None).cast(_field(df, name).dataType))
    return c


def as_double(df: DataFrame, name: str) -> Column:
    return clean(df, name).cast("double")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def resolve_columns(df: DataFrame, columns: Iterable[str] | None, kind: str = "numeric",
                    exclude: Iterable[str] = (), warn: bool = True) -> list[str]:
    """Pick target columns.

    ``columns=None`` selects every column of ``kind`` ('numeric', 'string' or
    'any') except ``exclude``.  An explicit list keeps the usable names in the
    given order; absent or wrongly typed names are skipped with a warning.
    """
    ex = set(exclude)
    if columns is None:
        if kind == "numeric":
            return numeric_columns(df, ex)
        if kind == "string":
            return string_columns(df, ex)
        return [c for c in df.columns if c not in ex]
    out = []
    for c in columns:
        if c not in df.columns:
            if warn:
                warnings.warn(f"column {c!r} not found; skipped")
            continue
        if kind == "numeric" and not is_numeric(df, c):
            if warn:
                warnings.warn(f"column {c!r} is not numeric; skipped")
            continue
        if kind == "string" and not is_string(df, c):
            if warn:
                warnings.warn(f"column {c!r} is not a string column; skipped")
            continue
        out.append(c)
    return out


def pattern_bits(df: DataFrame, columns: list[str]) -> Column:
    """Missing pattern of a row as a string of one 0 or 1 per column, for any number of columns."""
    if not columns:
        return F.lit("")
    return F.concat(*[F.when(clean(df, c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
