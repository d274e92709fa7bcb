"""Fit / transform surface shared by every imputer.

An ``Imputer`` is a configuration; ``fit(df)`` runs the aggregations it needs
and returns an immutable ``ImputerModel``; ``model.transform(df)`` is a lazy
projection (or join, or ``mapInPandas``) that Spark plans with the rest of the
caller's query.  Only per-column statistics (size independent of the row
count) ever reach the driver.
"""

from __future__ import annotations

import datetime
import decimal

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.columns import clean


class Imputer:
    def fit(self, df: DataFrame) -> "ImputerModel":  # pragma: no cover - interface
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    @staticmethod
    def _check_input(df: DataFrame) -> None:
        if not isinstance(df, DataFrame):
            raise TypeError("input must be a Spark DataFrame")
        if df.isEmpty():
            raise ValueError("input DataFrame is empty")


class ImputerModel:
    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def stats_df(self, spark: SparkSession) -> DataFrame:
        """Fitted statistics as a (column, statistic, value) table."""
        rows = [(c, k, None if v is None else str(v)) for c, k, v in self._stat_rows()]
        return spark.createDataFrame(rows, "column string, statistic string, value string")

    def _stat_rows(self):
        return []

    #: whether ``transform`` is a projection, or a join that keeps every row once
    PER_ROW = False

    #: attributes that only fitting needs
    _fit_only = ()

    def save(self, path: str) -> None:
        """Write the fitted model: tables as Parquet, everything else as one JSON text, both under
        ``path``.  (A caller's predicate was turned into SQL text by the fit.)"""
        import json
        spark = SparkSession.getActiveSession()
        plain, tables = {}, []
        for name, v in vars(self).items():
            if name in self._fit_only:
                continue
            if isinstance(v, DataFrame):
                v.write.mode("overwrite").parquet(f"{path}/{name}")
                tables.append(name)
            else:
                plain[name] = _to_json(v, f"{type(self).__name__}.{name}")
        text = json.dumps({"module": type(self).__module__, "class": type(self).__name__, "plain": plain, "tables": tables})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").text(f"{path}/model")


def _to_json(v, where: str):
    if v is None or isinstance(v, (bool, int, float, str)):
        return v
    if isinstance(v, np.generic):
        return v.item()
    if isinstance(v, np.ndarray):
        return {"array": v.tolist(), "dtype": str(v.dtype)}
    if isinstance(v, (list, tuple)):
        return {"tuple" if isinstance(v, tuple) else "list": [_to_json(x, where) for x in v]}
    if isinstance(v, dict):
        return {"dict": [[_to_json(k, where), _to_json(x, where)] for k, x in v.items()]}
    if isinstance(v, (datetime.date, decimal.Decimal)):
        return {"repr": repr(v)}
    raise TypeError(f"{where} holds {type(v).__name__}, which has no saved form")


def _from_json(v):
    if not isinstance(v, dict):
        return v
    (kind, x), *_ = v.items()
    if kind == "array":
        return np.array(x, dtype=v["dtype"])
    if kind == "dict":
        return {_from_json(k): _from_json(y) for k, y in x}
    if kind == "repr":
        name, args = x.split("(", 1)
        args = [a.strip().strip("'") for a in args.rstrip(")").split(",")]
        if name.endswith("Decimal"):
            return decimal.Decimal(args[0])
        return {"datetime.date": datetime.date, "datetime.datetime": datetime.datetime}[name](*map(int, args))
    items = [_from_json(y) for y in x]
    return tuple(items) if kind == "tuple" else items


def load_model(path: str) -> "ImputerModel":
    """Read a model written by ``ImputerModel.save``."""
    import importlib
    import json
    spark = SparkSession.getActiveSession()
    d = json.loads(spark.read.text(f"{path}/model").first()[0])
    if not d["module"].startswith("lacuna."):
        raise ValueError(f"{path} holds a model of another library: {d['module']}")
    cls = getattr(importlib.import_module(d["module"]), d["class"])
    model = cls.__new__(cls)
    for name in cls._fit_only:
        setattr(model, name, None)
    for name, v in d["plain"].items():
        setattr(model, name, _from_json(v))
    for name in d["tables"]:
        setattr(model, name, spark.read.parquet(f"{path}/{name}"))
    return model


def fill_with(df: DataFrame, fills: dict, keep_type: bool = False) -> DataFrame:
    """Replace missing cells of the given columns in one projection.

    ``fills`` maps a column to a Column or a Python value.  Numeric fills come
    out as double unless ``keep_type``; other columns pass through unchanged
    and keep their order.
    """
    out = []
    for name in df.columns:
        if name in fills:
            v = fills[name]
            v = v if hasattr(v, "_jc") else F.lit(v)
            c = clean(df, name)
            dtype = df.schema[name].dataType
            if keep_type:
                out.append(F.coalesce(c, v.cast(dtype)).alias(name))
            elif dtype.typeName() in ("string", "boolean", "date", "timestamp"):
                out.append(F.coalesce(c, v.cast(dtype)).alias(name))
            else:
                out.append(F.coalesce(c.cast("double"), v.cast("double")).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
