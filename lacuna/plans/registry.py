from __future__ import annotations

import importlib
from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}

_MODULES = ("fills", "masking", "scoring", "ordered", "neighbors", "models", "streams")


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load():
    for m in _MODULES:
        importlib.import_module(f"lacuna.plans.{m}")


def queries() -> dict[str, Callable]:
    _load()
    return {k: v[0] for k, v in sorted(REGISTRY.items())}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in sorted(REGISTRY.items()) if v[1] is not None}
