"""The query catalog: each entry is a Spark plan over the driver tables plus,
where one exists, the equivalent SQL that an independent engine can run."""

from lacuna.plans.registry import REGISTRY, queries, oracle_sql

__all__ = ["REGISTRY", "queries", "oracle_sql"]
