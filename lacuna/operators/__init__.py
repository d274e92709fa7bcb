"""Imputers, masks and scorers: each ``fit`` runs Spark aggregations, each
``transform`` is a lazy Spark plan."""
