"""Scoring frames that were filled elsewhere (JOI2): truth, fill and mask as separate tables.

The reference pairs its frames by row position; rows of distributed tables have none, so they
are paired by an id.  Truth and mask are joined once and written bucketed and sorted by the id; every
method's fill is written the same way.  A frame is shuffled once, for its write; the joins, the
scores and the report read buckets side by side without a further shuffle, however many
methods follow.

Cases: a row counts for the scores when its id is on all sides and once on each; the report counts
the others (rows of only one side, ids that repeat, rows without an id).  A null in the mask
means not held out.  Cells that a fill left empty are scored as unfilled, as elsewhere.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import clean
from lacuna.operators.evaluate import MASK
from lacuna.operators.masks import TRUTH
from lacuna.session import checkpoint_dir, delete_on_exit


class FrameScores:
    """``FrameScores(truth, mask, "id", columns).add("mean", filled).scored()`` is the scored table of
    evaluate.py; ``report()`` tells per method what could not be paired.

    ``mask`` has a boolean per column of ``columns``: True where the cell was held out.  ``buckets``
    follows the shuffle partitions unless given.  The written tables stay in the session's catalog
    until ``close()``.
    """

    def __init__(self, truth: DataFrame, mask: DataFrame, id_col: str, columns: list[str], buckets: int | None = None):
        for frame, name in ((truth, "truth"), (mask, "mask")):
            absent = {id_col, *columns} - set(frame.columns)
            if absent:
                raise ValueError(f"{name} lacks {sorted(absent)}")
        self.spark, self.id_col, self.columns = truth.sparkSession, id_col, list(columns)
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.fills: dict[str, DataFrame] = {}
        self.tables: list[str] = []
        t = self._per_id(truth.select(id_col, *[clean(truth, c).alias(c + TRUTH) for c in columns]), "n_truth")
        m = self._per_id(mask.select(id_col, *[F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c + MASK) for c in columns]), "n_mask")
        self.held = self._written(t.join(m, id_col, "full"))

    def add(self, method: str, filled: DataFrame) -> FrameScores:
        absent = {self.id_col, *self.columns} - set(filled.columns)
        if absent:
            raise ValueError(f"{method} lacks {sorted(absent)}")
        rows = filled.select(self.id_col, *[clean(filled, c).alias(c) for c in self.columns])
        self.fills[method] = self._written(self._per_id(rows, "n_fill"))
        return self

    def _per_id(self, rows: DataFrame, count: str) -> DataFrame:
        cols = [c for c in rows.columns if c != self.id_col]
        return rows.groupBy(self.id_col).agg(F.count("*").alias(count), *[F.first(c).alias(c) for c in cols])

    def _written(self, rows: DataFrame) -> DataFrame:
        """The rows, one per id, as a table bucketed and sorted by the id."""
        name = f"lacuna_frame_{uuid.uuid4().hex}"
        path = delete_on_exit(self.spark, f"{checkpoint_dir(self.spark).rstrip('/')}/lacuna-frames/{name}")
        (rows.repartition(self.buckets, self.id_col).write.format("parquet").option("path", path)
         .bucketBy(self.buckets, self.id_col).sortBy(self.id_col).saveAsTable(name))
        self.tables.append(name)
        return self.spark.table(name)

    def scored(self) -> DataFrame:
        """(method, id, c, c__truth, c__mask ...): rows that are once on every side."""
        if not self.fills:
            raise ValueError("no fill was added")
        once = self.held.where("n_truth = 1 AND n_mask = 1").drop("n_truth", "n_mask")
        extra = [x for c in self.columns for x in (c + TRUTH, c + MASK)]
        parts = [once.join(fill.where("n_fill = 1"), self.id_col).select(F.lit(name).alias("method"), self.id_col, *self.columns, *extra)
                 for name, fill in self.fills.items()]
        return reduce(DataFrame.unionByName, parts)

    def report(self) -> DataFrame:
        """method, n_paired, n_without_fill, n_without_truth, n_without_mask, n_repeated, n_without_id (rows of
        the fill for the last one, ids for the others)."""
        parts = []
        for name, fill in self.fills.items():
            both = self.held.join(fill, self.id_col, "full")
            has = {k: F.coalesce(F.col(f"n_{k}"), F.lit(0)) for k in ("truth", "mask", "fill")}
            known = F.col(self.id_col).isNotNull()

            def count(condition):
                return F.count(F.when(known & condition, 1))

            parts.append(both.agg(
                count((has["truth"] == 1) & (has["mask"] == 1) & (has["fill"] == 1)).alias("n_paired"),
                count((has["truth"] > 0) & (has["fill"] == 0)).alias("n_without_fill"),
                count((has["truth"] == 0) & (has["fill"] > 0)).alias("n_without_truth"),
                count((has["truth"] > 0) & (has["mask"] == 0)).alias("n_without_mask"),
                count(F.greatest(*has.values()) > 1).alias("n_repeated"),
                F.coalesce(F.sum(F.when(~known, has["fill"])), F.lit(0)).alias("n_without_id"),
            ).select(F.lit(name).alias("method"), "*"))
        return reduce(DataFrame.unionByName, parts)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = []
