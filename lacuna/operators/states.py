"""Statistics that merge: a day's partition updates a model without reading the days before (SRC2).

Three states hold what the fits need and nothing of the rows: column counts and sums, group counts
and sums, and the moments of each missing pattern.  ``of`` reads a table once, ``merge`` adds two
states, ``save`` and ``load_state`` keep them as Parquet and one JSON text, and the imputers fit
from a state as from a table: ``MeanState.model()``, ``GroupMeanState.model(fallback)``,
``MomentState.em(...)``, ``MomentState.svd(...)``, ``MomentState.iterative(...)``.

Moments stay a DataFrame of (pattern, cell, value) however many patterns there are.  ``table()``
packs them, one row of (d+1)^2 numbers per pattern in standardized units, and an iteration of EM, of
the low-rank fill or of the round-robin regressions maps over patterns, not rows: the rows are read
once for the moments and once for the fill.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.columns import clean, pattern_bits, resolve_columns
from lacuna.session import cut

CENTRE_ROWS = 200
WIDE = 24  # above this many columns, sums come from numpy per Arrow batch


def _write(spark: SparkSession, path: str, kind: str, plain: dict, table: DataFrame | None) -> None:
    if table is not None:
        table.write.mode("overwrite").parquet(f"{path}/table")
    text = json.dumps({"state": kind, "plain": plain})
    spark.createDataFrame([(text,)], "state string").coalesce(1).write.mode("overwrite").text(f"{path}/state")


def load_state(spark: SparkSession, path: str):
    """A state that ``save`` wrote."""
    d = json.loads(spark.read.text(f"{path}/state").first()[0])
    p = d["plain"]
    if d["state"] == "mean":
        return MeanState(p["counts"], p["sums"])
    table = spark.read.parquet(f"{path}/table")
    if d["state"] == "group":
        return GroupMeanState(p["keys"], p["columns"], table)
    return MomentState(p["columns"], np.array(p["centre"]), table)


class MeanState:
    """Count and sum of the observed cells of each column."""

    def __init__(self, counts: dict, sums: dict):
        self.counts, self.sums = counts, sums

    @classmethod
    def of(cls, df: DataFrame, columns=None, exclude=()) -> MeanState:
        cols = resolve_columns(df, columns, "numeric", exclude)
        row = df.agg(*[x for i, c in enumerate(cols) for x in (F.count(clean(df, c)).alias(f"n{i}"), F.sum(clean(df, c).cast("double")).alias(f"s{i}"))]).first()
        return cls({c: row[f"n{i}"] for i, c in enumerate(cols)}, {c: row[f"s{i}"] or 0.0 for i, c in enumerate(cols)})

    def merge(self, other: MeanState) -> MeanState:
        cols = [*self.counts, *[c for c in other.counts if c not in self.counts]]
        return MeanState({c: self.counts.get(c, 0) + other.counts.get(c, 0) for c in cols},
                         {c: self.sums.get(c, 0.0) + other.sums.get(c, 0.0) for c in cols})

    def model(self):
        from lacuna.operators.simple import ValueModel
        return ValueModel("mean", {c: self.sums[c] / n for c, n in self.counts.items() if n})

    def save(self, spark: SparkSession, path: str) -> None:
        _write(spark, path, "mean", {"counts": self.counts, "sums": self.sums}, None)


class GroupMeanState:
    """Count and sum of the observed cells per group; a null key is a group."""

    def __init__(self, keys: list[str], columns: list[str], table: DataFrame):
        self.keys, self.columns, self.table = keys, columns, table

    @classmethod
    def of(cls, df: DataFrame, keys, columns=None, exclude=()) -> GroupMeanState:
        keys = [keys] if isinstance(keys, str) else list(keys)
        cols = resolve_columns(df, columns, "numeric", [*exclude, *keys])
        sums = [x for c in cols for x in (F.count(clean(df, c)).alias(f"n_{c}"), F.coalesce(F.sum(clean(df, c).cast("double")), F.lit(0.0)).alias(f"s_{c}"))]
        return cls(keys, cols, cut(df.groupBy(*keys).agg(*sums)))

    def merge(self, other: GroupMeanState) -> GroupMeanState:
        if (self.keys, self.columns) != (other.keys, other.columns):
            raise ValueError("states of other keys or columns do not merge")
        both = self.table.unionByName(other.table)
        return GroupMeanState(self.keys, self.columns, cut(both.groupBy(*self.keys).agg(
            *[F.sum(f"{k}_{c}").alias(f"{k}_{c}") for c in self.columns for k in ("n", "s")])))

    def model(self, **options):
        """GroupCenterImputer's model of group means; ``options`` are that imputer's."""
        from lacuna.operators.group import GroupCenterImputer
        sums = self.table.withColumnsRenamed({f"{k}_{c}": f"__{k}_{c}" for c in self.columns for k in ("n", "s")})
        return GroupCenterImputer(self.keys, columns=self.columns, **options).from_sums(sums, self.columns)

    def save(self, spark: SparkSession, path: str) -> None:
        _write(spark, path, "group", {"keys": self.keys, "columns": self.columns}, self.table)


def _cells(d: int) -> list[tuple[int, int]]:
    """Upper triangle of a (d+1) x (d+1) matrix of sums of [1, x][1, x]^T."""
    return [(i, j) for i in range(d + 1) for j in range(i, d + 1)]


class MomentState:
    """Sums of [1, x - centre][1, x - centre]^T per missing pattern, holes as 0: (p, cell, v)."""

    def __init__(self, columns: list[str], centre: np.ndarray, cells: DataFrame):
        self.columns, self.centre, self.cells = columns, centre, cells

    @classmethod
    def of(cls, df: DataFrame, columns=None, exclude=()) -> MomentState:
        cols = resolve_columns(df, columns, "numeric", exclude)
        d = len(cols)
        vals = df.select(*[clean(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
        few = vals.limit(CENTRE_ROWS).agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(d)]).first()
        centre = np.array([few[f"c{i}"] or 0.0 for i in range(d)])  # any centre will do: it only keeps sums small
        x = [F.lit(1.0)] + [F.coalesce(F.col(f"c{i}") - F.lit(float(centre[i])), F.lit(0.0)) for i in range(d)]
        rows = vals.select(pattern_bits(vals, [f"c{i}" for i in range(d)]).alias("p"), *[e.alias(f"x{i}") for i, e in enumerate(x)])
        return cls(cols, centre, cut(_wide_cells(rows, d) if d > WIDE else _narrow_cells(rows, d)))

    def merge(self, other: MomentState) -> MomentState:
        if self.columns != other.columns:
            raise ValueError("states of other columns do not merge")
        both = self.cells.unionByName(other._moved(self.centre))
        return MomentState(self.columns, self.centre, cut(both.groupBy("p", "cell").agg(F.sum("v").alias("v"))))

    def _moved(self, centre: np.ndarray) -> DataFrame:
        """The cells about another centre."""
        d, shift, cells = len(self.columns), self.centre - centre, _cells(len(self.columns))

        def run(it):
            for pdf in it:
                out = []
                for p, q in zip(pdf["p"], pdf["q"]):
                    T = np.eye(d + 1)
                    T[1:, 0] = np.where(np.array(list(p)) == "0", shift, 0.0)
                    Q = T @ _square(q, d) @ T.T
                    out.append(pd.DataFrame({"p": p, "cell": np.arange(len(cells), dtype=np.int32), "v": [Q[i, j] for i, j in cells]}))
                yield pd.concat(out, ignore_index=True)

        return self._packed().mapInPandas(run, "p string, cell int, v double")

    def _packed(self) -> DataFrame:
        """(p, q): the cells of a pattern in order."""
        return self.cells.groupBy("p").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "v"))), lambda x: x["v"]).alias("q"))

    def table(self) -> PatternTable:
        return PatternTable(self)

    def em(self, max_iter: int = 100, tol: float = 1e-6, stop: str = "change", start: np.ndarray | None = None):
        """EMImputer's fit from the state alone."""
        return em_over_patterns(self.table(), max_iter, tol, stop, start)

    def svd(self, **options):
        from lacuna.operators.lowrank import SVDImputer
        return SVDImputer(**options)._fit(FromTable(self.table()))

    def iterative(self, max_iter: int = 10, tol: float = 1e-3):
        return iterative_over_patterns(self.table(), max_iter, tol)

    def save(self, spark: SparkSession, path: str) -> None:
        _write(spark, path, "moments", {"columns": self.columns, "centre": self.centre.tolist()}, self.cells)


def _narrow_cells(rows: DataFrame, d: int) -> DataFrame:
    """One aggregate per cell: hash-aggregated with partial sums, one shuffle of patterns."""
    cells = _cells(d)
    sums = rows.groupBy("p").agg(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{n}") for n, (i, j) in enumerate(cells)])
    return sums.select("p", F.posexplode(F.array(*[f"s{n}" for n in range(len(cells))])).alias("cell", "v"))


def _wide_cells(rows: DataFrame, d: int) -> DataFrame:
    at = np.triu_indices(d + 1)

    def run(it):
        for pdf in it:
            x = pdf[[f"x{i}" for i in range(d + 1)]].to_numpy(dtype="float64")
            for p, places in pdf.groupby("p").indices.items():
                g = x[places].T @ x[places]
                yield pd.DataFrame({"p": p, "cell": np.arange(len(at[0]), dtype=np.int32), "v": g[at]})

    return rows.mapInPandas(run, "p string, cell int, v double").groupBy("p", "cell").agg(F.sum("v").alias("v"))


def _square(q, d: int) -> np.ndarray:
    Q = np.zeros((d + 1, d + 1))
    Q[np.triu_indices(d + 1)] = q
    return Q + np.triu(Q, 1).T


class PatternTable:
    """Moments in standardized units, a written row (p, q) per pattern."""

    def __init__(self, state: MomentState):
        self.cols, d = state.columns, len(state.columns)
        cells = _cells(d)
        # per column: observed rows, sum, sum of squares - of cells (0, 0), (0, i), (i, i)
        named = {n: (i, j) for n, (i, j) in enumerate(cells) if i == 0 or i == j}
        counts = [F.sum(F.when((F.col("cell") == 0) & (F.substring("p", i + 1, 1) == "0"), F.col("v"))).alias(f"n{i}") for i in range(d)]
        sums = [F.sum(F.when(F.col("cell") == n, F.col("v"))).alias(f"c{n}") for n in named]
        row = state.cells.agg(*counts, *sums).first()
        at = {v: k for k, v in named.items()}
        self.n = float(row[f"c{at[0, 0]}"] or 0.0)
        self.observed = np.array([row[f"n{i}"] or 0.0 for i in range(d)])
        s1 = np.array([row[f"c{at[0, i + 1]}"] or 0.0 for i in range(d)])
        s2 = np.array([row[f"c{at[i + 1, i + 1]}"] or 0.0 for i in range(d)])
        seen = np.maximum(self.observed, 1.0)
        off, var = s1 / seen, s2 / seen - (s1 / seen) ** 2
        self.m = np.where(self.observed > 0, state.centre + off, 0.0)
        self.s = np.where(var > 0, np.sqrt(np.maximum(var, 0.0)), 1.0)
        m, s, centre = self.m, self.s, state.centre

        def run(it):
            for pdf in it:
                out = []
                for p, q in zip(pdf["p"], pdf["q"]):
                    has = np.array(list(p)) == "0"
                    T = np.zeros((d + 1, d + 1))
                    T[0, 0] = 1.0
                    T[1:, 0] = np.where(has, (centre - m) / s, 0.0)
                    T[np.arange(1, d + 1), np.arange(1, d + 1)] = np.where(has, 1 / s, 0.0)
                    out.append((T @ _square(q, d) @ T.T).tobytes())
                yield pd.DataFrame({"p": pdf["p"], "q": out})

        self.rows = cut(state._packed().mapInPandas(run, "p string, q binary"))

    def summed(self, fn, size: int) -> np.ndarray:
        """Sum over patterns of ``fn(missing, Q)``, a vector of ``size`` numbers; only it reaches the driver."""
        d = len(self.cols)

        def run(it):
            total = np.zeros(size)
            for pdf in it:
                for p, q in zip(pdf["p"], pdf["q"]):
                    total += fn(np.array(list(p)) == "1", np.frombuffer(q).reshape(d + 1, d + 1))
            yield pd.DataFrame({"cell": np.arange(size, dtype=np.int32), "v": total})

        out = np.zeros(size)
        for r in self.rows.mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
            out[r["cell"]] = r["v"]
        return out


def _observed_map(miss: np.ndarray, fill: np.ndarray) -> np.ndarray:
    """Map of [1, z] that keeps observed cells and puts ``fill`` into the holes."""
    d = len(miss)
    W = np.zeros((d, d + 1))
    W[:, 0] = np.where(miss, fill, 0.0)
    W[np.arange(d), np.arange(1, d + 1)] = np.where(miss, 0.0, 1.0)
    return W


def em_over_patterns(table: PatternTable, max_iter: int, tol: float, stop: str, start: np.ndarray | None):
    """The EM iteration of gaussian.py with each step a pass over the patterns."""
    from lacuna.operators.gaussian import RIDGE, GaussianModel, conditional_map
    d, n, s, m = len(table.cols), table.n, table.s, table.m
    first = np.zeros(d) if start is None else (start - m) / s

    def sums(now, before):
        """Sum, cross-products and squared change (original units) of the completed table."""
        def maps(miss, params):
            return _observed_map(miss, first) if params is None else conditional_map(miss, *params, s)

        def one(miss, Q):
            W = maps(miss, now)
            D = (W - maps(miss, before)) * s[:, None] if now is not None else np.zeros_like(W)
            return np.concatenate((W @ Q[:, 0], (W @ Q @ W.T).ravel(), [np.trace(D @ Q @ D.T)]))
        got = table.summed(one, d + d * d + 1)
        mu, S2 = got[:d] / n, got[d:-1].reshape(d, d)
        return mu, (S2 - n * np.outer(mu, mu)) / (n - 1), S2, max(got[-1], 0.0)

    mu, cov, _, _ = sums(None, None)
    before, history, n_iter = None, [], 0
    for n_iter in range(1, max_iter + 1):
        now = (mu, cov)
        mu, cov, S2, change = sums(now, before)
        D = np.diag(s)
        covx = D @ cov @ D + RIDGE * np.eye(d)
        scatter = D @ (S2 - n * np.outer(mu, mu)) @ D
        sign, logdet = np.linalg.slogdet(covx)
        history.append(-math.inf if sign <= 0 else
                       -0.5 * (n * d * math.log(2 * math.pi) + n * logdet + float(np.trace(np.linalg.solve(covx, scatter)))))
        before = now
        if stop == "change" and math.sqrt(change) < tol:
            break
        if stop == "loglik" and n_iter > 1 and abs(history[-1] - history[-2]) < tol:
            break
    D = np.diag(s)
    return GaussianModel(None, table.cols, None, None, history, n_iter, mu_x=m + s * mu, sigma_x=D @ cov @ D)


class FromTable:
    """The Gram source of lowrank.py over a pattern table."""

    def __init__(self, table: PatternTable):
        self.table, self.cols, self.m = table, table.cols, table.m

    def gram(self, chain, s_u):
        from lacuna.operators.lowrank import chain_map, one_step
        d, chain = len(self.cols), list(chain)
        to_u = np.concatenate(([1.0], self.table.s / s_u))

        def one(miss, Q):
            Qu = Q * to_u[:, None] * to_u[None, :]
            old = chain_map(miss, chain[:-1])
            new = one_step(old, miss, *chain[-1]) if chain else old
            W = np.vstack([np.eye(1, d + 1), new])
            return np.append((W @ Qu @ W.T).ravel(), np.trace((new - old) @ Qu @ (new - old).T))

        got = self.table.summed(one, (d + 1) ** 2 + 1)
        return got[:-1].reshape(d + 1, d + 1), max(float(got[-1]), 0.0)


def iterative_over_patterns(table: PatternTable, max_iter: int, tol: float):
    """The round-robin regressions of gaussian.py: a regression is a pass over the patterns, and
    each round starts from the completion that the round before left in the written table."""
    from lacuna.operators.gaussian import IterativeModel, _ridge_step
    d, s, m = len(table.cols), table.s, table.m
    missing = table.n - table.observed
    order = [int(j) for j in np.argsort(missing, kind="stable") if missing[j] > 0.5]
    current, steps, n_iter = table.rows.withColumn("w", F.lit(None).cast("binary")), [], 0

    def replay(miss, w, chain):
        W = _observed_map(miss, np.zeros(d)) if w is None else np.frombuffer(w).reshape(d, d + 1).copy()
        for j, others, coef, intercept in chain:
            if miss[j]:
                row = coef @ W[others]
                row[0] += intercept
                W[j] = row
        return W

    def patterns(it):
        for pdf in it:
            for p, q, w in zip(pdf["p"], pdf["q"], pdf["w"]):
                yield p, np.array(list(p)) == "1", np.frombuffer(q).reshape(d + 1, d + 1), w

    def gram(j, chain):
        others = [i for i in range(d) if i != j]

        def run(it):
            G = np.zeros((d + 1, d + 1))
            for _, miss, Q, w in patterns(it):
                if not miss[j]:
                    W = replay(miss, w, chain)
                    C = np.vstack([np.eye(1, d + 1), W[others], W[j]])
                    G += C @ Q @ C.T
            yield pd.DataFrame({"cell": np.arange(G.size, dtype=np.int32), "v": G.ravel()})

        out = np.zeros((d + 1) ** 2)
        for r in current.mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
            out[r["cell"]] = r["v"]
        return out.reshape(d + 1, d + 1), others

    for n_iter in range(1, max_iter + 1):
        chain: list = []
        for j in order:
            G, others = gram(j, chain)
            if G[0, 0] < 2:
                continue
            chain.append((j, others, *_ridge_step(G)))

        def settled(it, chain=tuple(chain)):
            for p, miss, Q, w in patterns(it):
                W = replay(miss, w, chain)
                D = (W - replay(miss, w, ())) * s[:, None]
                yield pd.DataFrame({"p": [p], "q": [Q.tobytes()], "w": [W.tobytes()], "change": [max(float(np.trace(D @ Q @ D.T)), 0.0)]})

        written = cut(current.mapInPandas(settled, "p string, q binary, w binary, change double"))
        change = written.agg(F.sum("change")).first()[0] or 0.0
        current = written.drop("change")
        steps += chain
        if math.sqrt(change / max(missing.sum(), 1)) < tol * float(np.max(np.abs(m) + 3 * s)):
            break
    return IterativeModel(table.cols, m, s, steps, n_iter, [table.cols[j] for j in order])


def merged(states: list):
    """One state of many."""
    return reduce(lambda a, b: a.merge(b), states)
