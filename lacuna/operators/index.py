"""A packed tree over rows with missing cells, for neighbour search and range counting.

Building: rows are sorted by the set of features they have (their pattern) and by a Morton code of
quantile bins, so neighbours in the order are neighbours in space; consecutive rows of one pattern
are packed ``leaf_rows`` at a time into one row of bytes, a leaf.  That is one range shuffle.
Each further level packs ``FAN`` consecutive nodes into one, until at most ``TOP_NODES`` remain: leaf
size and fan are bounded, the depth follows the rows.  A node knows per feature its box and, of the
rows that have the feature, count and sum; boxes are real minima and maxima, so bounds hold
whatever the order looks like, and equal rows are no special case.

Searching: units (a receiver and the column to fill) travel in blocks of bytes, cut from units in the
order of the tree, so the units of a block reach the same few nodes.  The top nodes are broadcast;
every deeper level, and last the leaves, stream each node once past all blocks that reached it, and
blocks that meet there are worked on together.  What to do at a node is the caller's
``choose``: which children to open, and which to count whole without opening them.

Every meeting is at a node, and a node may be near to a third of all units.  Blocks hold ``UNITS`` units,
and a node that more than one part in ``HOT`` of all units reached is copied to several tasks that
share its blocks (fewer than ``HOT`` such nodes by that measure, so their list is broadcast).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.session import cut

LEAF_ROWS = 1024
FAN = 64
TOP_NODES = 4096
UNITS = 256
MEET = 1024  # units that a node looks at together
TASK_UNITS = 16384  # units of a task at the top
TASK_MEETINGS = 131072  # units that meet their nodes in one task
OUT_ROWS = 20000
HOT = 512
BINS = 256

NODE = ("node", "n", "every", "any", "lo", "hi", "count", "sum")


def _bytes(a: np.ndarray, dtype) -> bytes:
    return np.ascontiguousarray(a, dtype).tobytes()


def _of(raw: bytes, dtype, width: int | None = None) -> np.ndarray:
    a = np.frombuffer(raw, dtype)
    return a if width is None else a.reshape(-1, width)


def morton(x: np.ndarray, cuts: list[np.ndarray], wide: bool = False) -> np.ndarray:
    """Interleaved bits of the quantile bins of all features; a missing one is in bin 0.  With ``wide`` the
    next bit is that of the feature whose cells are widest, which unscaled distances follow."""
    d = len(cuts)
    bits = max(1, min(8, 62 // max(d, 1)))
    code = np.zeros(len(x), np.int64)
    bins = [np.where(np.isnan(x[:, i]), 0, np.searchsorted(c, x[:, i])).astype(np.int64) >> (8 - bits) for i, c in enumerate(cuts)]
    left, width = [bits] * min(d, 62), [float(c[-1] - c[0]) if len(c) else 0.0 for c in cuts]
    while any(left):
        i = max((i for i in range(len(left)) if left[i]), key=lambda i: (width[i] if wide else left[i], -i))
        left[i], width[i] = left[i] - 1, width[i] / 2
        code = (code << 1) | (bins[i] >> left[i] & 1)
    return code


def pattern(x: np.ndarray) -> np.ndarray:
    """The set of present features as a number; beyond 62 features a hash of it."""
    has = ~np.isnan(x)
    if x.shape[1] <= 62:
        return (has.astype(np.int64) << np.arange(x.shape[1])).sum(axis=1)
    rows, at = np.unique(has, axis=0, return_inverse=True)
    keys = np.array([hash(r.tobytes()) for r in rows], np.int64)  # an order only: leaves compare the sets themselves
    return keys[at.ravel()]


@dataclass
class Boxes:
    """Nodes as arrays: features that every row (any row) has, boxes over the rows that have them."""

    node: np.ndarray
    n: np.ndarray
    every: np.ndarray
    any: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    count: np.ndarray
    sum: np.ndarray

    def distances(self, x: np.ndarray, used: list[int], metric: str = "euclidean", scaled: bool = False):
        """Bounds of the (squared) distances of rows ``x`` to the rows of each node, over the features
        of ``used`` that both have; infinite where there may be none (upper) or are none (lower)."""
        m, t = len(x), len(self.node)
        low, top, sure, may = (np.zeros((m, t)) for _ in range(4))
        for i in used:
            v = x[:, i, None]
            has = ~np.isnan(v)
            every, some = has & self.every[None, :, i], has & self.any[None, :, i]
            with np.errstate(invalid="ignore"):
                gap = np.maximum(np.maximum(self.lo[None, :, i] - v, v - self.hi[None, :, i]), 0.0)
                far = np.maximum(np.abs(v - self.lo[None, :, i]), np.abs(v - self.hi[None, :, i]))
            if metric == "euclidean":
                gap, far = gap * gap, far * far
            low += np.where(every, gap, 0.0)
            top += np.where(some, far, 0.0)
            sure += every
            may += some
        with np.errstate(divide="ignore", invalid="ignore"):
            if scaled:
                low, top = low * (x.shape[1] / may), top * (x.shape[1] / sure)
            return np.where(may > 0, low, np.inf), np.where(sure > 0, top, np.inf)


def boxes_of(rows: pd.DataFrame, d: int) -> Boxes:
    def mat(c, dtype):
        return np.array([np.frombuffer(r, dtype) for r in rows[c]]).reshape(-1, d)
    return Boxes(rows["node"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), mat("every", np.uint8).astype(bool), mat("any", np.uint8).astype(bool),
                 *(mat(c, np.float64) for c in ("lo", "hi", "count", "sum")))


BOX = "node long, n long, every binary, any binary, lo binary, hi binary, count binary, sum binary"


def _box(node: int, n: int, every, some, lo, hi, count, total) -> tuple:
    return (node, n, _bytes(every, np.uint8), _bytes(some, np.uint8), *(_bytes(a, np.float64) for a in (lo, hi, count, total)))


@dataclass
class Tree:
    feats: list[str]
    cuts: list[np.ndarray]
    leaves: DataFrame  # node, ids, x
    levels: list[DataFrame]  # from below the top down to the leaves' boxes: parent and its children
    top: Boxes
    wide: bool = False


def build(rows: DataFrame, feats: list[str], leaf_rows: int | None = None, wide: bool = False) -> Tree | None:
    """Tree over ``rows`` (__id long, features as doubles, null where missing); None of no rows."""
    d, leaf_rows, fan, top_nodes = len(feats), leaf_rows or LEAF_ROWS, FAN, TOP_NODES
    got = rows.agg(F.count("*").alias("__n"), *[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 2000).alias(f"q{i}")
                                               for i, f in enumerate(feats)]).first()
    if not got["__n"]:
        return None
    cuts = [np.unique(np.array(got[f"q{i}"] or [], float)) for i in range(d)]

    def coded(it):
        for pdf in it:
            x = pdf[feats].to_numpy(dtype="float64", na_value=np.nan)
            yield pd.DataFrame({"__id": pdf["__id"], "__x": [r.tobytes() for r in x], "__pattern": pattern(x), "__code": morton(x, cuts, wide)})

    laid = (rows.select("__id", *feats).mapInPandas(coded, "__id long, __x binary, __pattern long, __code long")
            .repartitionByRange("__pattern", "__code", "__id").sortWithinPartitions("__pattern", "__code", "__id"))

    def packed(batches):
        from pyspark import TaskContext
        part, seq, ids, xs = TaskContext.get().partitionId(), 0, [], []
        kind = None

        def leaf():
            x = np.frombuffer(b"".join(xs), np.float64).reshape(-1, d)
            has = ~np.isnan(x)
            clean = np.where(has, x, 0.0)
            lo = np.where(has, x, np.inf).min(axis=0)
            hi = np.where(has, x, -np.inf).max(axis=0)
            row = _box(part << 32 | seq, len(ids), has.all(axis=0), has.any(axis=0), lo, hi, has.sum(axis=0), clean.sum(axis=0))
            cols = [pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(row)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([_bytes(ids, np.int64)], pa.binary()), pa.array([_bytes(x, np.float64)], pa.binary())],
                                              [*NODE, "ids", "x"])

        for b in batches:
            for i, x, p in zip(b.column("__id").to_pylist(), b.column("__x").to_pylist(), b.column("__pattern").to_pylist()):
                if ids and (p != kind or len(ids) == leaf_rows):
                    yield leaf()
                    seq, ids, xs = seq + 1, [], []
                kind = p
                ids.append(i)
                xs.append(x)
        if ids:
            yield leaf()

    whole = cut(laid.mapInArrow(packed, BOX + ", ids binary, x binary"))
    boxes, levels = whole.select(*NODE), []
    span = whole.agg(F.max(F.col("node").bitwiseAND(F.lit((1 << 32) - 1)))).first()[0] + 1
    # a level's node numbers are the places of the nodes below it, divided by the fan
    place = F.shiftrightunsigned("node", 32) * span + F.col("node").bitwiseAND(F.lit((1 << 32) - 1))
    while boxes.count() > top_nodes:
        parent = F.floor(place / fan).cast("long")
        kids = boxes.select(parent.alias("parent"), F.struct(*NODE).alias("kid"))
        level = cut(kids.groupBy("parent").agg(F.sort_array(F.collect_list("kid")).alias("kids")))  # ``fan`` children at most
        above = level.mapInPandas(lambda it: _joined(it, d), BOX)
        if level.count() == boxes.count():  # no two nodes are neighbours yet: go on with wider steps
            place = parent
            continue
        levels.insert(0, level)
        boxes, place = cut(above), F.col("node")
    top = boxes_of(boxes.toPandas(), d)  # ``top_nodes`` rows at most
    return Tree(feats, cuts, whole.select("node", "ids", "x"), levels, top, wide)


def _joined(it, d):
    """One box around the children of every parent."""
    for pdf in it:
        out = []
        for parent, kids in zip(pdf["parent"], pdf["kids"]):
            b = kid_boxes(kids, d)
            out.append(_box(parent, int(b.n.sum()), b.every.all(axis=0), b.any.any(axis=0), b.lo.min(axis=0), b.hi.max(axis=0),
                            b.count.sum(axis=0), b.sum.sum(axis=0)))
        yield pd.DataFrame(out, columns=list(NODE))


def kid_boxes(kids, d: int) -> Boxes:
    return boxes_of(pd.DataFrame([k if isinstance(k, dict) else k.asDict() for k in kids]), d)


#: a block of units at a node (null: counted whole): column to fill, rows and state of each unit
BLOCK = "node long, j int, m int, rids binary, x binary, state binary, count binary, sum binary"


def _block(node, j, rids, x, state, count=None, total=None) -> tuple:
    return (node, j, len(rids), _bytes(rids, np.int64), _bytes(x, np.float64), _bytes(state, np.float64),
            None if count is None else _bytes(count, np.float64), None if total is None else _bytes(total, np.float64))


class Units:
    """Units of one column, in arrays."""

    def __init__(self, j: int, rids, x, state):
        self.j, self.rids, self.x, self.state = j, rids, x, state

    def at(self, places):
        return Units(self.j, self.rids[places], self.x[places], self.state[places])


def opened(units: Units, boxes: Boxes, choose):
    """Blocks at the children that ``choose`` opens, and one with what it counts whole."""
    state, wanted, whole = choose(units, boxes)
    units = Units(units.j, units.rids, units.x, state)
    for t in np.flatnonzero(wanted.any(axis=0)):
        u = units.at(np.flatnonzero(wanted[:, t]))
        yield _block(int(boxes.node[t]), u.j, u.rids, u.x, u.state)
    if whole is not None:
        count = np.where(whole, boxes.count[None, :, units.j], 0.0).sum(axis=1)
        total = np.where(whole, boxes.sum[None, :, units.j], 0.0).sum(axis=1)
        at = np.flatnonzero(count > 0)
        if len(at):
            u = units.at(at)
            yield _block(None, u.j, u.rids, u.x, u.state, count[at], total[at])


def _frames(rows):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == 256:
            yield pd.DataFrame(held, columns=[c.split()[0] for c in BLOCK.split(", ")]).astype({"node": "Int64"})
            held = []
    if held:
        yield pd.DataFrame(held, columns=[c.split()[0] for c in BLOCK.split(", ")]).astype({"node": "Int64"})


def descend(tree: Tree, units: DataFrame, width: int, choose_top, choose) -> DataFrame:
    """Blocks at the leaves that the units reach, and blocks counted whole (node null), written.

    ``units``: as of ``units_of_holes``, written, and __s0 ... the state.
    ``choose(units, boxes)`` -> (state, children to open, children to count whole or None).
    """
    spark, d, feats = units.sparkSession, len(tree.feats), tree.feats
    top = spark.sparkContext.broadcast(tree.top)
    states = [f"__s{i}" for i in range(width)]
    tasks = max(spark.sparkContext.defaultParallelism, -(-units.count() // TASK_UNITS))
    order = ["__j", "__pattern", "__code", "__id"]

    def first(it):
        def blocks():
            for pdf in it:
                for j, part in pdf.groupby("__j"):
                    for at in range(0, len(part), UNITS):
                        p = part.iloc[at:at + UNITS]
                        u = Units(int(j), p["__id"].to_numpy(np.int64), p[feats].to_numpy(dtype="float64", na_value=np.nan),
                                  p[states].to_numpy(dtype="float64", na_value=np.nan))
                        yield from opened(u, top.value, choose_top)
        yield from _frames(blocks())

    def deeper(it):
        def blocks():
            for units, boxes in _meetings(it, d, width, lambda r: kid_boxes(r.kids, d)):
                yield from opened(units, boxes, choose)
        yield from _frames(blocks())

    near = units.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    got, counted = cut(near.mapInPandas(first, BLOCK)), []
    for level in tree.levels:
        counted.append(got.where("node IS NULL"))
        got = cut(_dealt(got.where("node IS NOT NULL"), level.withColumnRenamed("parent", "node")).mapInPandas(deeper, BLOCK))
    for c in counted:
        got = got.unionByName(c)
    return got


def _dealt(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes and the blocks that reached them side by side: sorted by node, the node first.

    Nodes that over one part in HOT of all units reached are copied, their blocks dealt to the
    copies; nodes that no block reached are left out before they move."""
    total = blocks.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    share = max(4 * UNITS, total // HOT)
    met = blocks.groupBy("node").agg(F.sum("m").alias("m"))
    heavy = F.broadcast(met.where(F.col("m") > share).select("node", F.ceil(F.col("m") / share).cast("int").alias("copies")))
    spread = F.coalesce("copies", F.lit(1))
    left = (nodes.join(met.select("node"), "node", "left_semi").join(heavy, "node", "left")
            .withColumns({"copy": F.explode(F.sequence(F.lit(0), spread - 1)), "kind": F.lit(0)}).drop("copies"))
    right = (blocks.drop("count", "sum").join(heavy, "node", "left")
             .withColumns({"copy": F.pmod(F.xxhash64("rids"), spread).cast("int"), "kind": F.lit(1)}).drop("copies"))
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_MEETINGS))
    both = left.unionByName(right, allowMissingColumns=True)
    return both.repartition(tasks, "node", "copy").sortWithinPartitions("node", "copy", "kind", "j")


def _meetings(it, d: int, width: int, node_of):
    """(units, node) of rows in the order of ``_dealt``: blocks of one node and column joined, MEET units at a time."""
    def joined(held):
        rids = np.frombuffer(b"".join(r.rids for r in held), np.int64)
        state = np.frombuffer(b"".join(r.state for r in held), np.float64).reshape(len(rids), width)
        return Units(int(held[0].j), rids, np.frombuffer(b"".join(r.x for r in held), np.float64).reshape(-1, d), state)

    node, held, m = None, [], 0
    for pdf in it:
        for r in pdf.itertuples(index=False):
            if held and (r.kind == 0 or r.j != held[0].j or m >= MEET):
                yield joined(held), node
                held, m = [], 0
            if r.kind == 0:
                node = node_of(r)
            else:
                held.append(r)
                m += int(r.m)
    if held:
        yield joined(held), node


def gathered(frames):
    """Small frames as fewer larger ones."""
    held, n = [], 0
    for f in frames:
        if len(f):
            held.append(f)
            n += len(f)
        if n >= OUT_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def scanned(tree: Tree, blocks: DataFrame, width: int, scan, schema: str) -> DataFrame:
    """``scan(units, ids, x) -> DataFrame`` of all blocks with the rows of their leaf; a task holds one
    leaf and a batch of blocks."""
    d = len(tree.feats)

    def run(it):
        leaf = lambda r: (_of(r.ids, np.int64), _of(r.rows, np.float64, d))
        yield from gathered(scan(units, *rows) for units, rows in _meetings(it, d, width, leaf))
    return _dealt(blocks, tree.leaves.withColumnRenamed("x", "rows")).mapInPandas(run, schema)


def units_of_holes(tree: Tree, rec: DataFrame, targets: list[int] | None) -> DataFrame:
    """A unit per missing target of every receiver (or one with __j = -1 per receiver), and its place in
    the order of the tree."""
    feats, cuts, wide = tree.feats, tree.cuts, tree.wide
    j = F.lit(-1) if targets is None else F.explode(F.array_compact(F.array(*[F.when(F.col(feats[t]).isNull(), F.lit(t)) for t in targets])))
    units = rec.select("__id", *feats, j.alias("__j"))

    def place(it):
        for pdf in it:
            x = pdf[feats].to_numpy(dtype="float64", na_value=np.nan)
            yield pdf.assign(__pattern=pattern(x), __code=morton(x, cuts, wide))
    schema = T.StructType([*units.schema.fields, T.StructField("__pattern", T.LongType()), T.StructField("__code", T.LongType())])
    return cut(units.mapInPandas(place, schema))
