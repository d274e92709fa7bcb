"""Hard-negative mining by slot-decomposed selection (operator 13).

An anchor's positives are its best other rows of the same label.  Each positive allows negatives
(rows of another label) with scores from ``low`` to ``high`` per cent of its own, and the windows
of an anchor overlap.  The positives' upper limits, sorted, cut the scores into disjoint slots: a
slot reaches from one limit down to the next, the last one to the lowest lower limit.  A row's
score falls into one slot, so a combiner keeps the best ``k`` of every slot; taking the slots
from the lowest up and merging each into those below gives the best ``k`` under every limit, and of
these a window keeps what is not below its own lower limit.  That is exact: the best k under the
limit contain the best k of the window.

Both passes, positives and slots, meet every anchor with every row, block by block.  Anchors and
rows are dealt to a grid of cells, a cell being some blocks of either, so the number of tasks
grows with both and a cell's size is bounded; a task gets a cell's row blocks and reads its anchor
blocks again for each.  Rows are laid out by label, so in the first pass blocks without a label
in common are passed over.  Lists of a cell are merged by group of cells, then by anchor.

Scores are exact: products of whole doubles while sums stay under 2^53, else integers of any
width, held to the range of a long.

Cases: rows with null label, vector or vec_id, or with a null or non-finite component take no
part; vectors of different length have zeros beyond their end; rows alike in vec_id, label and
vector are one row, and a row of the anchor's own vec_id is no other row; an anchor id with
several vectors or labels is several anchors; a positive whose score is negative allows nothing,
one of zero allows zero; anchors without positives or negatives give no rows; ties go to the
smaller vec_id; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import stash
from lacuna.llm.topk import LONG, lean, matrix
from lacuna.llm.topk import scores as exact_scores

SCALE = 256
ANCHOR_ROWS, BLOCK_ROWS = 256, 4096
CELL_ANCHORS, CELL_BLOCKS = 64, 64
GROUP = 64
HIT = pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())]))
HITS = "array<struct<neg:bigint,vec_id:bigint>>"


def sound_rows(rows: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (whole doubles) of the rows that take part, each once."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return rows.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v")).distinct()


def blocked(rows: DataFrame, size: int, scores_of_positives: bool = False) -> DataFrame:
    """Rows in order of label, ``size`` to a block: ids, labels, akeys and matrix as bytes, and for
    anchors with positives their scores."""
    columns = ["vec_id", "label", "akey", "v"] + ["positives"] * scores_of_positives

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= size:
                t = pa.Table.from_batches(held).combine_chunks()
                for at in range(0, n - n % size, size):
                    yield packed(t.slice(at, size))
                held, n = t.slice(n - n % size).to_batches(), n % size
        if n:
            yield packed(pa.Table.from_batches(held).combine_chunks())

    def packed(t):
        vs = t.column("v").combine_chunks()
        lens = np.diff(vs.offsets.to_numpy())
        dims = int(lens.max(initial=0))
        m = np.zeros((t.num_rows, dims))
        m[np.arange(dims)[None, :] < lens[:, None]] = vs.flatten().to_numpy(zero_copy_only=False)
        got = [pa.array([t.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in ("vec_id", "label", "akey")]
        got += [pa.array([lean(m)], pa.binary()), pa.array([dims], pa.int32())]
        if scores_of_positives:
            got.append(pa.array([[[-h["neg"] for h in hits] for hits in t.column("positives").to_pylist()]], pa.list_(pa.list_(pa.int64()))))
        return pa.RecordBatch.from_arrays(got, ["ids", "labels", "akeys", "m", "dims"] + ["positives"] * scores_of_positives)

    laid = rows.select(*columns).repartitionByRange("label", "vec_id").sortWithinPartitions("label", "vec_id")
    return laid.mapInArrow(run, "ids binary, labels binary, akeys binary, m binary, dims int" + ", positives array<array<long>>" * scores_of_positives)


class Block:
    """A block back in arrays; labels ascend."""

    def __init__(self, r: dict):
        self.ids, self.labels, self.akeys = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels", "akeys"))
        self.m = matrix(r["m"], len(self.ids), r["dims"])
        self.positives = r.get("positives")

    def meets(self, other: Block) -> bool:
        return self.labels[0] <= other.labels[-1] and other.labels[0] <= self.labels[-1]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(dims, 1) < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return exact_scores(a, b)


def first(group, score, ids, k):
    """Places of the best k entries of each group, ties to the smaller id; groups ascend."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[rank < k]


def best_positives(a: Block, b: Block, k: int):
    """(anchor place, score, id) of the best k rows of b with the anchor's label."""
    if not a.meets(b):
        return None
    s = products(a.m, b.m)
    fit = (a.labels[:, None] == b.labels[None, :]) & (a.ids[:, None] != b.ids[None, :])
    if len(b.ids) > k:
        low = np.where(fit, s, LONG.min)
        fit &= s >= np.partition(low, len(b.ids) - k, axis=1)[:, len(b.ids) - k][:, None]
    at, col = np.nonzero(fit)
    score, ids = s[at, col], b.ids[col]
    keep = first(at, score, ids, k)
    return at[keep], score[keep], ids[keep]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole score between ``low`` and ``high`` per cent of a positive's score."""
    return -(-low * score // 100), high * score // 100


def slots(scores: list[int], low: int, high: int) -> tuple[list[int], int]:
    """Distinct upper limits, descending, and the least lower limit of the windows that hold a number."""
    fit = [(lo, up) for lo, up in (window(p, low, high) for p in scores) if lo <= up]
    return sorted({up for _, up in fit}, reverse=True), min((lo for lo, _ in fit), default=0)


def best_per_slot(a: Block, b: Block, k: int, low: int, high: int):
    """(anchor place * slots + slot, score, id) of the best k rows of b with another label per slot."""
    cuts = [slots(p, low, high) for p in a.positives]
    most = max((len(c) for c, _ in cuts), default=0)
    if most == 0 or (a.labels[0] == b.labels[-1] and a.labels[-1] == b.labels[0]):
        return None
    limits = np.array([c + [LONG.min] * (most - len(c)) for c, _ in cuts], np.int64)
    least = np.array([lo if c else LONG.max for c, lo in cuts], np.int64)
    s = products(a.m, b.m)
    at, col = np.nonzero((s <= limits[:, :1]) & (s >= least[:, None]) & (a.labels[:, None] != b.labels[None, :]))
    score, ids = s[at, col], b.ids[col]
    group = at * most + (limits[at] >= score[:, None]).sum(axis=1) - 1
    keep = first(group, score, ids, k)
    return group[keep], score[keep], ids[keep], most


LISTS = f"anchor_id long, akey long, slot int, j int, hits {HITS}"


def met(anchors: DataFrame, rows: DataFrame, select, k: int) -> DataFrame:
    """Per anchor and slot the best k entries that ``select`` finds in the blocks of rows."""
    spark = rows.sparkSession
    n_a, n_b = anchors.count(), rows.count()
    ra = max(1, -(-n_a // CELL_ANCHORS))
    rb = max(1, -(-n_b // CELL_BLOCKS), min(n_b, -(-2 * spark.sparkContext.defaultParallelism // ra)))

    def dealt(df, own, parts, other, copies):
        return (df.withColumn(own, F.pmod(F.xxhash64("ids", "akeys"), F.lit(parts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))

    def cell(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in LIST_TYPES}, LIST_TYPES)
        blocks = [Block(r) for r in right.to_pylist()]
        out = {c: [] for c in ("anchor_id", "akey", "slot", "j", "hits")}
        for r in left.to_pylist():
            a = Block(r)
            got = [g for g in (select(a, b) for b in blocks) if g is not None]
            if not got:
                continue
            most = got[0][3] if len(got[0]) == 4 else 1
            group, score, ids = (np.concatenate([g[n] for g in got]) for n in range(3))
            keep = first(group, score, ids, k)
            group, score, ids = group[keep], score[keep], ids[keep]
            for part in np.split(np.arange(len(group)), np.flatnonzero(group[1:] != group[:-1]) + 1) if len(group) else ():
                place, slot = divmod(int(group[part[0]]), most)
                out["anchor_id"].append(int(a.ids[place]))
                out["akey"].append(int(a.akeys[place]))
                out["slot"].append(slot)
                out["j"].append(key[1].as_py())
                out["hits"].append([{"neg": -int(score[n]), "vec_id": int(ids[n])} for n in part])
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in LIST_TYPES}, LIST_TYPES)

    lists = (dealt(anchors, "i", ra, "j", rb).groupBy("i", "j").cogroup(dealt(rows, "j", rb, "i", ra).groupBy("i", "j"))
             .applyInArrow(cell, LISTS))
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")
    if rb > GROUP:  # many lists per anchor are merged in two steps
        lists = lists.groupBy("anchor_id", "akey", "slot", F.expr(f"j div {GROUP}").alias("j")).agg(merged)
    return lists.groupBy("anchor_id", "akey", "slot").agg(merged)


LIST_TYPES = pa.schema([("anchor_id", pa.int64()), ("akey", pa.int64()), ("slot", pa.int32()), ("j", pa.int32()), ("hits", HIT)])
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = 5, n_negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and
    positive its first ``n_negatives`` negatives between ``low`` and ``high`` per cent."""
    if not 0 <= low <= high:
        raise ValueError("0 <= low <= high is needed")
    label = F.col("label") if label is None else label
    v = stash(sound_rows(rows, label).withColumn("akey", F.xxhash64("label", "v")))
    asks = v.filter(is_anchor)
    laid = stash(blocked(v, BLOCK_ROWS))
    positives = stash(met(stash(blocked(asks, ANCHOR_ROWS)), laid, lambda a, b: best_positives(a, b, n_positives), n_positives)
                      .select(F.col("anchor_id").alias("vec_id"), "akey", F.col("hits").alias("positives")))
    with_positives = asks.join(positives, ["vec_id", "akey"])
    found = met(stash(blocked(with_positives, ANCHOR_ROWS, True)), laid, lambda a, b: best_per_slot(a, b, n_negatives, low, high), n_negatives)
    per_anchor = (found.groupBy("anchor_id", "akey").agg(F.collect_list(F.struct("slot", "hits")).alias("slots"))
                  .join(positives.withColumnRenamed("vec_id", "anchor_id"), ["anchor_id", "akey"]))

    def windows(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                limits, _ = slots([-h["neg"] for h in r["positives"]], low, high)
                held = {s["slot"]: s["hits"] for s in r["slots"]}
                under, best = {}, []
                for n in range(len(limits) - 1, -1, -1):  # all of a slot score above all below it
                    best = (held.get(n, []) + best)[:n_negatives]
                    under[limits[n]] = best
                for h in r["positives"]:
                    lo, up = window(-h["neg"], low, high)
                    fit = [x for x in under.get(up, ()) if -x["neg"] >= lo] if lo <= up else ()
                    out += [(r["anchor_id"], h["vec_id"], n + 1, x["vec_id"], -h["neg"], -x["neg"]) for n, x in enumerate(fit)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], t) for n, t in enumerate(kinds)],
                                             [c.split()[0] for c in RESULT.split(", ")])

    return per_anchor.select("anchor_id", "positives", "slots").mapInArrow(windows, RESULT)
