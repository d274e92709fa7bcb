"""Exact top-k inner products by exhaustive term-at-a-time accumulation (operator 5).

A vector component is a term, its integer value the weight.  Candidates are cut into blocks; a
block is laid out by term as postings (places and weights of its non-zero components).  A block
of queries meets a block of candidates, and for each term the weights of the queries that have
it are scattered, times the posting's weights, into a dense (queries x candidates) array of
scores.  A partition of that array yields each query's best k; per lane of candidate blocks the
best k are carried along, and the lanes' lists are merged, by groups of lanes first where there are many.

A task has one lane of candidate blocks and one group of query blocks, ``LANE_BLOCKS`` and
``GROUP_BLOCKS`` of them, so tasks follow both tables and their size does not.

Scores are exact: 64-bit integers when the largest components allow, Python integers otherwise;
a score beyond a long is held to its range, and ranks follow the scores so held.  Every query meets every candidate; no pair is left out.

Cases: vectors null or with null or non-finite components take no part, nor do rows without a
vec_id; vectors of different length have zeros beyond their end; rows alike in vec_id and vector
are one row; a query's own vec_id is no candidate of it; ties go to the smaller vec_id; fewer
than k candidates give fewer rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import stash

SCALE = 64
QUERY_ROWS = 256
BLOCK_ROWS = 2048
#: lanes for few blocks, so that small tables are shared out too
LANES = 64
LANE_BLOCKS, GROUP_BLOCKS = 64, 64
#: lists of one query that are merged at once
MERGED_LANES = 64
LONG = np.iinfo(np.int64)


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of whole doubles) of the vectors that take part, each once."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return rows.filter(sound).select("vec_id", v.alias("v")).distinct()


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed ``size`` at a time: ids and a dense (rows x dims) matrix of doubles as bytes."""
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
            yield packed(pa.Table.from_batches(held))

    def packed(t):
        ids = t.column("vec_id").to_numpy().astype(np.int64)
        vs = t.column("v").combine_chunks()
        lens = np.diff(vs.offsets.to_numpy())
        dims = int(lens.max(initial=0))
        m = np.zeros((len(ids), dims))
        m[np.arange(dims)[None, :] < lens[:, None]] = vs.flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[order].tobytes()], pa.binary()), pa.array([lean(m[order])], pa.binary()), pa.array([dims], pa.int32())],
            ["ids", "m", "dims"])

    return rows.mapInArrow(run, "ids binary, m binary, dims int")


def lean(m: np.ndarray) -> bytes:
    """The matrix as bytes, 16-bit when all components fit."""
    return m.astype(np.int16 if np.abs(m).max(initial=0.0) < 2 ** 15 else np.float64).tobytes()


def matrix(raw: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if len(raw) == 2 * rows * dims else np.float64).reshape(rows, dims).astype(np.float64)


def whole(m: np.ndarray, most: float) -> np.ndarray:
    """Whole doubles as integers wide enough for sums bounded by ``most``."""
    if most < 2 ** 30:
        return m.astype(np.int32)
    if most < 2 ** 52:
        return m.astype(np.int64)
    return np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of all rows of q and c, one term at a time."""
    dims = min(q.shape[1], c.shape[1])
    top = np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) * max(dims, 1)
    qi, postings = whole(q[:, :dims], top), whole(c[:, :dims], top).T.copy()
    out = np.zeros((len(q), len(c)), qi.dtype)
    for term in range(dims):
        have, at = np.flatnonzero(qi[:, term]), np.flatnonzero(postings[term])
        if not len(have) or not len(at):
            continue
        w = postings[term]
        if 2 * len(at) >= len(w) and 2 * len(have) >= len(out):  # dense on both sides: zeros add nothing
            out += qi[:, term, None] * w
        else:
            out[np.ix_(have, at)] += qi[have, term, None] * w[at]
    if out.dtype == object:
        out = np.array([[max(-LONG.max, min(LONG.max, x)) for x in row] for row in out], np.int64).reshape(out.shape)
    return out


def best(score, ids, qids, k):
    """Per query (scores, ids) of its k best; ids ascend along the columns, so of equal scores
    the first columns win."""
    out = []
    for row, own in zip(score, qids):
        row, cand = (row[ids != own], ids[ids != own]) if own in ids else (row, ids)
        if len(row) > k:
            low = np.partition(row, len(row) - k)[len(row) - k]
            above = np.flatnonzero(row > low)
            at = np.concatenate((above, np.flatnonzero(row == low)[:k - len(above)]))
        else:
            at = np.arange(len(row))
        out.append((row[at], cand[at]))
    return out


HITS = "lane long, qkey long, query_id long, hits array<struct<neg:long,vec_id:long>>"


def search(rows: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for every row where ``is_query`` holds, against all rows."""
    v = stash(quantised(rows))
    deal = F.xxhash64("vec_id")
    cand = stash(blocks(v.repartition(deal), BLOCK_ROWS))
    asks = stash(blocks(v.filter(is_query).repartition(deal), QUERY_ROWS).withColumn("qb", F.xxhash64("ids", "m")))
    n_cand, n_asks = cand.count(), asks.count()
    lanes = max(1, min(n_cand, LANES), -(-n_cand // LANE_BLOCKS))
    groups = max(1, -(-n_asks // GROUP_BLOCKS))

    def copies(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # the merge join gives all candidate blocks of a lane for one query block after another, so a
    # query block's best are carried along; any other order is right too and emits more lists
    pairs = (asks.select(F.col("ids").alias("qids"), F.col("m").alias("qm"), F.col("dims").alias("qdims"), "qb")
             .withColumn("qg", F.pmod("qb", F.lit(groups))).withColumn("lane", copies(lanes))
             .join(cand.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes))).withColumn("qg", copies(groups)).hint("merge"), ["lane", "qg"]))

    def run(batches):
        now, held = None, None
        for b in batches:
            for r in (b.slice(n, 1).to_pylist()[0] for n in range(b.num_rows)):
                key = (r["lane"], r["qb"])
                qids = np.frombuffer(r["qids"], np.int64)
                ids = np.frombuffer(r["ids"], np.int64)
                q = matrix(r["qm"], len(qids), r["qdims"])
                got = best(scores(q, matrix(r["m"], len(ids), r["dims"])), ids, qids, k)
                if key != now:
                    if held:
                        yield out(now, *held)
                    now, held = key, (qids, got, q)
                else:
                    held = (qids, [merged(x, y) for x, y in zip(held[1], got)], q)
        if held:
            yield out(now, *held)

    def merged(x, y):
        s, i = np.concatenate((x[0], y[0])), np.concatenate((x[1], y[1]))
        at = sorted(range(len(s)), key=lambda p: (-int(s[p]), int(i[p])))[:k]
        return s[at], i[at]

    def out(key, qids, got, q):
        import xxhash
        # a query is its id and vector: ids that repeat with other vectors stay apart
        keys = [xxhash.xxh64_intdigest(q[n].tobytes()) - 2 ** 63 for n in range(len(qids))]
        hits = [[{"neg": -int(s), "vec_id": int(i)} for s, i in zip(*g)] for g in got]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(qids), pa.array(hits, pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())])))],
            ["lane", "qkey", "query_id", "hits"])

    lists = pairs.select("lane", "qb", "qids", "qm", "qdims", "ids", "m", "dims").mapInArrow(run, HITS)
    merge = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k)
    if lanes > MERGED_LANES:
        lists = lists.groupBy("query_id", "qkey", F.expr(f"lane div {MERGED_LANES}").alias("lane")).agg(merge.alias("hits"))
    top = lists.groupBy("query_id", "qkey").agg(merge.alias("h"))
    return (top.select("query_id", F.posexplode("h"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", (-F.col("col.neg")).alias("score")))
