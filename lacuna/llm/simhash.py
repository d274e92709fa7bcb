"""SimHash near-duplicates by a Gray-order hierarchical index (operator 1).

Fingerprints that differ in at most ``radius`` of 64 bits are linked.  The bits are cut into
blocks; by the pigeonhole principle two linked fingerprints agree on ``match`` of them, so each
distinct fingerprint is entered once per choice of ``match`` blocks, with those bits in front.
Every such table is range-partitioned and sorted by the rank of its codes in the reflected Gray
code, which lays codes with equal leading bits side by side.  Runs of equal leading bits are cut
into nodes of at most ``NODE`` codes; a node keeps the bits its codes share (mask and value),
its sub-groups the bits they share, and a search descends from pairs of groups to pairs of
codes, leaving out every pair of groups whose shared bits already differ too often.  Runs that
were cut (hot keys, edges of partitions) meet again node by node: nodes of one key are joined
when their shared patterns allow a link.

A node emits only a spanning star of what it links, never all pairs; components come from
alternating large-star and small-star rounds over written tables.  Exact copies share one
fingerprint, so they are one entry from the start.

The number of blocks follows the number of distinct fingerprints (more bits per key for more
fingerprints); any choice finds the same links.

Cases: null and empty texts have fingerprint zero and are linked like any other; ties and
repeated rows share a component; component_id is null only if no row of it has a doc_id; an
empty table gives no rows; extra columns are not read by ``near_duplicates``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import stash

BITS = 64
NODE = 1024
SEED = 42
#: group sizes of the tree inside a node, from the top
LEVELS = (256, 32, 1)
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of the word shingles (repeats count) of a UTF-8 text."""
    ws = text.lower().split()  # on bytes: lower-cases A-Z, splits at ASCII white space
    if not ws:
        return 0
    joined = b" ".join(ws)
    m = len(ws) - shingle + 1
    if m <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:m].tolist(), ends[shingle - 1:].tolist())), np.uint64, m)
    octets = h.view(np.uint8).reshape(m, 8)
    if m < 200:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        seen = np.bincount((octets + np.arange(0, 2048, 256)).ravel(), minlength=2048).reshape(8, 256)
        ones = (seen @ _BIT).ravel()
    return int(np.packbits(2 * ones > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, keep: list[str]) -> DataFrame:
    """``keep`` columns and fp (signed 64 bits) of every row of ``docs``."""
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches):
        for b in batches:
            texts = b.column("__text").cast(pa.binary())
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                fps = np.array([fingerprint(t or b"", shingle) for t in texts.slice(at, 256).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(fps)], [*keep, "fp"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray code (prefix XOR of its bits)."""
    r = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def gray_code(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def block_plan(n: int, radius: int) -> tuple[int, int]:
    """(blocks, match): the coarsest cut whose keys hold about 64 of ``n`` even fingerprints."""
    for match in range(1, 5):
        bits = BITS * match // (radius + match)
        if n <= 64 << bits:
            break
    return radius + match, match


def tables(blocks: int, match: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Per table: bit ranges (from, to) in their new order, and the number of leading bits that
    make the key."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    ranges = list(zip(edges, edges[1:]))
    out = []
    for lead in combinations(range(blocks), match):
        order = [ranges[i] for i in lead] + [r for i, r in enumerate(ranges) if i not in lead]
        out.append((order, sum(ranges[i][1] - ranges[i][0] for i in lead)))
    return out


def permuted(code: np.ndarray, order) -> np.ndarray:
    """The bit ranges of ``code`` laid out from the top in the given order."""
    out, at = np.zeros_like(code), BITS
    for lo, hi in order:
        at -= hi - lo
        out |= ((code >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)) << np.uint64(at)
    return out


def groups(codes: np.ndarray, size: int):
    """Shared pattern of each run of ``size`` codes: (value, mask of the bits they share)."""
    at = np.arange(0, len(codes), size)
    every, some = np.bitwise_and.reduceat(codes, at), np.bitwise_or.reduceat(codes, at)
    return every, ~(every ^ some)


def linked_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool):
    """Index pairs of codes within the radius, by descent through both trees."""
    i = j = None
    for k, size in enumerate(LEVELS):
        (va, ma), (vb, mb) = groups(a, size), groups(b, size)
        if i is None:
            i, j = np.divmod(np.arange(len(va) * len(vb)), len(vb))
        else:
            f = LEVELS[k - 1] // size
            ci = (i[:, None, None] * f + np.arange(f)[None, :, None])
            cj = (j[:, None, None] * f + np.arange(f)[None, None, :])
            ci, cj = np.broadcast_arrays(ci, cj)
            i, j = ci.ravel(), cj.ravel()
            ok = (i < len(va)) & (j < len(vb))
            i, j = i[ok], j[ok]
        if same:
            ok = i < j if size == 1 else i <= j
            i, j = i[ok], j[ok]
        near = np.bitwise_count((va[i] ^ vb[j]) & ma[i] & mb[j]) <= radius
        i, j = i[near], j[near]
    return i, j


def star(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index reachable from each of n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _edges(codes: np.ndarray, i, j):
    root = star(len(codes), i, j)
    at = np.flatnonzero(root != np.arange(len(codes)))
    return codes[at].view(np.int64), codes[root[at]].view(np.int64)


NODE_SCHEMA = "a long, b long, t int, key long, node long, value long, mask long, codes binary"


def _index(radius: int, plan):
    """mapInArrow over rows (t, rank) sorted by both: links inside nodes, and the nodes of runs
    that were cut."""
    def flush(t, key, bits, ranks, cut, out):
        if len(ranks) < 2 and not cut:
            return
        order = plan[t][0]
        cut = cut or len(ranks) > NODE
        for at in range(0, len(ranks), NODE):
            r = ranks[at:at + NODE]
            # linking works on the permuted codes (distances are the same); results are restored
            codes = restored(gray_code(r), order)
            if len(codes) > 1:
                if len(codes) <= 64:
                    d = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
                    i, j = np.nonzero(np.triu(d, 1))
                else:
                    i, j = linked_pairs(codes, codes, radius, True)
                if len(i):
                    x, y = _edges(codes, i, j)
                    out["a"].append(x)
                    out["b"].append(y)
            if cut:
                (v,), (m,) = groups(codes, len(codes))
                out["nodes"].append((t, int(key), int(r[:1].view(np.int64)[0]), int(v.view(np.int64)), int(m.view(np.int64)), codes.tobytes()))

    def emit(out):
        a = np.concatenate(out["a"]) if out["a"] else np.zeros(0, np.int64)
        b = np.concatenate(out["b"]) if out["b"] else np.zeros(0, np.int64)
        nodes, n, k = out["nodes"], len(a), len(out["nodes"])
        cols = list(zip(*nodes)) if k else [[]] * 6
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(k, pa.int64())]) for x in (a, b)]
        arrays += [pa.concat_arrays([pa.nulls(n, ty), pa.array(list(c), ty)]) for c, ty in zip(cols, types)]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "t", "key", "node", "value", "mask", "codes"])

    def run(batches):
        held, held_t, held_key, first = [], None, None, True
        out = {"a": [], "b": [], "nodes": []}
        for batch in batches:
            ts = batch.column("t").to_numpy()
            rank = batch.column("r").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
            bits = np.array([p[1] for p in plan])[ts]
            keys = rank >> (np.uint64(BITS) - bits.astype(np.uint64))
            edge = np.flatnonzero((np.diff(ts) != 0) | (np.diff(keys) != 0)) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(ts)]):
                if hi == lo:
                    continue
                t, key = int(ts[lo]), keys[lo]
                if held and (t != held_t or key != held_key):
                    flush(held_t, held_key, None, np.concatenate(held), first, out)
                    held, first = [], False
                held_t, held_key = t, key
                held.append(rank[lo:hi])
                size = sum(map(len, held))
                while size >= 8 * NODE:  # a long run leaves in nodes; it has been cut
                    ranks = np.concatenate(held)
                    flush(t, key, None, ranks[:4 * NODE], True, out)
                    held, size, first = [ranks[4 * NODE:]], size - 4 * NODE, True
            if len(out["nodes"]) > 64 or len(out["a"]) > 512:
                yield emit(out)
                out = {"a": [], "b": [], "nodes": []}
        if held:
            flush(held_t, held_key, None, np.concatenate(held), True, out)
        yield emit(out)

    return run


def restored(code: np.ndarray, order) -> np.ndarray:
    """Inverse of ``permuted``."""
    out, at = np.zeros_like(code), BITS
    for lo, hi in order:
        at -= hi - lo
        out |= ((code >> np.uint64(at)) & np.uint64((1 << (hi - lo)) - 1)) << np.uint64(lo)
    return out


def _across(radius: int):
    """mapInArrow over pairs of nodes: a spanning star of the links between the two."""
    def run(batches):
        for batch in batches:
            xs, ys = [], []
            for p, q in zip(batch.column("codes").to_pylist(), batch.column("codes2").to_pylist()):
                a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                i, j = linked_pairs(a, b, radius, False)
                if len(i):
                    x, y = _edges(np.concatenate((a, b)), i, j + len(a))
                    xs.append(x)
                    ys.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for v in (xs, ys)], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int, blocks_match: tuple[int, int] | None = None) -> DataFrame:
    """``fps``: one row per distinct fingerprint (fp).  Edges (a, b) that connect everything
    within the radius, directly or by way of other edges."""
    plan = tables(*(blocks_match or block_plan(fps.count(), radius)))

    def enter(batches):
        for b in batches:
            code = b.column("fp").to_numpy().view(np.uint64)
            for t, (order, _) in enumerate(plan):
                r = gray_rank(permuted(code, order)) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), t, np.int32)), pa.array(r.view(np.int64))], ["t", "r"])

    entries = fps.select("fp").mapInArrow(enter, "t int, r long").repartitionByRange("t", "r").sortWithinPartitions("t", "r")
    found = stash(entries.mapInArrow(_index(radius, plan), NODE_SCHEMA))
    nodes = found.filter("codes is not null")
    other = nodes.select("t", "key", F.col("node").alias("node2"), F.col("value").alias("value2"), F.col("mask").alias("mask2"),
                         F.col("codes").alias("codes2"))
    shared = F.col("value").bitwiseXOR(F.col("value2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2"))
    pairs = nodes.join(other, ["t", "key"]).filter((F.col("node") < F.col("node2")) & (F.bit_count(shared) <= radius))
    cross = pairs.select("codes", "codes2").mapInArrow(_across(radius), "a long, b long")
    return found.filter("a is not null").select("a", "b").unionAll(cross)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``: alternating stars until nothing changes."""
    def lean(e):
        return stash(e.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    e, mark = lean(edges), None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        big = e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
        e2 = lean(big.select(F.col("w").alias("a"), F.col("m").alias("b")))
        least = stash(e2.groupBy("u").agg(F.min("v").alias("m")))
        small = e2.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        e = lean(small.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def classes(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) per distinct fingerprint of ``rows`` (doc_id, fp)."""
    first = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = components(links(first, radius))
    named = stash(first.join(roots, first.fp == roots.node, "left")
                  .select("fp", "doc_id", F.coalesce("root", "fp").alias("root")))
    ids = stash(named.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return stash(named.select("fp", "root").join(ids, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    rows = stash(fingerprints(docs, shingle, ["doc_id"]))
    of = classes(rows, radius)
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one of least doc_id (nulls last), then of
    least text hash; of rows equal in both, one."""
    src = docs.select(F.struct("*").alias("__row"), "doc_id", F.xxhash64("text").alias("h"))
    rows = stash(fingerprints(docs.select("doc_id", F.xxhash64("text").alias("h"), "text"), shingle, ["doc_id", "h"])
                 .groupBy("doc_id", "h", "fp").agg(F.count("*").alias("n")))
    first = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = components(links(first, radius))
    named = rows.join(stash(first.join(roots, first.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))), "fp")
    best = stash(named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "n")).alias("k"))
                 .select(F.col("k.doc_id").alias("bd"), F.col("k.h").alias("bh"), F.col("k.n").alias("bn")))
    kept = src.join(best, src["doc_id"].eqNullSafe(F.col("bd")) & (src["h"] == F.col("bh")))
    if best.filter("bn > 1").isEmpty():
        return kept.select("__row.*")
    again = kept.filter("bn > 1").dropDuplicates(["bd", "bh"])
    return kept.filter("bn = 1").select("__row.*").unionAll(again.select("__row.*"))
