"""Prefix trie of conversations by truncation peeling (operator 12).

A conversation is the sequence of its turns; each distinct sequence of first d turns is a node
of depth d.  Peeling starts at the greatest depth.  The nodes of a level are the surviving
nodes of the level below, with their last turn stripped, merged with the conversations that end
here; regrouping adds members, children, leaves and saved tokens up while it finds the nodes, so
every level is one partially aggregated grouping, and a prefix that a third of all conversations
share is no more work than any other.

Only digests move: a turn is a 16-byte digest of role and text and its number of words, a prefix
is the chain of its turns' digests.  Equal conversations are folded into one entry (smallest id,
count) before the first level.  Deep levels hold few nodes, and a level each would be a job each;
so below ``base`` turns the entries are grouped by their first ``base`` turns, and a group of at
most ``local_turns`` turns in all is peeled by one task, level by level in the same way.  Groups above
that size are cut again at twice the depth, and what lies between is peeled level by level on
Spark; the sizes come from a count, and no answer depends on them (tested).

A node's children learn its id by a join in which parents of very many children are broadcast
(``common.lookup``).  The ids that end in a node are range-partitioned by (node, id), joined to
runs of at most 1,024 and streamed in order through SHA-256, so a hot node costs memory for one
batch.

Cases: turns are ordered by turn, null first, then by role and text digest, repeated rows are
turns of their own; null role and text are empty; rows with a null conv_id take no part; an
empty table gives no node, not even the root; extra columns are not read.  A conversation's turn
digests (not its texts) are gathered in one row.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import lookup, n_words, stash

BASE = 8
LOCAL_TURNS = 400_000
RUN = 1024
PATH = "array<struct<id:binary,w:long>>"
NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_lists(rows: DataFrame) -> DataFrame:
    """conv_id, turns: array of (digest of role and text, words of the text) in order."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    both = F.concat(F.length(role).cast("string"), F.lit("|"), role, text)
    turn = F.struct("turn", role.alias("role"), F.unhex(F.md5(text.cast("binary"))).alias("tie"),
                    F.unhex(F.md5(both.cast("binary"))).alias("digest"), n_words(F.col("text")).alias("w"))
    got = (rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
           .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")))
    return got.select("conv_id", F.transform("t", lambda x: F.struct(x["digest"].alias("digest"), x["w"].alias("w"))).alias("turns"))


def rebuilt(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % every, where
    h = crc32(decimal c) % most; then its own turns after its first h."""
    head = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("source"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = lists.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("source"), h.alias("h"), "turns")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.join(head, "source", "left").select(
        "conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<struct<digest:binary,w:long>>")), own).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """conv_id, path: for each depth the id of the prefix (digest chain) and the words of its last turn."""
    kind = pa.list_(pa.struct([("id", pa.binary()), ("w", pa.int64())]))

    def chain(turns):
        at, out = b"", []
        for t in turns:
            at = hashlib.blake2b(at + t["digest"], digest_size=16).digest()
            out.append({"id": at, "w": t["w"]})
        return out

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array([chain(t) for t in b.column("turns").to_pylist()], kind)], ["conv_id", "path"])

    return lists.mapInArrow(run, f"conv_id long, path {PATH}")


#: what a node carries up, besides its path
STATE = ("conv", "n_convs", "n_children", "n_leaves", "saved_tokens")


def grown(rows: DataFrame) -> DataFrame:
    """Nodes of one level from stripped children and ended conversations (path and STATE).

    A node counts as its own leaf when no child came up, and adds its own saving: all members
    but one share its last turn.
    """
    w = F.when(F.size("path") > 0, F.element_at("path", -1)["w"]).otherwise(0)
    return (rows.groupBy("path").agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in STATE[1:]))
            .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
            .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * w))


def stripped(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn: each is one child of the node that is left."""
    return nodes.withColumn("path", F.slice("path", F.lit(1), F.size("path") - 1)).withColumn("n_children", F.lit(1).cast("long"))


def as_nodes(level: DataFrame) -> DataFrame:
    depth = F.size("path")
    return level.select(F.when(depth > 0, F.element_at("path", -1)["id"]).otherwise(F.lit(b"")).alias("id"),
                        F.when(depth > 1, F.get("path", depth - 2)["id"]).when(depth == 1, F.lit(b"")).alias("parent"), depth.alias("depth"), *STATE)


def peel_locally(entries: DataFrame, base: int) -> DataFrame:
    """Nodes deeper than ``base`` of entries whose groups of equal first ``base`` turns fit in a task;
    rows with a path are the top level again, stripped to ``base`` turns, for the levels above."""
    def run(key, table):
        rows = table.to_pylist()
        ended: dict[int, list] = {}
        for r in rows:
            ended.setdefault(len(r["path"]), []).append(r)
        # live: prefix id -> [path, conv, n_convs, n_children, n_leaves, saved]
        live: dict[bytes, list] = {}
        ids, parents, depths, states = [], [], [], []
        for depth in range(max(ended), base, -1):
            for r in ended.get(depth, ()):
                merge(live, r["path"][-1]["id"], [r["path"], r["conv"], r["n_convs"], 0, 0, 0])
            above: dict[bytes, list] = {}
            for node, (path, conv, n, children, leaves, saved) in live.items():
                leaves, saved = leaves or 1, saved + (n - 1) * path[depth - 1]["w"]
                ids.append(node)
                parents.append(path[depth - 2]["id"] if depth > 1 else b"")
                depths.append(depth)
                states.append((conv, n, children, leaves, saved))
                merge(above, parents[-1], [path, conv, n, 1, leaves, saved])
            live = above
        top = [v for v in live.values()]
        cols = list(zip(*states)) if states else [()] * 5
        kind = pa.list_(pa.struct([("id", pa.binary()), ("w", pa.int64())]))
        none = len(top)
        return pa.table({
            "id": pa.array(ids + [None] * none, pa.binary()), "parent": pa.array(parents + [None] * none, pa.binary()),
            "depth": pa.array(depths + [base] * none, pa.int32()), "path": pa.array([None] * len(ids) + [v[0][:base] for v in top], kind),
            **{c: pa.array(list(cols[i]) + [v[i + 1] for v in top], pa.int64()) for i, c in enumerate(STATE)}})

    def merge(level, node, new):
        old = level.get(node)
        if old is None:
            level[node] = new
        else:
            level[node] = [old[0], min(old[1], new[1]), *(a + b for a, b in zip(old[2:], new[2:]))]

    return (entries.withColumn("at", F.get("path", F.lit(base - 1))["id"]).groupBy("at")
            .applyInArrow(run, f"id binary, parent binary, depth int, path {PATH}, " + ", ".join(f"{c} long" for c in STATE)))


def sized(entries: DataFrame, base: int, local_turns: int) -> list[tuple[int, DataFrame, DataFrame | None]]:
    """(cut depth, entries to peel locally below it, entries of groups too large for that), shallow
    first; what is too large at one depth is cut again at twice the depth.  Entries of at most
    ``base`` turns are in none."""
    out, rest, cut = [], entries, base
    while True:
        deep = rest.filter(F.size("path") > cut).withColumn("at", F.get("path", F.lit(cut - 1))["id"])
        big = stash(deep.groupBy("at").agg(F.sum(F.size("path")).alias("turns"), F.count("*").alias("n"))
                    .filter(F.col("turns") > local_turns).select("at", "n", F.lit(True).alias("big")))
        if big.isEmpty():
            out.append((cut, deep.drop("at"), None))
            return out
        met = lookup(deep, big, "at", "n")
        rest = stash(met.filter("big").select(*entries.columns))
        out.append((cut, met.filter(F.col("big").isNull()).select(*entries.columns), rest))
        cut *= 2


def trie(lists: DataFrame, base: int = BASE, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (over the ids of the conversations that end there)."""
    members = stash(paths(lists))
    zero = F.lit(0).cast("long")
    entries = stash(members.groupBy("path").agg(F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"))
                    .select("path", "conv", "n_convs", *(zero.alias(c) for c in STATE[2:])))
    found, level, below = [], None, None
    for cut, local, large in reversed(sized(entries, base, local_turns)):
        if below is not None:  # the levels between this cut and the one below it
            level, nodes = peel(large.filter(F.size("path") <= below), level, below, cut)
            found += nodes
        peeled = stash(peel_locally(local, cut))
        found.append(peeled.filter(F.col("path").isNull()).select("id", "parent", "depth", *STATE))
        top = peeled.filter(F.col("path").isNotNull()).select("path", *STATE)
        level, below = top if level is None else top.unionByName(level), cut
    _, nodes = peel(entries.filter(F.size("path") <= base), level, base, -1)
    return told(stash(reduce(DataFrame.unionByName, found + nodes)), members)


def peel(ended: DataFrame, level: DataFrame, top: int, bottom: int):
    """Levels ``top`` down to ``bottom`` + 1 from ended entries and the rows stripped to ``top`` turns.

    Returns the rows stripped to ``bottom`` turns and the nodes found.
    """
    found = []
    for depth in range(top, bottom, -1):
        here = stash(grown(level.unionByName(ended.filter(F.size("path") == depth))))
        found.append(as_nodes(here))
        if depth:
            level = stripped(here)
    return level, found


def told(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes with their parent's conv_id and the digest of the ids that end in them."""
    parents = stash(nodes.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv_id"),
                                                          F.col("n_children").alias("n")))
    end = F.when(F.size("path") > 0, F.element_at("path", -1)["id"]).otherwise(F.lit(b""))
    ends = ended_digests(members.select(end.alias("id"), "conv_id"))
    return (lookup(nodes, parents, "parent", "n").join(ends, "id", "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", *STATE[1:],
                    F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256")))


def ended_digests(ends: DataFrame) -> DataFrame:
    """id, ends_sha256: SHA-256 of the decimal conv_ids of each id, ascending, comma-joined."""
    def runs(batches):
        now, first, held = None, None, []
        for b in batches:
            for node, conv in zip(b.column("id").to_pylist(), b.column("conv_id").to_pylist()):
                if node != now or len(held) == RUN:
                    if held:
                        yield out(now, first, ",".join(held))
                    now, first, held = node, conv, []
                held.append(str(conv))
        if held:
            yield out(now, first, ",".join(held))

    def batched(rows):
        """Many one-row results as batches of up to 1,000 rows."""
        def run(batches):
            kept = []
            for r in rows(batches):
                kept.append(r)
                if len(kept) == 1000:
                    yield pa.RecordBatch.from_pylist(kept)
                    kept = []
            if kept:
                yield pa.RecordBatch.from_pylist(kept)
        return run

    def out(node, first, ids):
        return {"id": node, "first": first, "ids": ids}

    def digest(batches):
        now, state = None, None
        for b in batches:
            for node, ids in zip(b.column("id").to_pylist(), b.column("ids").to_pylist()):
                if node != now:
                    if state:
                        yield {"id": now, "ends_sha256": state.hexdigest()}
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state:
            yield {"id": now, "ends_sha256": state.hexdigest()}

    pieces = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(batched(runs), "id binary, first long, ids string")
    return pieces.repartition("id").sortWithinPartitions("id", "first").mapInArrow(batched(digest), "id binary, ends_sha256 string")
