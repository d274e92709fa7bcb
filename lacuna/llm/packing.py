"""Best-fit packing by length patterns fitted with non-negative least squares (operator 4).

Documents are tokenised inside the tasks; one narrow row per piece is written (no token ids).
Only the histogram of piece lengths, ``max_len`` counts at most, reaches the driver.  Lengths
are rounded up to bins; all patterns of up to three bins that fill a sequence (and the single
and paired ones that nearly do) are enumerated, and non-negative least squares (active set)
fits how often each is used.  The counts are rounded down, spread over the exact lengths of
each bin, and what is left is packed best-fit decreasing, class by class of equal free space,
into the gaps and into new sequences.  The plan is a list of (lengths, repeats) classes whose
size depends on the number of lengths, not of documents.

Every piece gets a rank among the pieces of its length: a window inside (length, salt) groups
whose number follows the row count, plus the counts of the salts before, so a length that a
third of all pieces share is ranked in parts.  The rank is looked up in the broadcast plan.

A document longer than ``max_len`` is cut into full pieces with the shorter one first.

Cases: null text is an empty one, its only token is the separator; rows alike in id and text
are packed once each; null ids pack like others; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import small, stash

SEPARATOR = 0
_CODER: dict = {}


def encoder(path: str):
    """Token ids of a text by the ``tokenizers`` vocabulary file ``path``, without added special tokens;
    strings of the file's own special tokens inside a text are these tokens, as in the plain call.

    The same vocabulary is kept as ranks beside it (``.tiktoken``); when that file is there its
    encoder is used for texts that hold no such string, which gives the same ids several times
    faster (tested)."""
    if path not in _CODER:
        import json
        import os

        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)

        def plain(text):
            return tok.encode(text, add_special_tokens=False).ids

        ranks = path[:-len(".json")] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            coder = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            with open(path, encoding="utf-8") as f:
                special = [t["content"] for t in json.load(f)["added_tokens"]]
            _CODER[path] = lambda text: plain(text) if any(t in text for t in special) else coder.encode_ordinary(text)
        else:
            _CODER[path] = plain
    return _CODER[path]


def cuts(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: the short one first."""
    if n <= max_len:
        return [(0, n)]
    head = n % max_len
    out = [(0, head)] if head else []
    return out + [(s, max_len) for s in range(head, n, max_len)]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, max_len: int = 2048, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document; ``with_ids`` adds the token ids themselves."""
    schema = PIECE + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][:len(names)]

    def run(batches):
        encode = encoder(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                rows = []
                for doc, text in zip(b.column("doc_id").slice(at, 512).to_pylist(), b.column("text").slice(at, 512).to_pylist()):
                    ids = np.array([*encode(text or ""), SEPARATOR], "<u4")
                    for k, (s, n) in enumerate(cuts(len(ids), max_len)):
                        part = ids[s:s + n]
                        row = (doc, k, s, n, zlib.crc32(part.tobytes()))
                        rows.append((*row, part.astype(np.int32)) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def patterns(bins: int) -> np.ndarray:
    """All patterns of one to three bins: triples that sum to ``bins`` exactly, pairs that do, and
    single bins; a column holds how often each bin 1..bins occurs."""
    found = [(a,) for a in range(1, bins + 1)]
    found += [(a, bins - a) for a in range(1, bins // 2 + 1)]
    found += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    out = np.zeros((bins, len(found)))
    for j, p in enumerate(found):
        for b in p:
            out[b - 1, j] += 1
    return out


def nonnegative_fit(a: np.ndarray, y: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """min |a x - y| over x >= 0 by an active set: the column that helps most joins the set, the
    least squares over the set are solved, and columns that turn negative leave it."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = max(1.0, np.abs(a.T @ y).max())
    for _ in range(rounds):
        gain = a.T @ (y - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, at], y, rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[at] = s
                break
            bad = s <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - s[bad], 1e-300))
            x[at] += step * (s - x[at])
            gone = at[bad & (x[at] <= 1e-9)]
            if not len(gone):
                gone = at[bad][:1]
            x[gone], active[gone] = 0, False
    return x


def spread(counts: dict[int, int], use: list[tuple[tuple[int, ...], int]], unit: int, max_len: int):
    """Patterns of bins with repeats -> (classes (exact lengths, repeats), lengths left over).

    All but the shortest piece of a pattern are the longest left in their bins; the shortest is
    the longest left that still fits, from its bin or, by a few tokens, a neighbour."""
    left = dict(counts)
    have = sorted(left)
    out = []

    def take(n, lengths):
        for x in set(lengths):
            left[x] -= n * lengths.count(x)
            if not left[x]:
                del left[x]
                have.pop(bisect_left(have, x))

    def longest(low, high):
        k = bisect_right(have, high) - 1
        return have[k] if k >= 0 and have[k] >= low else None

    for p, r in use:
        bins = sorted(p, reverse=True)
        while r > 0:
            lengths: list[int] = []
            for b in bins[:-1]:
                lengths.append(longest(unit * (b - 1) + 1, unit * b) or 0)
            room = max_len - sum(lengths)
            last = longest(max(1, unit * (bins[-1] - 2) + 1), room)
            if last is None or not all(lengths):
                break
            lengths.append(last)
            n = min([r] + [left[x] // lengths.count(x) for x in set(lengths)])
            if not n:  # a length that the pattern wants twice has one piece left: it goes to the residue
                break
            take(n, lengths)
            out.append((tuple(lengths), n))
            r -= n
    return out, left


def best_fit(classes, left: dict[int, int], max_len: int):
    """Best-fit decreasing by classes: each length, longest first, goes to the class of sequences
    with the least free space that holds it; whole groups of equal sequences move at once."""
    free: dict[int, list] = {}
    for lengths, n in classes:
        free.setdefault(max_len - sum(lengths), []).append([lengths, n])
    sizes = sorted(free)
    for length in sorted(left, reverse=True):
        want = left[length]
        while want:
            k = bisect_left(sizes, length)
            if k == len(sizes):  # new sequences, as many copies in each as fit
                each = min(max_len // length, want)
                n = want // each
                fresh, want, room = (length,) * each, want - n * each, max_len - each * length
                bucket = free.setdefault(room, [])
                if not bucket and room not in sizes[bisect_left(sizes, room):bisect_left(sizes, room) + 1]:
                    insort(sizes, room)
                bucket.append([fresh, n])
                continue
            room = sizes[k]
            bucket = free[room]
            lengths, n = bucket[-1]
            each = min(room // length, want)
            use = min(n, want // each)
            want -= use * each
            bucket[-1][1] -= use
            if not bucket[-1][1]:
                bucket.pop()
            if not bucket:
                sizes.pop(k)
                del free[room]
            now = room - each * length
            b = free.setdefault(now, [])
            if not b:
                insort(sizes, now)
            b.append([lengths + (length,) * each, use])
    return [(tuple(p), n) for b in free.values() for p, n in b if n]


def pack_plan(counts: dict[int, int], max_len: int, bins: int = 256) -> list[tuple[tuple[int, ...], int]]:
    """Classes (lengths, repeats) that hold every piece of the histogram."""
    unit = -(-max_len // bins)
    bins = max_len // unit

    def bin_of(n):
        return min(bins, -(-n // unit))

    full, rest = counts.get(max_len, 0), {k: v for k, v in counts.items() if k < max_len and v}
    done = [((max_len,), full)] if full else []
    if not rest:
        return done
    y = np.zeros(bins)
    for n, c in rest.items():
        y[bin_of(n) - 1] += c
    a = patterns(bins)
    weight = np.sqrt(np.arange(1, bins + 1) / bins) + 0.05  # short pieces also fit gaps later
    fit = nonnegative_fit(a * weight[:, None], y * weight)
    columns = np.flatnonzero(fit >= 1)
    columns = columns[np.argsort(-fit[columns])]
    best = None
    for keep in (1.0, 0.9, 0.75, 0.5, 0.25, 0.1):  # of the fitted repeats; the rest is left to best fit
        use = []
        for j in columns:
            p = tuple(int(b) + 1 for b in np.repeat(np.arange(bins), a[:, j].astype(int)))
            if sum(p) >= bins - 1:
                use.append((p, int(fit[j] * keep)))
        classes, left = spread(rest, use, unit, max_len)
        plan = best_fit(classes, left, max_len)
        if best is None or sum(n for _, n in plan) < sum(n for _, n in best):
            best = plan
    return done + best


def slots(plan) -> dict[int, tuple]:
    """Per length, its places in plan order: (first rank, first sequence, repeats, offset)."""
    by: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first = 0
    for lengths, n in plan:
        at = 0
        for x in lengths:
            r = ranks.get(x, 0)
            by.setdefault(x, []).append((r, first, at))
            ranks[x] = r + n
            at += x
        first += n
    return {x: tuple(np.array(c, np.int64) for c in zip(*v)) for x, v in by.items()}


def pack(docs: DataFrame, tokenizer: str, max_len: int = 2048, group_rows: int = 4096, tokens: DataFrame | None = None) -> DataFrame:
    """Pieces with sequence_id and offset.  ``tokens`` may hand in written pieces."""
    rows = stash(pieces(docs, tokenizer, max_len)) if tokens is None else tokens
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most max_len rows
    total, salts = sum(counts.values()), 64
    while total > 3 * salts * group_rows:
        salts *= 2
    where = slots(pack_plan(counts, max_len))
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts))
    salted = rows.withColumn("salt", salt)
    per = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = stash(per.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = (salted.withColumn("place", place).join(small(first, first.count()), ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank")))
    plan = docs.sparkSession.sparkContext.broadcast(where)  # a few entries per class; bounded by max_len

    def run(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                lo, first_seq, offset = plan.value[int(x)]
                k = np.searchsorted(lo, rank[at], side="right") - 1
                seq[at], off[at] = first_seq[k] + rank[at] - lo[k], offset[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)],
                                             [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECE + ", sequence_id long, offset long")
