"""Exact substring de-duplication with FM-indexes per shard (operator 8).

A window of ``length`` words is a duplicate when its word sequence starts anywhere else.  Equal
windows hold the same minimizer (the least hash among their k-word grams) at the same place, so
windows are routed by minimizer: a segment is the run of a document's windows that share one
minimizer position, and only segments of one minimizer can hold equal windows.

1. Every text is read whole; the minimizers are counted, and those seen twice set a bit in a
   filter of fixed size (``FILTER_BITS``, 16 MB).  A fuller filter passes more segments to the
   next step and never loses one.
2. Segments that pass are written once.  They are folded by content on hashes alone: one that
   occurs twice is a duplicate throughout; one alone in its minimizer is unique.
3. Of the others one occurrence each (picked through a second such filter) brings its words, and
   they are sharded by minimizer.  A shard's segments form one text with a compressed FM-index
   (wavelet matrix over the Burrows-Wheeler transform, bits packed with block counts).  The
   segments stream against it: backward search gives, for each window end, the longest match with
   two occurrences, held at ``length``; ends that reach it are reported.  A minimizer with more
   than ``HOT`` distinct segments is sharded by whole windows instead, and equal windows fold, so
   no shard grows with a hot group.
4. Reports return to the texts by digest.  Only texts that lose a part of their words (a third
   filter) travel to their reports; for the others a digest is enough.

Cases: null text has no words; texts under ``length`` words lose none; repeated rows are
occurrences of each other, so all of their windows go; an empty table gives no rows; extra
columns pass through ``without_repeats`` and are not read by ``repeated_spans``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import small, stash

LENGTH = 35
GRAM = 13
FILTER_BITS = 27
HOT = 2048
SHARD_WORDS = 1 << 18
CHUNK_BYTES = 1 << 20
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)
_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int):
    """Powers of the base and of its inverse modulo 2^64, 0..n."""
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 18)
        for k, b in enumerate((_B, _B_INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n + 1], _POWERS[1][:n + 1]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64), 5)


class Chunk:
    """The words of some texts, found and hashed by whole-array steps: per word its place in the
    joined bytes and a 64-bit hash, per text its number of words."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""])
        data = np.frombuffer(self.raw, np.uint8)
        gap = np.concatenate(([True], _SPACE[data]))
        turn = np.flatnonzero(gap[1:] != gap[:-1])  # the last byte is a gap, so turns come in pairs
        self.start, self.end = turn[::2], turn[1::2]
        up, down = powers(len(data))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64)))
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start], 6)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.last = np.searchsorted(self.start, ends)  # words up to the end of each text
        self.sizes = np.diff(np.concatenate(([0], self.last)))

    def words(self, first: int, n: int) -> bytes:
        """n words from the first on, with the white space between them."""
        return self.raw[self.start[first]:self.end[first + n - 1]]


def minimizer_places(grams: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of each ``w`` grams, the first of equal ones.  Places are OR-ed into the low
    bits of the hashes; a longer run is read in overlapping slices that those bits can number."""
    out, step = np.zeros(len(grams) - w + 1, np.int64), int(_PLACE) + 2 - w
    for at in range(0, len(out), step):
        part = grams[at:at + step + w - 1]
        least = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while 2 * span <= w:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
        out[at:at + len(least)] = (least & _PLACE).astype(np.int64) + at
    return out


def segments(chunk: Chunk, length: int = LENGTH, gram: int = GRAM):
    """Segments of a chunk: arrays text, start (word of the text), windows, minimizer hash,
    content hash, and first word in the chunk."""
    n, ends, sizes, h = len(chunk.hash), chunk.last, chunk.sizes, chunk.hash
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64), z
    up, down = powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:n], dtype=np.uint64)))
    sums2 = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(h, 1) * up[:n], dtype=np.uint64)))
    grams = mixed((sums[gram:] - sums[:n - gram + 1]) * down[:n - gram + 1], 2)
    places = minimizer_places(grams, length - gram + 1)
    doc = np.repeat(np.arange(len(sizes)), sizes)[:len(places)]
    at = np.flatnonzero(np.arange(len(places)) + length <= ends[doc])
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64), z
    place = places[at]
    new = np.concatenate(([True], (np.diff(place) != 0) | (np.diff(at) != 1) | (np.diff(doc[at]) != 0)))
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(at)])))
    a, d = at[first], doc[at[first]]
    size = count + length - 1
    content = mixed((sums2[a + size] - sums2[a]) * down[a], 3) ^ mixed(size.astype(np.uint64), 4)
    return d, a - (ends - sizes)[d], count, grams[place[first]], content, a


def _chunks(batches, *names):
    """Chunks of about CHUNK_BYTES: (arrays of the named columns, words of the texts)."""
    for b in batches:
        text = b.column("text").cast(pa.binary())
        at = np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False))))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK_BYTES, side="right")) - 1)
            texts = [t or b"" for t in text.slice(lo, hi - lo).to_pylist()]
            yield [b.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in names], Chunk(texts)
            lo = hi


def _minimizers(batches):
    for _, chunk in _chunks(batches):
        yield pa.RecordBatch.from_arrays([pa.array(segments(chunk)[3].view(np.int64))], ["mh"])


def _bit(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _in_filter(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = _bit(key)
    return (bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)


SLICE_BITS = 22


def _filter_slices(batches):
    """Rows of one hash -> slices of the filter: (slice, bits)."""
    held: dict = {}
    for b in batches:
        bit = _bit(b.column(0).to_numpy())
        for s in np.unique(bit >> SLICE_BITS):
            flags = held.setdefault(int(s), np.zeros(1 << SLICE_BITS, bool))
            flags[bit[bit >> SLICE_BITS == s] & ((1 << SLICE_BITS) - 1)] = True
    for s, flags in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["s", "bits"])


def hash_filter(keys: DataFrame):
    """Broadcast bit filter of the hashes in the one column of ``keys``: FILTER_BITS bits whatever
    the input.  It has every key, and others with the chance of a set bit."""
    name = keys.columns[0]
    by_slice = keys.repartition(F.shiftrightunsigned(name, 64 - FILTER_BITS + SLICE_BITS))
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    step = (1 << SLICE_BITS) // 8
    for s, part in by_slice.mapInArrow(_filter_slices, "s int, bits binary").toLocalIterator():
        bits[s * step:(s + 1) * step] |= np.frombuffer(part, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def passing(rows: DataFrame, key: str, bits, hit: bool = True) -> DataFrame:
    """Rows whose hash in column ``key`` (dropped) is in the filter, or those where it is not."""
    names = [c for c in rows.columns if c != key]

    def run(batches):
        held = bits.value
        for b in batches:
            on = _in_filter(held, b.column(key).to_numpy()) == hit
            for at in range(0, b.num_rows, 2048):  # a slice at a time, so that copies stay small
                yield b.slice(at, 2048).filter(pa.array(on[at:at + 2048])).select(names)

    return rows.mapInArrow(run, rows.select(*names).schema)


SEGMENT = "mh long, sh long, k1 long, k2 long, start int, windows int, n_words int, words binary"


def _emit_segments(filter_bits):
    def run(batches):
        bits = filter_bits.value
        for (k1, k2), chunk in _chunks(batches, "k1", "k2"):
            d, start, count, mh, sh, a = segments(chunk)
            on = np.flatnonzero(_in_filter(bits, mh))
            if not len(on):
                continue
            d = d[on]
            text = [chunk.words(x, n) for x, n in zip(a[on].tolist(), (count[on] + LENGTH - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mh[on].view(np.int64)), pa.array(sh[on].view(np.int64)), pa.array(k1[d]), pa.array(k2[d]),
                 pa.array(start[on].astype(np.int32)), pa.array(count[on].astype(np.int32)), pa.array(chunk.sizes[d].astype(np.int32)),
                 pa.array(text, pa.binary())], [x.split()[0] for x in SEGMENT.split(", ")])

    return run


class FmIndex:
    """Counts of patterns of up to DEPTH symbols in a text of symbols 1..sigma (0 separates)."""

    DEPTH = 64

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        order, rank, span = np.argsort(text, kind="stable"), text.astype(np.int64), 1
        while span < self.DEPTH:
            nxt = np.zeros(n, np.int64)
            nxt[:max(n - span, 0)] = rank[span:] + 1
            key = rank * (max(int(rank.max()), sigma) + 2) + nxt
            order = np.argsort(key, kind="stable")
            s = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
            if rank[order[-1]] == n - 1:
                break
            span *= 2
        bwt = text[order - 1]  # the text is cyclic at its separator
        self.n, self.levels, self.zeros = n, [], []
        before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma + 1))))
        cur = bwt
        self.bits = max(1, int(sigma).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = (cur >> b & 1).astype(bool)
            packed = np.packbits(np.concatenate((bit, np.zeros(-n % 64 + 64, bool))), bitorder="little").view(np.uint64)
            blocks = np.concatenate(([0], np.cumsum(np.bitwise_count(packed)[:-1], dtype=np.int64)))
            self.levels.append((packed, blocks))
            self.zeros.append(n - int(bit.sum()))
            cur = np.concatenate((cur[~bit], cur[bit]))
        symbols = np.arange(sigma + 1)
        self.base = before[:-1] - self._descend(symbols, np.zeros(sigma + 1, np.int64))
        self.span = before

    def _descend(self, symbol, at):
        """Where position ``at`` of the transform goes, following the bits of ``symbol``."""
        for k, (packed, blocks) in enumerate(self.levels):
            block = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = blocks[block] + np.bitwise_count(packed[block] & low)
            up = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            at = np.where(up, self.zeros[k] + ones, at - ones)
        return at

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int, times: int = 2) -> np.ndarray:
        """For each end (exclusive) in ``text``, the longest match ending there that occurs
        ``times`` or more, at most ``most``: matching statistics by backward search."""
        found = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        c = text[ends - 1]
        lo, hi = self.span[c], self.span[c + 1]
        step = 1
        while len(live):
            ok = hi - lo >= times
            live, lo, hi = live[ok], lo[ok], hi[ok]
            found[live] = step
            step += 1
            if step > most or not len(live):
                break
            c = text[ends[live] - step]
            both = self._descend(np.concatenate((c, c)), np.concatenate((lo, hi))) + np.concatenate((self.base[c],) * 2)
            lo, hi = both[:len(c)], both[len(c):]
        return found


def duplicate_windows(segs: list[list[bytes]], length: int = LENGTH) -> list[int]:
    """For the segments (lists of words) of a shard: bit i of a segment's mask is set when its
    window i occurs in the shard's text twice or more."""
    ids: dict = {}
    flat, ends, owner, first = [0], [], [], []
    for k, ws in enumerate(segs):
        at = len(flat)
        flat.extend([ids.setdefault(w, len(ids) + 1) for w in ws])
        flat.append(0)
        ends.append(np.arange(at + length, at + len(ws) + 1))
        owner.append(np.full(len(ws) - length + 1, k))
        first.append(np.arange(len(ws) - length + 1))
    text = np.array(flat, np.int64)
    hit = FmIndex(text, len(ids)).matching(text, np.concatenate(ends), length) >= length
    masks = [0] * len(segs)
    for k, w in zip(np.concatenate(owner)[hit].tolist(), np.concatenate(first)[hit].tolist()):
        masks[k] |= 1 << w
    return masks


def _shards(batches):
    """mapInArrow over (mh, sh, words) sorted by mh: (mh, sh, mask) of the segments with repeats."""
    held, size, last, seen = [], 0, None, set()

    def out():
        masks = duplicate_windows([ws for _, _, ws in held])
        got = [(m, s, k) for (m, s, _), k in zip(held, masks) if k]
        cols = list(zip(*got)) if got else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["mh", "sh", "mask"])

    for b in batches:
        for at in range(0, b.num_rows, 1024):
            for mh, sh, ws in zip(*(b.column(c).slice(at, 1024).to_pylist() for c in ("mh", "sh", "words"))):
                if mh != last:
                    last, seen = mh, set()
                    if size >= SHARD_WORDS:
                        yield out()
                        held, size = [], 0
                if sh not in seen:  # the filter may have passed a second occurrence
                    seen.add(sh)
                    held.append((mh, sh, ws.split()))
                    size += len(held[-1][2])
    if held:
        yield out()


def _windows(batches):
    """Segments of hot minimizers cut into their windows: (mh, sh, place, digest)."""
    for b in batches:
        rows = []
        for mh, sh, ws in zip(*(b.column(c).to_pylist() for c in ("mh", "sh", "words"))):
            ws = ws.split()
            rows += [(mh, sh, i, hashlib.md5(b" ".join(ws[i:i + LENGTH])).digest()) for i in range(len(ws) - LENGTH + 1)]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                         ["mh", "sh", "i", "digest"])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` and k1, k2: 128 bits that stand for the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(7), text)})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, whole, starts, masks): per text that loses words whether it loses all, and else
    its reports (first window of a segment, bits of its windows); ``docs`` has k1, k2 and text."""
    twice = docs.select("text").mapInArrow(_minimizers, "mh long").groupBy("mh").agg(F.count("*").alias("n")).filter("n > 1").select("mh")
    segs = stash(docs.select("k1", "k2", "text").mapInArrow(_emit_segments(hash_filter(twice)), SEGMENT)
                 .withColumn("rid", F.monotonically_increasing_id()))
    distinct = stash(segs.groupBy("mh", "sh").agg(F.count("*").alias("n"), F.max("windows").alias("windows"), F.min("rid").alias("rid")))
    groups = stash(distinct.groupBy("mh").agg(F.count("*").alias("g"), F.min("n").alias("least")).filter("g > 1 and least = 1")
                   .select("mh", "g"))
    hot_mh = stash(groups.filter(F.col("g") > HOT).select(F.col("mh").alias("hm")))
    picked = hash_filter(distinct.join(groups, "mh").select(F.xxhash64("rid").alias("h")))
    brought = passing(segs.select("mh", "sh", "words", F.xxhash64("rid").alias("h")), "h", picked)
    brought = stash(brought.join(small(hot_mh, hot_mh.count()), F.col("mh") == F.col("hm"), "left"))
    cold = (brought.filter("hm is null").select("mh", "sh", "words").repartition("mh").sortWithinPartitions("mh")
            .mapInArrow(_shards, "mh long, sh long, mask long"))
    held = stash(brought.filter("hm is not null").select("mh", "sh", "words")
                 .mapInArrow(_windows, "mh long, sh long, i int, digest binary").distinct())
    often = held.groupBy("mh", "digest").agg(F.count("*").alias("c")).filter("c > 1")
    hot = (held.join(stash(often), ["mh", "digest"]).groupBy("mh", "sh")
           .agg(F.expr("bit_or(shiftleft(1L, i))").alias("mask")))
    folded = distinct.filter("n > 1").select("mh", "sh", F.expr("shiftleft(1L, windows) - 1").alias("mask"))
    reports = stash(folded.unionAll(cold).unionAll(hot).groupBy("mh", "sh").agg(F.bit_or("mask").alias("mask")))
    placed = segs.select("mh", "sh", "k1", "k2", "start", "n_words").join(reports, ["mh", "sh"]).select("k1", "k2", "start", "n_words", "mask")
    spans = placed.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "mask")).alias("spans"), F.max("n_words").alias("n_words"))
    windows = F.aggregate("spans", F.lit(0), lambda a, s: a + F.bit_count(s["mask"]))
    return stash(spans.withColumn("whole", windows == F.col("n_words") - LENGTH + 1)
                 .select("k1", "k2", "whole", F.when(~F.col("whole"), F.transform("spans", lambda s: s["start"])).alias("starts"),
                         F.when(~F.col("whole"), F.transform("spans", lambda s: s["mask"])).alias("masks")))


def covered(n: int, starts, masks) -> np.ndarray:
    """Which of n words lie in a reported window."""
    at, bit = np.nonzero((np.asarray(masks, np.int64)[:, None] >> np.arange(63)) & 1)
    first = np.asarray(starts, np.int64)[at] + bit
    edge = np.bincount(first, minlength=n + 1) - np.bincount(first + LENGTH, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _strip(ws, starts, masks):
    return [w for w, g in zip(ws, covered(len(ws), starts, masks).tolist()) if not g]


def _partly(spans: DataFrame):
    """Filter of the texts that lose a part of their words."""
    return hash_filter(spans.filter(~F.col("whole")).select(F.xxhash64("k1", "k2").alias("h")))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows = keyed(docs.select("doc_id", "text"))
    spans = repeated_spans(rows)
    partly = _partly(spans)

    def measure(batches):
        """n_words and digest as if nothing went, and the text where a part does."""
        bits = partly.value
        for b in batches:
            keep = _in_filter(bits, b.column("h").to_numpy())
            for at in range(0, b.num_rows, 512):
                part, n, sha = b.slice(at, 512), [], []
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for t in texts:
                    ws = (t or b"").split()
                    n.append(len(ws))
                    sha.append(hashlib.sha256(b" ".join(ws)).hexdigest())
                some = [t if k else None for t, k in zip(texts, keep[at:at + 512])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(n, pa.int64()), pa.array(sha), pa.array(some, pa.binary())],
                    ["doc_id", "k1", "k2", "n_words", "sha", "text"])

    def run(batches):
        nothing = hashlib.sha256(b"").hexdigest()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512), []
                for n, sha, text, whole, starts, masks in zip(*(part.column(c).to_pylist() for c in ("n_words", "sha", "text", "whole", "starts", "masks"))):
                    if whole:
                        out.append((n, n, nothing))
                    elif starts:
                        kept = _strip(text.split(), starts, masks)
                        out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
                    else:
                        out.append((n, 0, sha))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string())))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"])

    light = rows.select("doc_id", "k1", "k2", "text", F.xxhash64("k1", "k2").alias("h")).mapInArrow(
        measure, "doc_id long, k1 long, k2 long, n_words long, sha string, text binary")
    return (light.join(spans, ["k1", "k2"], "left").select("doc_id", "n_words", "sha", "text", "whole", "starts", "masks")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words removed from the texts that have some (kept words joined by
    one space, n_chars counted anew); other rows are unchanged, none is dropped."""
    rows = keyed(docs.select(F.struct("*").alias("__row"), "text"))
    spans = repeated_spans(rows.select("k1", "k2", "text"))
    losing = hash_filter(spans.select(F.xxhash64("k1", "k2").alias("h")))
    rows = rows.withColumn("__h", F.xxhash64("k1", "k2"))

    @F.pandas_udf("string")
    def strip(text, starts, masks):
        import pandas as pd
        return pd.Series([t if s is None or t is None else b" ".join(_strip(t.encode().split(), s, m)).decode()
                          for t, s, m in zip(text, starts, masks)])

    def fields(changed):
        return [changed.get(c, F.col("__row").getField(c)).alias(c) for c in docs.columns]

    # only texts that may lose words are joined with the reports
    same = passing(rows.select("__row", "__h"), "__h", losing, hit=False).select(*fields({}))
    some = passing(rows.select("__row", "text", "k1", "k2", "__h"), "__h", losing).join(spans, ["k1", "k2"], "left")
    text = F.when(F.col("whole"), F.lit("")).when(F.col("starts").isNotNull(), strip("text", "starts", "masks")).otherwise(F.col("text"))
    some = some.select("__row", "text", "whole", text.alias("__text"))
    lost = F.col("whole").isNotNull()
    changed = {"text": F.col("__text"), "n_chars": F.when(lost, F.length("__text").cast("long")).otherwise(
        F.col("__row.n_chars") if "n_chars" in docs.columns else None)}
    return same.unionAll(some.select(*fields({k: v for k, v in changed.items() if k in docs.columns})))
