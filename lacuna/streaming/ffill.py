"""Stateful forward fill of a stream, with late rows (STR2).

A row's fill is the last observed value of its key at or before it, in order of event time and
tie-break, whatever order the rows arrive in.  State lives in RocksDB, per key and segment: the rows
of the buckets of event time that the watermark has not passed, and of the passed ones the last
observation only.  A segment is a run of neighbouring buckets with up to ``SEGMENT_ROWS`` rows (or one
bucket with more), so a key with few rows takes a handful of state calls and one timer, however many
buckets they fall in.  A late row opens its own segment again and the following ones just as far as
the carried observation changes, so work and memory follow a segment, not a key's history or a
key's share of a micro-batch (its rows are filed batch by batch as Arrow hands them over).

``emit="early"`` returns every row in the micro-batch that brings it, and again with the next
``revision`` whenever a late row changes its fill; the highest revision of a row is the batch
answer.  ``emit="final"`` returns every row once, when the watermark passes the end of its bucket
(revision 0).  A key without rows for ``timeout_ms`` of event time loses its state when the watermark passes
that (after the rows of the micro-batch); what comes later starts anew.  State that follows event time is dropped by event-time timers (Spark's state TTL
counts processing time and is not offered together with them).

Rows travel as JSON beside their order key, written and read by Spark with the stream's own
schema, so no column type passes through pandas.

Cases: NaN is a hole, as everywhere; a null key is a key; rows without event time cannot be
placed and come back as they are, in revision 0; ties of event time and tie-break keep arrival
order; rows behind the watermark are dropped by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lacuna.functions.columns import clean

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: every column travels in this notation and is read back from it
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
#: rows of a segment of more than one bucket
SEGMENT_ROWS = 4096
#: order key of rows without event time
NO_TIME = -(1 << 63)
SENT = "body string, fill string, revision long"


def holes_filled(v: np.ndarray, carry: str | None, run: int, limit: int | None):
    """Fills of the holes (null in ``v``) of one ordered run after an observation ``carry`` that lies
    ``run`` holes back; then the observation and distance to carry on."""
    n = np.arange(len(v))
    seen = pd.notna(v)
    at = np.maximum.accumulate(np.where(seen, n, -1))
    gap = np.where(at >= 0, n - at, run + n + 1)
    last = np.where(at >= 0, v[at], carry)
    fill = np.where(~seen & (gap <= (limit if limit is not None else np.iinfo(np.int64).max)), last, None)
    return fill, last[-1], int(gap[-1])


class Segment:
    """Buckets ``first`` to ``last`` of a key: number of stored parts and rows; what it hands on, where
    fills are sent early (carry is null before the first observation)."""

    def __init__(self, number: int, first: int, last: int, parts: int = 0, rows: int = 0, carry: str | None = None, run: int = 0):
        self.number, self.first, self.last, self.parts, self.rows, self.carry, self.run = number, first, last, parts, rows, carry, run
        self.new: list[pa.Table] = []  # rows not stored yet

    def packed(self) -> list:
        return [self.number, self.first, self.last, self.parts, self.rows, self.carry, self.run]


class Held:
    """What is known of a key: the observation before its segments, its newest row, its next timer (0: none), segments in order."""

    def __init__(self, got: tuple | None):
        self.carry, self.run, self.newest, self.timer, self.next = got[:5] if got else (None, 0, None, 0, 0)
        self.segments = [Segment(*s) for s in json.loads(got[5])] if got else []

    def packed(self) -> tuple:
        return self.carry, self.run, self.newest, self.timer, self.next, json.dumps([s.packed() for s in self.segments])

    def segment(self, first: int, last: int) -> Segment:
        self.next += 1
        return Segment(self.next - 1, first, last)


class ForwardFill(StatefulProcessor):
    def __init__(self, bucket: int, idle: int, limit: int | None, early: bool, tie_type: pa.DataType, segment_rows: int = SEGMENT_ROWS):
        self.bucket, self.idle, self.limit, self.early, self.segment_rows = bucket, idle, limit, early, segment_rows
        self.schema = pa.schema([("t", pa.int64()), ("tie", tie_type), ("body", pa.string()), ("v", pa.string()), ("fill", pa.string()),
                                 ("revision", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "segment long, part long", "rows binary")
        self.held = handle.getValueState("held", "carry string, run long, newest long, timer long, next long, segments string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, touched = None, set()
        for frame in rows:
            t = frame["t"].to_numpy(np.int64)
            if t.min(initial=0) == NO_TIME:
                timeless = t == NO_TIME
                yield self._sent(frame["body"].to_numpy(object)[timeless], None, 0)
                frame, t = frame[~timeless], t[~timeless]
            if not len(t):
                continue
            held = held or Held(self.held.get())
            held.newest = max(int(t.max()), held.newest if held.newest is not None else int(t.max()))
            texts = [pa.array(frame[c].to_numpy(object), self.schema.field(c).type, from_pandas=True) for c in ("tie", "body", "v")]
            table = pa.Table.from_arrays([pa.array(t), *texts, pa.nulls(len(t), pa.string()), pa.array(np.full(len(t), -1))], schema=self.schema)
            self._file(held, table, t // self.bucket, touched)
        if held is None:
            return
        if self.early:
            yield from self._refilled(held, touched)
        else:
            for s in held.segments:
                self._store(s)
        self._set_timer(held, self._end(held.segments[0]))
        self.held.update(held.packed())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        got = self.held.get()
        if got is None:
            return
        held, passed = Held(got), timerValues.getCurrentWatermarkInMs()
        held.timer = held.timer if held.timer > passed else 0
        opened = passed * 1000 // self.bucket  # the first bucket that the watermark has not passed
        while held.segments and held.segments[0].first < opened:
            s = held.segments.pop(0)
            if self.early and s.last < opened:
                held.carry, held.run = s.carry, s.run
                self._forget(s)
                continue
            table = self._read(s)
            n = int(np.searchsorted(table["t"].to_numpy(), opened * self.bucket))
            fill, held.carry, held.run = holes_filled(table["v"].to_numpy()[:n], held.carry, held.run, self.limit)
            if not self.early:
                yield self._sent(table["body"].to_numpy()[:n], fill, np.zeros(n, np.int64))
            self._forget(s, 1 if n < s.rows else 0)
            if n < s.rows:
                s.first, s.new = int(table["t"][n].as_py() // self.bucket), [table.slice(n)]
                s.rows, s.parts = s.rows - n, 0
                self._store(s)
                held.segments.insert(0, s)
                break
        if held.segments:
            self._set_timer(held, self._end(held.segments[0]))
        else:
            idle_at = held.newest // 1000 + self.idle
            if passed >= idle_at:
                self.held.clear()
                return
            self._set_timer(held, idle_at)
        self.held.update(held.packed())

    def close(self) -> None:
        pass

    def _end(self, s: Segment) -> int:
        return -(-(s.first + 1) * self.bucket // 1000)

    def _set_timer(self, held: Held, at: int) -> None:
        """One timer a key: for its first bucket, or for its end; set again where that is earlier."""
        if not held.timer or at < held.timer:
            held.timer = at
            self.handle.registerTimer(at)

    def _file(self, held: Held, table: pa.Table, buckets: np.ndarray, touched: set) -> None:
        """Add rows to the segments that their buckets fall in, splitting those that grow too long."""
        if not held.segments:
            held.segments.append(held.segment(int(buckets.min()), int(buckets.max())))
        at = np.searchsorted([s.first for s in held.segments[1:]], buckets, "right")
        for i in np.unique(at)[::-1]:  # from the last, as splits move the following
            s, mine = held.segments[i], at == i
            own = buckets[mine]
            s.new.append(table if mine.all() else table.filter(pa.array(mine)))
            s.first, s.last, s.rows = min(s.first, int(own.min())), max(s.last, int(own.max())), s.rows + len(own)
            touched.add(s.number)
            if s.rows > self.segment_rows:
                if s.first < s.last:
                    held.segments[i:i + 1] = pieces = self._split(held, s)
                    touched.update(p.number for p in pieces)
                else:
                    self._store(s)

    def _split(self, held: Held, s: Segment) -> list[Segment]:
        """Segments of about half the rows at most, or of one bucket."""
        table = self._read(s)
        b = table["t"].to_numpy() // self.bucket
        starts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        ends, cuts = np.append(starts[1:], len(b)), [0]
        for start, end in zip(starts[1:], ends[1:]):
            if end - cuts[-1] > self.segment_rows // 2:
                cuts.append(int(start))
        self._forget(s)
        out = []
        for start, end in zip(cuts, [*cuts[1:], len(b)]):
            p = held.segment(int(b[start]), int(b[end - 1]))
            p.rows, p.new = int(end - start), [table.slice(start, end - start)]
            self._store(p)
            out.append(p)
        return out

    def _store(self, s: Segment) -> None:
        """The rows not stored yet become a part."""
        if not s.new:
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema) as w:
            for table in s.new:
                w.write_table(table)
        self.parts.updateValue((s.number, s.parts), (sink.getvalue().to_pybytes(),))
        s.parts, s.new = s.parts + 1, []

    def _forget(self, s: Segment, kept: int = 0) -> None:
        for n in range(kept, s.parts):
            self.parts.removeKey((s.number, n))

    def _read(self, s: Segment) -> pa.Table:
        """All rows of a segment in order."""
        stored = [pa.ipc.open_stream(bytes(self.parts.getValue((s.number, n))[0])).read_all() for n in range(s.parts)]
        table = pa.concat_tables([*stored, *s.new])
        table = table.append_column("n", pa.array(np.arange(table.num_rows)))  # ties keep arrival order
        order = pc.sort_indices(table, [(c, "ascending") for c in ("t", "tie", "n")], null_placement="at_start")
        return table.take(order).drop_columns("n").combine_chunks()

    def _refilled(self, held: Held, touched: set) -> Iterator[pd.DataFrame]:
        """New rows with their fills, and earlier ones whose fill changed."""
        carry, run = held.carry, held.run
        changed = False
        for s in held.segments:
            if s.number not in touched and not changed:
                carry, run = s.carry, s.run
                continue
            table = self._read(s)
            fill, carry, run = holes_filled(table["v"].to_numpy(), carry, run, self.limit)
            was = table["fill"].to_numpy()
            revision = table["revision"].to_numpy()
            out = (revision < 0) | ((fill != was) & ~(pd.isna(fill) & pd.isna(was)))
            if out.any():
                revision = revision + out
                yield self._sent(table["body"].to_numpy()[out], fill[out], revision[out])
            if out.any() or s.parts != 1 or s.new:
                self._forget(s, 1)
                s.parts, s.new = 0, [pa.Table.from_arrays([*table.columns[:4], pa.array(fill, pa.string()), pa.array(revision)], schema=self.schema)]
                self._store(s)
            changed = (carry, run) != (s.carry, s.run)
            s.carry, s.run = carry, run

    @staticmethod
    def _sent(body, fill, revision) -> pd.DataFrame:
        return pd.DataFrame({"body": body, "fill": fill, "revision": revision})


def _ordinal(c: Column, kind: T.DataType) -> tuple[Column, pa.DataType]:
    """A tie-break column in a form that pandas keeps exactly."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("decimal(20,0)"), pa.decimal128(20, 0)
    return c.cast("string"), pa.string()


def stream_ffill(stream: DataFrame, key: str, ts: str, value: str, order_tiebreak: str | None = None, limit: int | None = None,
                 watermark: str = "1 day", timeout_ms: int = 7 * 24 * 3600 * 1000, bucket_ms: int = 3600 * 1000, emit: str = "early") -> DataFrame:
    """The stream's rows with ``value`` forward-filled per ``key`` along event time ``ts``, and ``revision``.

    Append mode; the session is set to the RocksDB state store, which this state needs.  ``ts`` is a
    zoned timestamp.  Tie-breaks are integers in their order, else ordered by their text.
    """
    if emit not in ("early", "final"):
        raise ValueError("emit is 'early' or 'final'")
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = stream.schema[value].dataType
    tie, tie_type = _ordinal(F.col(order_tiebreak), stream.schema[order_tiebreak].dataType) if order_tiebreak else (F.lit(None).cast("string"), pa.string())
    packed = stream.withWatermark(ts, watermark).select(
        F.to_json(F.struct(F.col(key).alias("k")), JSON).alias("key"), F.col(ts).alias("ts"),
        F.coalesce(F.unix_micros(ts), F.lit(NO_TIME)).alias("t"), tie.alias("tie"), F.to_json(F.struct(*stream.columns), JSON).alias("body"),
        F.when(clean(stream, value).isNotNull(), F.to_json(F.struct(F.col(value).alias("v")), JSON)).alias("v"))
    sent = packed.groupBy("key").transformWithStateInPandas(
        ForwardFill(bucket_ms * 1000, timeout_ms, limit, emit == "early", tie_type), SENT, "append", "eventTime")
    row = sent.select(F.from_json("body", stream.schema, JSON).alias("r"),
                      F.from_json("fill", T.StructType([T.StructField("v", kind)]), JSON)["v"].alias("v"), "revision")
    own = F.col("r")[value]
    filled = F.coalesce("v", F.nanvl(own, F.lit(None).cast(kind)) if isinstance(kind, (T.FloatType, T.DoubleType)) else own)
    return row.select(*(filled.alias(c) if c == value else F.col("r")[c].alias(c) for c in stream.columns), "revision")


def latest(sent: DataFrame, *ids: str) -> DataFrame:
    """Of rows sent more than once the highest revision, by the columns that name a row."""
    rest = [c for c in sent.columns if c not in ids]
    top = sent.groupBy(*ids).agg(F.max_by(F.struct(*rest), "revision").alias("top"))
    return top.select(*ids, *(F.col("top")[c].alias(c) for c in rest))
