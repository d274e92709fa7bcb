"""State across micro-batches: the stream forward fill equals the batch fill."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lacuna.operators.ordered import ForwardBackwardFillImputer
from lacuna.streaming import missing_rate_by_window, run_to_table, stream_ffill


def test_stream_ffill_across_batches(spark, tmp_path):
    rng = np.random.default_rng(9)
    n = 900
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.choice(10 ** 6, n, replace=False)), unit="s")
    v = rng.normal(size=n)
    v[rng.random(n) < 0.4] = np.nan
    pdf = pd.DataFrame({"event_id": np.arange(n), "ts": ts, "user_id": rng.integers(0, 5, n), "value": v})
    src = tmp_path / "src"
    src.mkdir()
    for i, part in enumerate(np.array_split(pdf, 3)):  # three files in time order
        spark.createDataFrame(part).coalesce(1).write.parquet(str(src / f"part{i}"))
    schema = spark.read.parquet(str(src / "part0")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(str(src / "part*")))
    out = run_to_table(spark, stream_ffill(stream, "user_id", "ts", "value", "event_id", watermark="30 days"),
                       "test_ffill").toPandas().sort_values("event_id")
    batch = ForwardBackwardFillImputer("ffill", ["ts", "event_id"], "user_id", columns=["value"]).fit_transform(
        spark.createDataFrame(pdf)).toPandas().sort_values("event_id")
    assert np.allclose(out["value"].to_numpy(dtype=float), batch["value"].to_numpy(dtype=float), equal_nan=True)

    rates = run_to_table(spark, missing_rate_by_window(
        spark.readStream.schema(schema).parquet(str(src / "part*")), "ts", ["value"], "1 day"),
        "test_rates", mode="complete")
    assert rates.agg(F.sum("n_rows")).first()[0] == n
    assert rates.agg(F.sum("value_missing")).first()[0] == int(np.isnan(v).sum())


def test_results_do_not_depend_on_session_zone(spark):
    from lacuna.plans import queries
    q = queries()
    sf = "/root/testdata/sf0.001"
    names = ["q46c_stream_missing_rate", "q31_time_nearest_zero"]
    base = {n: sorted(q[n](spark, sf).collect()) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for n in names:
            assert sorted(q[n](spark, sf).collect()) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partial_mean_and_mixture_on_a_stream(spark, tmp_path):
    from lacuna.operators.group import PartialMeanImputer
    from lacuna.operators.mixture import GaussianMixtureImputer
    from lacuna.streaming import stream_apply
    rng = np.random.default_rng(4)
    n = 300
    x = rng.normal(size=n)
    y = 2 * x + rng.normal(size=n) * 0.1
    y[rng.random(n) < 0.3] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "s": rng.choice(["a", "b"], n), "x": x, "y": y})
    src = tmp_path / "src"
    spark.createDataFrame(pdf).coalesce(1).write.parquet(str(src / "p0"))
    static = spark.read.parquet(str(src / "p0"))
    stream = spark.readStream.schema(static.schema).parquet(str(src / "p*"))
    for name, imp in (("pm", PartialMeanImputer({"as": {"s": "a"}}, columns=["y"])),
                      ("gmm", GaussianMixtureImputer(2, columns=["x", "y"]))):
        model = imp.fit(static)
        batch = model.transform(static).toPandas().sort_values("id")
        streamed = run_to_table(spark, stream_apply(model, stream), f"t_{name}").toPandas().sort_values("id")
        assert np.allclose(batch["y"].to_numpy(), streamed["y"].to_numpy(), atol=1e-9), name


EVENTS = "event_id long, ts timestamp, user_id string, value long, note string"


def _event_rows(n=600, seed=3):
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2024-03-01")
    rows = []
    for i in range(n):
        at = start + pd.Timedelta(seconds=int(rng.integers(0, 4000)) * 200)  # ties among them
        value = None if rng.random() < 0.5 else int(rng.integers(2 ** 60, 2 ** 61))
        rows.append((i, at.to_pydatetime(), [None, "a", "b", "hot", "hot"][rng.integers(0, 5)], value, None if i % 7 else f'n"{i}\n'))
    return rows + [(n + i, None, "a", None, "no time") for i in range(3)]


def _batch_fill(rows, limit=None):
    out, carry = {}, {}
    for r in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0])):
        last, run = carry.get(r[2], (None, 0))
        last, run = (r[3], 0) if r[3] is not None else (last, run + 1)
        carry[r[2]] = last, run
        out[r[0]] = r[3] if r[3] is not None else last if limit is None or run <= limit else None
    return out | {r[0]: r[3] for r in rows if r[1] is None}


def _files(spark, rows, folder, cuts):
    for i in range(len(cuts) - 1):
        spark.createDataFrame(rows[cuts[i]:cuts[i + 1]], EVENTS).coalesce(1).write.parquet(str(folder / f"part{i}"))
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(folder / "part*"))


def test_late_rows_correct_earlier_fills(spark, tmp_path):
    from lacuna.streaming import latest
    rows = _event_rows()
    for limit in (None, 2):
        stream = _files(spark, rows, tmp_path / f"s{limit}", [0, 200, 400, len(rows)])
        sent = run_to_table(spark, stream_ffill(stream, "user_id", "ts", "value", "event_id", limit=limit, watermark="60 days",
                                                bucket_ms=6 * 3600 * 1000), "t_late")
        got = latest(sent, "event_id").collect()
        assert {r.event_id: r.value for r in got} == _batch_fill(rows, limit)
        assert sent.where("revision > 0").count() > 10 and sent.count() > len(got) == len(rows)
        assert {r.event_id: (r.ts, r.user_id, r.note) for r in got} == {r[0]: (r[1], r[2], r[4]) for r in rows}


def test_final_rows_come_once(spark, tmp_path):
    rows = sorted((r for r in _event_rows() if r[1]), key=lambda r: r[1])
    stream = _files(spark, rows, tmp_path / "s", [0, 250, 500, len(rows)])
    sent = run_to_table(spark, stream_ffill(stream, "user_id", "ts", "value", "event_id", watermark="1 day",
                                            bucket_ms=3600 * 1000, emit="final"), "t_final").collect()
    closed = rows[-1][1] - pd.Timedelta(days=1)
    want = _batch_fill(rows)
    late = {r[0] for r in rows if pd.Timestamp(r[1]).floor("h") + pd.Timedelta(hours=1) <= closed}
    assert len(sent) == len({r.event_id for r in sent}) and {r.event_id: r.value for r in sent} == {i: want[i] for i in late}


def test_idle_keys_lose_their_state(spark, tmp_path):
    def at(day):
        return pd.Timestamp("2024-03-01").to_pydatetime() + pd.Timedelta(days=day).to_pytimedelta()

    rows = [(1, at(0), "a", 5, None), (2, at(0), "b", 6, None), (3, at(30), "b", None, None), (4, at(31), "b", None, None),
            (5, at(40), "a", None, None), (6, at(41), "b", None, None)]
    for days, want in ((7, None), (300, 5)):
        stream = _files(spark, rows, tmp_path / f"s{days}", [0, 2, 3, 4, 5, 6])
        sent = run_to_table(spark, stream_ffill(stream, "user_id", "ts", "value", "event_id", watermark="1 day",
                                                timeout_ms=days * 24 * 3600 * 1000), "t_idle")
        got = {r.event_id: r.value for r in sent.collect()}
        # rows come before the timers of their micro-batch, so b, which moves the watermark itself, goes on
        assert got == {1: 5, 2: 6, 3: 6, 4: 6, 5: want, 6: 6}


def test_state_survives_a_restart(spark, tmp_path):
    from lacuna.streaming import latest
    rows = _event_rows(300)
    src = tmp_path / "s"
    for part in ((0, 100), (100, 200), (200, len(rows))):  # a new query on the same checkpoint for every file
        spark.createDataFrame(rows[part[0]:part[1]], EVENTS).coalesce(1).write.parquet(str(src / f"part{part[0]}"))
        stream = spark.readStream.schema(EVENTS).parquet(str(src / "part*"))
        q = (stream_ffill(stream, "user_id", "ts", "value", "event_id", watermark="60 days").writeStream.outputMode("append").format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    got = latest(spark.read.parquet(str(tmp_path / "out")), "event_id").collect()
    assert {r.event_id: r.value for r in got} == _batch_fill(rows)


class _Handle:
    """State of one key in memory; counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.parts, self.value = 0, set(), {}, None

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return self

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def updateValue(self, k, v):
        self.calls += 1
        self.parts[k] = v

    def getValue(self, k):
        self.calls += 1
        return self.parts[k]

    def removeKey(self, k):
        self.calls += 1
        del self.parts[k]

    def get(self):
        self.calls += 1
        return self.value

    def update(self, v):
        self.calls += 1
        self.value = v

    def clear(self):
        self.calls += 1
        self.value = None


class _Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _key_frames(seed, n):
    """Frames of one key in any order of time: 10 ms buckets."""
    rng = np.random.default_rng(seed)
    t = rng.integers(0, 300, n) * 1000
    v = np.where(rng.random(n) < 0.5, None, np.arange(n).astype(str))
    return pd.DataFrame({"t": t, "tie": [f"{i:05d}" for i in range(n)], "body": [str(i) for i in range(n)], "v": v})


def _in_order(pdf):
    return pdf.sort_values(["t", "tie"]).v.ffill()


def test_state_calls_follow_segments_not_buckets():
    import pyarrow as pa
    from lacuna.streaming.ffill import ForwardFill
    pdf = _key_frames(1, 90)  # about 30 buckets
    for early in (True, False):
        h = _Handle()
        p = ForwardFill(10_000, 10 ** 9, None, early, pa.string())
        p.init(h)
        sent = list(p.handleInputRows(("k",), iter([pdf]), None))
        assert h.calls <= 4 and len(h.timers) == 1
        h.calls = 0
        sent += list(p.handleExpiredTimer(("k",), _Now(300), None))
        assert h.calls <= 6 and not h.parts
        got = pd.concat(sent).set_index("body").fill
        want = _in_order(pdf)
        holes = pdf.v.isna().to_numpy()
        assert len(got) == len(pdf) and all((pd.isna(a) and pd.isna(b)) or a == b for a, b in
                                            ((got[str(i)], want[i]) for i in pdf.index[holes]))


def test_segments_split_and_close_in_any_order():
    import pyarrow as pa
    from lacuna.streaming.ffill import ForwardFill
    for seed, rows, early in ((2, 1, True), (3, 7, True), (4, 7, False), (5, 40, False), (6, 4096, True)):
        h = _Handle()
        p = ForwardFill(10_000, 10 ** 9, None, early, pa.string(), rows)
        p.init(h)
        pdf, mark, sent, kept = _key_frames(seed, 400), 0, [], []
        for batch in range(4):
            part = pdf.iloc[batch * 100:(batch + 1) * 100]
            part = part[part.t >= mark * 1000]  # Spark drops rows behind the watermark
            kept.append(part)
            sent += list(p.handleInputRows(("k",), iter([part.iloc[:30], part.iloc[30:]]), _Now(mark)))
            mark = 55 * (batch + 1)
            while h.timers and min(h.timers) <= mark:
                h.timers.remove(min(h.timers))
                sent += list(p.handleExpiredTimer(("k",), _Now(mark), None))
        mark = 300
        for at in sorted(h.timers):
            sent += list(p.handleExpiredTimer(("k",), _Now(mark), None))
        assert not h.parts
        pdf = pd.concat(kept)
        got = pd.concat(sent).sort_values("revision", kind="stable").groupby("body").tail(1).set_index("body").fill
        assert sum(map(len, sent)) == len(pdf) or early
        want = _in_order(pdf)
        for i in pdf.index[pdf.v.isna()]:
            a, b = got[str(i)], want[i]
            assert (pd.isna(a) and pd.isna(b)) or a == b, (seed, i)
        assert len(got) == len(pdf)
