"""Catalog: the streaming extensions, each checked against its batch answer (Q46)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.functions.hashing import missing_flag
from lacuna.operators.simple import MeanImputer
from lacuna.plans.common import masked, masked_sql
from lacuna.plans.registry import query
from lacuna.streaming import latest, missing_rate_by_window, run_to_table, stream_apply, stream_ffill

EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EV_MASKS = {"value": (31, 250)}


def _as_events(raw):
    # event time must be a zoned timestamp: read the wall clock as UTC, so day
    # windows fall on wall-clock midnights whatever the session time zone is
    ts = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return raw.select("event_id", ts.alias("ts"), "user_id", "event_type",
                      F.when(missing_flag("event_id", 31, 250), F.lit(None).cast("double"))
                      .otherwise(F.col("value")).alias("value"))


def _event_stream(spark, sf):
    static = spark.read.parquet(f"{sf}/events.parquet")
    # a glob keeps the file source from treating the single file as a directory
    raw = spark.readStream.schema(static.schema).option("basePath", sf).parquet(f"{sf}/events.parque[t]")
    return _as_events(raw)


BATCH_FILES = 8


def _event_batches(spark, sf, batches=4, by_time=True):
    """The events as a stream of several micro-batches: time ranges written one after another, or
    (``by_time`` off) parts by hash of the event, so that every part holds rows of all times."""
    import uuid
    from lacuna.session import checkpoint_dir, delete_on_exit
    events = spark.read.parquet(f"{sf}/events.parquet")
    key = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = (events.agg(F.percentile_approx(key, [i / batches for i in range(1, batches)])).first()[0] or []) if by_time else []
    base = delete_on_exit(spark, f"{checkpoint_dir(spark).rstrip('/')}/lacuna-streams/events-{uuid.uuid4().hex}")
    part = F.lit(0)
    for c in cuts:
        part = part + F.when(key > c, 1).otherwise(0)
    part = F.coalesce(part, F.lit(0)) if by_time else F.pmod(F.hash("event_id"), F.lit(batches))
    events.withColumn("__part", part).write.partitionBy("__part").parquet(f"{base}/parts")
    dealt = spark.read.parquet(f"{base}/parts")
    for i in range(batches):  # a handful of jobs, each reads its own part only
        dealt.where(F.col("__part") == i).drop("__part").repartition(BATCH_FILES).write.parquet(f"{base}/stream/b{i}")
    return _as_events(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(f"{base}/stream/b*"))


def q46(spark, sf):
    model = MeanImputer(columns=["value"]).fit(masked(spark, sf, "events", "event_id", EV_MASKS))
    out = stream_apply(model, _event_stream(spark, sf)).select("event_id", F.round("value", 4).alias("value"))
    return run_to_table(spark, out, "stream_apply")


Q46_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)})
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM m)), 4) AS value FROM m"""
query("q46_stream_apply", Q46_SQL)(q46)


def _stream_filled(spark, sf, name, by_time):
    out = stream_ffill(_event_batches(spark, sf, by_time=by_time), "user_id", "ts", "value", order_tiebreak="event_id",
                       watermark="60 days", timeout_ms=3650 * 24 * 3600 * 1000, bucket_ms=10 * 24 * 3600 * 1000)
    res = run_to_table(spark, out.select("event_id", "user_id", "value", "revision"), name)
    return latest(res, "event_id", "user_id").select("event_id", "user_id", F.round("value", 4).alias("value"))


def q46b(spark, sf):
    return _stream_filled(spark, sf, "stream_ffill", by_time=True)


Q46B_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)})
SELECT event_id, user_id, round(coalesce(value, last_value(value IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 4) AS value FROM m"""
query("q46b_stream_ffill", Q46B_SQL)(q46b)


def q46h(spark, sf):
    """Three quarters of the rows come late: corrections bring every fill to the batch answer."""
    return _stream_filled(spark, sf, "stream_ffill_late", by_time=False)


query("q46h_stream_ffill_late_rows", Q46B_SQL)(q46h)


def q46i(spark, sf):
    """Rows sent once, when the watermark has passed their day."""
    out = stream_ffill(_event_batches(spark, sf), "user_id", "ts", "value", order_tiebreak="event_id", watermark="5 days",
                       timeout_ms=3650 * 24 * 3600 * 1000, bucket_ms=24 * 3600 * 1000, emit="final")
    res = run_to_table(spark, out.select("event_id", "user_id", "value"), "stream_ffill_final")
    return res.select("event_id", "user_id", F.round("value", 4).alias("value"))


Q46I_SQL = f"""WITH f AS (SELECT ts, m.* FROM ({Q46B_SQL}) m JOIN events USING (event_id))
SELECT event_id, user_id, value FROM f WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 5 DAY FROM events)"""
query("q46i_stream_ffill_final", Q46I_SQL)(q46i)


def q46c(spark, sf):
    agg = missing_rate_by_window(_event_stream(spark, sf), "ts", ["value", "event_type"], "1 day")
    res = run_to_table(spark, agg, "stream_missing_rate", mode="complete")
    start = F.to_utc_timestamp(F.col("w.start"), F.current_timezone())  # render the UTC wall clock
    return res.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n_rows",
                      "value_missing", "event_type_missing",
                      F.round(F.col("value_missing") / F.col("n_rows"), 6).alias("value_missing_rate"))


Q46C_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)})
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_rows,
       count(*) - count(value) AS value_missing, count(*) - count(event_type) AS event_type_missing,
       round((count(*) - count(value)) / count(*), 6) AS value_missing_rate
FROM m GROUP BY 1"""
query("q46c_stream_missing_rate", Q46C_SQL)(q46c)


def q46g(spark, sf):
    """Append mode: a window is written once, when the watermark has passed it, and its state goes."""
    agg = missing_rate_by_window(_event_batches(spark, sf), "ts", ["value"], "1 day", watermark="1 day")
    res = run_to_table(spark, agg, "stream_closed_windows")
    start = F.to_utc_timestamp(F.col("w.start"), F.current_timezone())
    return res.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n_rows", "value_missing")


Q46G_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)})
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_rows, count(*) - count(value) AS value_missing
FROM m WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM m) GROUP BY 1"""
query("q46g_stream_closed_windows", Q46G_SQL)(q46g)


def q46d(spark, sf):
    """A fitted EM model applied to a stream: one E-step per row, maps for every pattern."""
    from lacuna.operators.gaussian import EMImputer
    cols = ["user_id_d", "value"]
    static = masked(spark, sf, "events", "event_id", EV_MASKS).withColumn("user_id_d", F.col("user_id").cast("double"))
    model = EMImputer(columns=cols).fit(static.select("event_id", *cols))
    st = _event_stream(spark, sf).withColumn("user_id_d", F.col("user_id").cast("double")).select("event_id", *cols)
    out = stream_apply(model, st).select("event_id", F.round("value", 4).alias("value"))
    return run_to_table(spark, out, "stream_em")


query("q46d_stream_em_apply")(q46d)


def q46f(spark, sf):
    """EM on a stream with holes in one of two columns: the regression of the complete rows."""
    from lacuna.operators.gaussian import EMImputer
    cols = ["seq", "value"]
    static = masked(spark, sf, "events", "event_id", EV_MASKS).withColumn("seq", F.col("event_id").cast("double"))
    model = EMImputer(columns=cols).fit(static.select("event_id", *cols))
    st = _event_stream(spark, sf).withColumn("seq", F.col("event_id").cast("double")).select("event_id", *cols)
    out = stream_apply(model, st).select("event_id", F.round("value", 3).alias("value"))
    return run_to_table(spark, out, "stream_em_two")


Q46F_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)}),
r AS (SELECT regr_slope(value, event_id) AS b, regr_intercept(value, event_id) AS a FROM m)
SELECT event_id, round(coalesce(value, a + b * event_id), 3) AS value FROM m, r"""
query("q46f_stream_em_two_columns", Q46F_SQL)(q46f)


def q46e(spark, sf):
    """A group-center model on a stream: a stream-static join with the group table."""
    from lacuna.operators.group import GroupCenterImputer
    model = GroupCenterImputer("event_type", columns=["value"]).fit(
        masked(spark, sf, "events", "event_id", EV_MASKS).select("event_id", "event_type", "value"))
    st = _event_stream(spark, sf).select("event_id", "event_type", "value")
    out = stream_apply(model, st).select("event_id", "event_type", F.round("value", 4).alias("value"))
    return run_to_table(spark, out, "stream_group")


Q46E_SQL = f"""WITH m AS ({masked_sql('events', EV_COLS, 'event_id', EV_MASKS)}),
g AS (SELECT event_type, avg(value) AS g FROM m GROUP BY event_type)
SELECT m.event_id, m.event_type, round(coalesce(m.value, g.g, (SELECT avg(value) FROM m)), 4) AS value
FROM m LEFT JOIN g ON m.event_type IS NOT DISTINCT FROM g.event_type"""
query("q46e_stream_group_apply", Q46E_SQL)(q46e)
