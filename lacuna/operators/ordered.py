"""Ordered fills: forward / backward fill, limits, interpolation (WIN1-WIN8).

Everything derives from four facts per missing cell: the previous and the next observed value
of the same series, and their positions (row index or order key).  Those are computed without
ever putting a long series in one task:

1. When the longest series has more than ``CHUNK_ROWS`` rows (or ``buckets`` asks for it), the
   table is range-partitioned by series key and the full order key, and written; a chunk is one
   range, so a hot series, or a table without a series key, or one timestamp that many rows
   share, is spread over many chunks.
2. Inside a chunk, windows per (series, chunk) give the local previous and next observation.
3. A summary with one row per (series, chunk) - row count, first and last observation - is
   carried across chunks by a window over that small table, and joined back.

Null series keys are a series of their own and null order keys come first, in every step (the
series key is compared as a struct, and structs of nulls are equal), so the result is the same
for any number of chunks.  With short series and a series key this is plain windows per series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import clean, resolve_columns
from lacuna.operators.base import Imputer, ImputerModel
from lacuna.session import cut

CHUNK_ROWS = 200_000


def _key_double(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    if isinstance(t, T.TimestampNTZType):
        # wall-clock micros, whatever the session time zone
        return F.unix_micros(F.from_utc_timestamp(F.col(name).cast("timestamp"), F.current_timezone())).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(name)).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    return F.col(name).cast("double")


def order_context(df: DataFrame, order_by: list[str], columns: list[str],
                  partition_by: list[str] | None = None, buckets: int | None = None,
                  keep_bucket: bool = False) -> DataFrame:
    """Add, for every value column c, the helper columns
    ``c__pv, c__pp, c__pk`` (previous observed value, its position, its key),
    ``c__nv, c__np, c__nk`` (next ...) and the row's own ``__pos`` / ``__key``.
    Positions count rows within the series (1-based), in ``order_by`` order.
    """
    part = list(partition_by or [])
    key = _key_double(df, order_by[0])
    base = df.withColumn("__key", key)
    order_cols = [F.col(c).asc_nulls_first() for c in order_by]
    # from the longest series: short series stay in one window partition each
    if part:
        st = df.groupBy(*part).count().agg(F.max("count").alias("mx"), F.sum("count").alias("n")).first()
        longest, n_rows = (st["mx"] or 0), (st["n"] or 0)
    else:
        longest = n_rows = df.count()
    single = longest <= CHUNK_ROWS if buckets is None else buckets <= 1
    base = base.withColumn("__s", F.struct(*part) if part else F.struct(F.lit(0).alias("one")))
    # what a task sorts doesn't grow with the table
    tasks = -(-n_rows // CHUNK_ROWS)
    if single:
        base = base.withColumn("__b", F.lit(0))
        if tasks > 1:
            base = base.repartition(tasks, "__s")
    else:
        chunks = buckets or -(-n_rows // CHUNK_ROWS)
        ranged = base.repartitionByRange(chunks, *[F.col(c).asc_nulls_first() for c in part], *order_cols)
        # written: a chunk must keep its rows whichever branch of the plan reads it
        base = cut(ranged.withColumn("__b", F.spark_partition_id()))
        if tasks > chunks:
            base = base.repartition(tasks, "__s", "__b")
    w = Window.partitionBy("__s", "__b").orderBy(*order_cols)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # "from here to the end" as a running frame over the reversed order: Spark
    # evaluates running frames in one pass, but re-aggregates a frame that
    # ends at UNBOUNDED FOLLOWING for every row (quadratic)
    after = Window.partitionBy("__s", "__b").orderBy(*[F.col(c).desc_nulls_last() for c in order_by]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("__lpos", F.row_number().over(w))
    sel = [F.col(c) for c in base.columns]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        v = clean(df, c)
        obs = v.isNotNull()
        sel += [F.last(v, True).over(upto).alias(f"{c}__lpv"),
                F.last(F.when(obs, F.col("__lpos")), True).over(upto).alias(f"{c}__lpp"),
                F.last(F.when(obs, F.col("__key")), True).over(upto).alias(f"{c}__lpk"),
                F.last(v, True).over(after).alias(f"{c}__lnv"),
                F.last(F.when(obs, F.col("__lpos")), True).over(after).alias(f"{c}__lnp"),
                F.last(F.when(obs, F.col("__key")), True).over(after).alias(f"{c}__lnk")]
        lastpos = F.max(F.when(obs, F.col("__lpos")))
        firstpos = F.min(F.when(obs, F.col("__lpos")))
        aggs += [F.max_by(v, F.when(obs, F.col("__lpos"))).alias(f"{c}__bl_v"), lastpos.alias(f"{c}__bl_p"),
                 F.max_by(F.col("__key"), F.when(obs, F.col("__lpos"))).alias(f"{c}__bl_k"),
                 F.min_by(v, F.when(obs, F.col("__lpos"))).alias(f"{c}__bf_v"), firstpos.alias(f"{c}__bf_p"),
                 F.min_by(F.col("__key"), F.when(obs, F.col("__lpos"))).alias(f"{c}__bf_k")]
    local = base.select(*sel)
    if single:
        # one bucket per series: nothing to carry across bucket edges, no carry join
        out = [F.col(c) for c in df.columns] + [F.col("__lpos").alias("__pos"), F.col("__key")]
        if keep_bucket:
            out.append(F.col("__b"))
        for c in columns:
            out += [F.col(f"{c}__lpv").alias(f"{c}__pv"), F.col(f"{c}__lpp").alias(f"{c}__pp"),
                    F.col(f"{c}__lpk").alias(f"{c}__pk"), F.col(f"{c}__lnv").alias(f"{c}__nv"),
                    F.col(f"{c}__lnp").alias(f"{c}__np"), F.col(f"{c}__lnk").alias(f"{c}__nk")]
        return local.select(*out)
    # one row per (series, chunk): the carry table
    # built from the windowed table, so the (series, bucket) shuffle is reused, not repeated
    summ = local.groupBy("__s", "__b").agg(*aggs)
    ws = Window.partitionBy("__s").orderBy("__b")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("__s").orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    csel = ["__s", "__b", "__off"]
    for c in columns:
        csel += [F.last(f"{c}__bl_v", True).over(before).alias(f"{c}__cpv"),
                 F.last(F.col(f"{c}__bl_p") + F.col("__off"), True).over(before).alias(f"{c}__cpp"),
                 F.last(f"{c}__bl_k", True).over(before).alias(f"{c}__cpk"),
                 F.last(f"{c}__bf_v", True).over(later).alias(f"{c}__cnv"),
                 F.last(F.col(f"{c}__bf_p") + F.col("__off"), True).over(later).alias(f"{c}__cnp"),
                 F.last(f"{c}__bf_k", True).over(later).alias(f"{c}__cnk")]
    carry = summ.select(*csel)
    j = local.join(carry, ["__s", "__b"], "left")  # how is left to the measured sizes
    out = [F.col(c) for c in df.columns] + [(F.col("__off") + F.col("__lpos")).alias("__pos"), F.col("__key")]
    if keep_bucket:
        out.append(F.col("__b"))
    for c in columns:
        out += [F.coalesce(f"{c}__lpv", f"{c}__cpv").alias(f"{c}__pv"),
                F.coalesce(F.col(f"{c}__lpp") + F.col("__off"), F.col(f"{c}__cpp")).alias(f"{c}__pp"),
                F.coalesce(f"{c}__lpk", f"{c}__cpk").alias(f"{c}__pk"),
                F.coalesce(f"{c}__lnv", f"{c}__cnv").alias(f"{c}__nv"),
                F.coalesce(F.col(f"{c}__lnp") + F.col("__off"), F.col(f"{c}__cnp")).alias(f"{c}__np"),
                F.coalesce(f"{c}__lnk", f"{c}__cnk").alias(f"{c}__nk")]
    return j.select(*out)


def _drop_helpers(df: DataFrame, original: list[str]) -> DataFrame:
    return df.select(*original)


def ordered_fill_expr(c: str, method: str, limit: int | None) -> Column:
    """Fill expression over order_context columns."""
    v = F.col(c)
    pv, pp, pk = F.col(f"{c}__pv"), F.col(f"{c}__pp"), F.col(f"{c}__pk")
    nv, np_, nk = F.col(f"{c}__nv"), F.col(f"{c}__np"), F.col(f"{c}__nk")
    pos, key = F.col("__pos"), F.col("__key")
    if method == "ffill":
        fill = pv if limit is None else F.when(pos - pp <= limit, pv)
    elif method == "bfill":
        fill = nv if limit is None else F.when(np_ - pos <= limit, nv)
    elif method in ("linear", "time"):
        a, b, x = (pp, np_, pos) if method == "linear" else (pk, nk, key)
        # equal keys on both sides (duplicate timestamps): take the previous value
        inner = F.when(b != a, pv + (nv - pv) * (x - a) / (b - a)).otherwise(pv)
        # leading holes stay; trailing holes take the last value (pandas / np.interp)
        fill = F.when(pv.isNotNull() & nv.isNotNull(), inner).when(pv.isNotNull(), pv)
        if limit is not None:
            fill = F.when(pos - pp <= limit, fill)
    elif method == "nearest":
        fill = F.when(pv.isNotNull() & nv.isNotNull(),
                      F.when((pos - pp) <= (np_ - pos), pv).otherwise(nv))
    elif method == "zero":
        fill = F.when(pv.isNotNull() & nv.isNotNull(), pv)
    else:
        raise ValueError(f"unknown method {method!r}")
    return F.coalesce(v, fill)


class OrderedFillModel(ImputerModel):
    def __init__(self, method, columns, order_by, partition_by, limit, buckets):
        self.method, self.columns, self.order_by = method, columns, order_by
        self.partition_by, self.limit, self.buckets = partition_by, limit, buckets

    def transform(self, df: DataFrame) -> DataFrame:
        cols = [c for c in self.columns if c in df.columns]
        ctx = order_context(df, self.order_by, cols, self.partition_by, self.buckets)
        out = []
        for name in df.columns:
            if name in cols:
                e = ordered_fill_expr(name, self.method, self.limit)
                if self.method not in ("ffill", "bfill"):
                    e = e.cast("double")
                else:
                    e = e.cast(df.schema[name].dataType)
                out.append(e.alias(name))
            else:
                out.append(F.col(name))
        return ctx.select(*out)


class ForwardBackwardFillImputer(Imputer):
    """ffill / bfill along ``order_by`` (within ``partition_by`` series), any column type.

    ``limit``: at most that many consecutive holes are filled.  Leading holes
    (ffill) and trailing holes (bfill) stay missing.
    """

    def __init__(self, method: str = "ffill", order_by=None, partition_by=None, limit: int | None = None,
                 columns=None, exclude=(), buckets: int | None = None):
        if method not in ("ffill", "bfill"):
            raise ValueError("method must be 'ffill' or 'bfill'")
        if not order_by:
            raise ValueError("order_by is required: Spark rows have no implicit order")
        self.method, self.limit = method, limit
        self.order_by = [order_by] if isinstance(order_by, str) else list(order_by)
        self.partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        self.columns, self.exclude, self.buckets = columns, tuple(exclude), buckets

    def fit(self, df):
        cols = resolve_columns(df, self.columns, "any",
                               list(self.exclude) + self.order_by + self.partition_by)
        return OrderedFillModel(self.method, cols, self.order_by, self.partition_by, self.limit, self.buckets)


class InterpolationImputer(Imputer):
    """Interpolate numeric holes along ``order_by``.

    ``linear``: equally spaced rows; ``time``: weights from the order key;
    ``nearest`` / ``zero``: nearest or previous observation, inside the observed
    range only.  Leading holes stay; for linear/time trailing holes take the last
    value.  ``polynomial`` / ``spline`` live in ``lacuna.operators.curves``.
    """

    METHODS = ("linear", "time", "nearest", "zero")

    def __init__(self, method: str = "linear", order_by=None, partition_by=None, limit: int | None = None,
                 columns=None, exclude=(), buckets: int | None = None):
        if method not in self.METHODS:
            raise ValueError(f"method must be one of {self.METHODS}")
        if not order_by:
            raise ValueError("order_by is required")
        self.method, self.limit = method, limit
        self.order_by = [order_by] if isinstance(order_by, str) else list(order_by)
        self.partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        self.columns, self.exclude, self.buckets = columns, tuple(exclude), buckets

    def fit(self, df):
        cols = resolve_columns(df, self.columns, "numeric",
                               list(self.exclude) + self.order_by + self.partition_by)
        return OrderedFillModel(self.method, cols, self.order_by, self.partition_by, self.limit, self.buckets)
