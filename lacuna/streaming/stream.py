"""Structured Streaming extensions (STR1-STR3).

* ``stream_apply``: any fitted model whose ``transform`` is a projection or a
  stream-static join (constant, mean, median, mode, group center, partial
  mean) runs unchanged on a streaming DataFrame.
* ``stream_ffill`` (ffill.py): per-key forward fill with late rows, on
  ``transformWithStateInPandas``.
* ``missing_rate_by_window``: tumbling or sliding event-time windows with a
  watermark, counting rows and missing cells per column.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.session import checkpoint_dir, delete_on_exit


def stream_apply(model, stream: DataFrame) -> DataFrame:
    return model.transform(stream)


def missing_rate_by_window(stream: DataFrame, ts: str, columns: list[str], window: str = "1 day",
                           slide: str | None = None, watermark: str = "1 day") -> DataFrame:
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [(F.count(F.lit(1)) - F.count(c)).alias(f"{c}_missing")]
    return stream.withWatermark(ts, watermark).groupBy(w.alias("w")).agg(*aggs)


def run_to_table(spark: SparkSession, query_df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming query to completion (``availableNow``) into a parquet
    table under the shared checkpoint folder and return it as a batch DataFrame."""
    base = os.path.join(checkpoint_dir(spark), "lacuna-streams", f"{name}-{uuid.uuid4().hex[:8]}")
    delete_on_exit(spark, base)
    out, ckpt = os.path.join(base, "data"), os.path.join(base, "checkpoint")
    if mode == "complete":
        def write(batch, _):
            batch.write.mode("overwrite").parquet(out)
        q = (query_df.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    else:
        q = (query_df.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
