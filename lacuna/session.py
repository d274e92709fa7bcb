"""Session helpers.

`get_session` is for tests, benchmarks and scripts; library code never builds
its own session and always works with whatever session its DataFrames carry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "lacuna") -> SparkSession:
    master = master or os.environ.get("LACUNA_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LACUNA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.  Only
    when it is unset (local tests) do we create a scratch folder and register
    it, so `DataFrame.checkpoint()` and streaming checkpoints have a home.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = delete_on_exit(spark, tempfile.mkdtemp(prefix="lacuna-ckpt-"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def delete_on_exit(spark: SparkSession, path: str) -> str:
    """Have ``path`` removed when the session's file system closes."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def cut(df):
    """Materialize ``df`` in the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds several jobs (fits, sweeps, two-pass
    selections): later jobs read the written table instead of recomputing it,
    and a lost executor does not send recomputation back to the scan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lacuna`` importable in the executors' Python workers.

    Arrow UDFs (``mapInPandas``, ``applyInPandas``) pickle references to
    functions in this package; when it is not installed on the cluster, a zip of
    it is added with ``addPyFile`` (shipped to every executor by Spark).  Done once
    per SparkContext.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="lacuna-pkg-"), "lacuna.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
