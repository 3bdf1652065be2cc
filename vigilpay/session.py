"""Session settings every job relies on, and staging of shared intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Per-session settings that results depend on (time zone) or that plans rely on
# (runtime re-planning, skew handling).  Sizes such as executor memory and the
# number of shuffle partitions stay with whoever starts the session.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_FALLBACK: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vigilpay")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VIGILPAY_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call sites in error messages cost a round trip to the JVM per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only on a local master
    (tests, a laptop), where driver and executors are one process, does this
    fall back to a temporary folder, one per application.  Elsewhere an unset
    folder is an error: each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _FALLBACK:
            _FALLBACK[app] = tempfile.mkdtemp(prefix="vigilpay-")
        folder = _FALLBACK[app]
    return folder.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where several consumers share an expensive input: lineage is cut by
    files that outlive an executor, and each consumer still reads only the
    columns it needs.  The application owns the folder until ``drop_staged``.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    _STAGED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a staged folder, wherever the shared file system keeps it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_staged(spark: SparkSession) -> int:
    """Remove all that this application has staged, once its results are read; the number of folders."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop(spark, path)
    return len(paths)
