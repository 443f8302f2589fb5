"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "millrace") -> SparkSession:
    """A session tuned for the library's jobs.

    On a cluster call this without ``master``: the cluster manager supplies
    it. AQE stays on so shuffle partitions coalesce and skewed join
    partitions split at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        # a long session keeps the plans of its last queries only
        "spark.sql.ui.retainedExecutions": "20",
        "spark.ui.retainedJobs": "100",
        "spark.ui.retainedStages": "100",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "4g"  # one JVM does all the work (read when it starts)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is only set here when the
    session has none (tests, local runs).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or (fallback or "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage", options: dict[str, str] | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Survives executor loss (the files live on shared storage) and cuts the
    lineage so later stages do not recompute the expensive part. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)


#: A file of one row group is one split, however many cores there are. Up to this
#: many bytes its rows are dealt out before the per-row steps; larger inputs never move.
SPREAD_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one of the test tables (``<sf_dir>/<name>.parquet``).

    The scan's own splits are kept, but for inputs of at most
    ``SPREAD_BYTES`` on disk, whose rows are dealt out to the session's
    shuffle partitions (at most that many bytes move, at any cluster size).
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if not spread:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if size <= SPREAD_BYTES else df
