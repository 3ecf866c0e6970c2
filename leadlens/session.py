"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "leadlens") -> SparkSession:
    """Session for tests and local benchmarks. A cluster passes its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEADLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or the context's checkpoint dir).

    Only when a local session names none (tests, a laptop) a scratch folder is created and
    registered. On a cluster a folder of one machine would lose data, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)  # so DataFrame.checkpoint() writes there too
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="leadlens-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of ``path`` (works for shared stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def scratch_path(spark: SparkSession, tag: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint folder for this application's intermediate
    data (pass it to :func:`cleanup_at_exit` once written)."""
    import uuid

    return f"{checkpoint_root(spark)}/leadlens-{tag}" + (f"-{uuid.uuid4().hex}" if unique else "")


def cleanup_at_exit(spark: SparkSession, path: str) -> str:
    """Have Hadoop's ``FileSystem.deleteOnExit`` remove ``path`` when the application
    ends (it registers only paths that exist, so call this after writing)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def write_and_read(df, tag: str):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint folder and
    return it read back: cuts lineage and pins values computed once (for example
    partition ids), and survives the loss of the executors that computed it."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(cleanup_at_exit(spark, path))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, rows_per_task: int = 500_000) -> Iterator[None]:
    """For the jobs inside: as many shuffle partitions as ``rows`` need at ``rows_per_task`` each, and
    no more merged into one task than 16 MB, so that a task's memory does not grow with the table.
    Where the cores take so many rows at once, the session's settings stay."""
    wanted = -(-rows // rows_per_task)
    if wanted <= spark.sparkContext.defaultParallelism:
        yield
        return
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    spark.conf.set(keys[0], str(max(wanted, int(before[0] or 0))))
    spark.conf.set(keys[1], "16m")
    try:
        yield
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def broadcast_if_small(df, max_bytes: int = 10_000_000):
    """``F.broadcast(df)`` when Spark's size estimate of its optimised plan (for a file table, the
    files' size) is at most ``max_bytes``; else ``df`` unchanged, and the planner and AQE choose."""
    from pyspark.sql import functions as F

    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df
