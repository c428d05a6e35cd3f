"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots.

    Partition counts are left to the cluster unless the caller names them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the session names; make one up only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
    context.setCheckpointDir(named)


def settle(df: DataFrame) -> DataFrame:
    """Store `df` once, so later steps all read the same rows and a lost executor costs a
    read, not a recomputation."""
    return stage(df, "settled")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share; gone when the program ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(clear_staged, spark)
    _STAGED.append(path)
    return path


def stage(df: DataFrame, name: str = "stage", rows_per_file: int = 0) -> DataFrame:
    """Write `df` once as compressed columns in the shared folder and read it back.

    Later steps prune columns of it, and a lost executor costs a read of it. Select the
    columns that are needed before the call. With `rows_per_file` a task writes several files.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Remove what this program staged. Frames that read it can't be used afterwards. This goes through
    the JVM's file system client, so it needs a classic session, not a remote one."""
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration() if spark.sparkContext._jsc else (
        jvm.org.apache.hadoop.conf.Configuration())
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
