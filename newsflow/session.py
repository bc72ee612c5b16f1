"""Spark session helpers.

On a cluster the session is created by the platform; we only read its
settings. ``spark.checkpoint.dir`` names the shared folder used to cut lineage
(``DataFrame.checkpoint``) and to stage intermediate tables. A local fallback
is set only when the setting is absent (tests, laptop runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"

# Settings this engine's plans are designed around when run on a cluster
# (the platform owns the session; these are the values to ask for).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",                       # runtime re-planning
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",  # post-shuffle partition target
    "spark.sql.adaptive.skewJoin.enabled": "true",              # split hot-term join partitions
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",     # measured-size broadcast only
    "spark.sql.autoBroadcastJoinThreshold": "-1",               # no broadcast from static estimates
    "spark.sql.files.maxPartitionBytes": "256m",                # scan split size
    "spark.sql.shuffle.partitions": "4000",                     # upper bound; AQE coalesces
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # drop unused checkpoints
}


def get_spark(master: str | None = None, cores: int | None = None,
              app: str = "newsflow", shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only what AQE measured at run time, never a static estimate
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # the local tables are single files: deal their rows to all cores
        .config("spark.newsflow.spread", str(cores))
        .config("spark.driver.memory", os.environ.get("NEWSFLOW_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables, read from the session.

    A machine-local scratch folder is made only under a ``local*`` master
    (tests, laptop runs); any other master without ``spark.checkpoint.dir`` is
    an error, because executors could not see each other's files.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError(f"{_CKPT_KEY} must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="newsflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
_REMOVE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries made and run in here leave no shuffle files: their result is all that is read again."""
    before = spark.conf.get(_REMOVE_KEY, "false")
    spark.conf.set(_REMOVE_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_KEY, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later stages, and recovery after a lost executor, read
    the committed files, with column pruning and pushed filters.
    """
    path = staging_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged tables that no later result reads."""
    for df in frames:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a staged table."""
    return stage(df, "materialized")
