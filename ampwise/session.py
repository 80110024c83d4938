"""Spark session and checkpoint-directory helpers.

On a cluster the session is created by the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC session clock (labels are computed from
# local wall-clock timestamps explicitly), adaptive execution for runtime
# re-planning of joins, skew splitting and partition coalescing, and no UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove reliable checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "ampwise",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with :data:`DEFAULT_CONF`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is ``fallback`` installed.
    Never invent a machine-local folder on a cluster: if neither exists this
    raises instead of guessing.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not fallback:
            raise RuntimeError("spark.checkpoint.dir is not set; iterative jobs need a shared folder")
        if "://" not in fallback:
            os.makedirs(fallback, exist_ok=True)
        # spark.checkpoint.dir is a static setting; only the context's folder can change
        spark.sparkContext.setCheckpointDir(fallback)
        d = fallback
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where a session leaves it unset, as in tests, one
    temporary folder stands in, which only this machine sees: a session whose executors run
    elsewhere (``spark.executor.instances`` or any master but one of this process) must name it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return checkpoint_dir(spark, None if named or not _one_process(spark) else tempfile.mkdtemp(prefix="ampwise-ckpt-"))


def _one_process(spark: SparkSession) -> bool:
    """Whether all tasks run in the driver's process: it is the only block manager."""
    return spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() == 1 and spark.sparkContext.master.split("[")[0] == "local"


def reliable_checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in :func:`shared_folder`.
    Not ``eager``: when a query first runs; all its branches then read the same
    partitions, so a range partitioning is drawn once for all of them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, on whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_OWN: dict[str, SparkSession] = {}


def own_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that is removed when the driver's Python ends, as results
    may be read from it until then."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _OWN:
        atexit.register(remove_own)
    _OWN[path] = spark
    return path


def remove_own() -> None:
    """Remove the tables and files that :func:`own_path` named so far."""
    while _OWN:
        path, spark = _OWN.popitem()
        if spark.sparkContext._jsc is not None:  # a stopped session's files stay
            delete_folder(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table below the shared folder and read again: cuts the
    lineage, survives lost executors."""
    path = own_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
