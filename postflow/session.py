"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming queries run in pools of their own, so that none waits for all others.
    "spark.scheduler.mode": "FAIR",
    # Window state outgrows the heap long before it outgrows a local disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "postflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def separate(spark: SparkSession) -> SparkSession:
    """A session with the same settings and views of its own, which end with it."""
    own = spark.newSession()
    for key in DEFAULT_CONF:
        if key.startswith("spark.sql."):
            own.conf.set(key, spark.conf.get(key))
    return own


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is set only for a local master; a cluster without
    the setting is an error, because its executors could not read such a folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="postflow-"))
    return context.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop objects."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def share_package(spark: SparkSession) -> None:
    """Lets Python workers find this package where the session runs from another folder."""
    own = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment
    if own not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [own, known.get("PYTHONPATH")]))


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = hadoop_path(spark, path)
    return files.exists(target)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under ``shared_dir`` that no earlier run has used, deleted when the session ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target, files = hadoop_path(spark, folder)
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{folder}/data"
