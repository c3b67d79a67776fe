"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "edulens", extra: dict | None = None) -> SparkSession:
    """Session for local runs. On a cluster the submitter's settings win:
    ``getOrCreate`` reuses an existing session and we only add defaults."""
    builder = SparkSession.builder.appName(app_name)
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


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting). Only when neither is set and the master
    is ``local[...]`` (unit tests on one machine) is a fresh local folder
    created; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master != "local" and not (sc.master or "").startswith("local["):  # not local-cluster
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) for "
                           "checkpoints and written intermediate tables; a machine-local folder is not "
                           "visible to other executors")
    local = tempfile.mkdtemp(prefix="edulens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never reused)."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = "-".join(p for p in parts if p) or "tmp"
    return f"{root}/edulens/{leaf}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_folder(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint folder; it goes when the driver ends."""
    path = scratch_path(spark, *parts)
    fs, where = hadoop_fs(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def file_state(spark: SparkSession, *paths: str) -> tuple:
    """Name, size and time of every file below the paths: it changes when the data do."""
    found = []
    for path in paths:
        fs, where = hadoop_fs(spark, path)
        files = fs.listFiles(where, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
