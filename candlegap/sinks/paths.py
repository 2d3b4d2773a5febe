"""Where intermediate tables go: the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or the context's checkpoint dir), or a
    folder in the SQL warehouse, which is shared too; it then becomes the context's
    checkpoint dir. Never a machine-local temporary folder: other executors do not see
    it, and it is lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local context
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one written table."""
    return f"{shared_root(spark)}/candlegap/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists on its file system (local, HDFS, object
    stores), or None where the session gives no JVM access (Spark Connect)."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:
        return None
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(conf).exists(jpath))


def _folder(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none where it does not exist."""
    jpath, fs = _folder(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that a job wrote for itself, if it is there."""
    jpath, fs = _folder(spark, path)
    fs.delete(jpath, True)
