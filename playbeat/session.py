"""Session builder and the shared scratch folder."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession


def get_spark(app_name: str = "playbeat", **conf: str) -> SparkSession:
    """The running session with these settings, or a new one. Event dates follow UTC whatever the cluster's zone."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        # generated methods above 8000 bytes are not compiled by HotSpot; smaller ones then run faster
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see: below spark.checkpoint.dir; below the warehouse only on one machine without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def completed_dirs(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the folders below a path that match and whose write was completed, from one listing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}/_SUCCESS")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(s.getPath().getParent().getName() for s in found or [])


def dir_signature(spark: SparkSession, path: str) -> str:
    """Number, size and time of the files in a folder: what changes when one is added, removed or replaced."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    files = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in held if s.getPath().getName()[0] not in "._"]
    return hashlib.sha256(repr(sorted(files)).encode()).hexdigest()


def make_dir(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what it holds, on whatever file system it is; one that is not there is no error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def query_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The identity that Spark gave to a streaming checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_path}/metadata").first()[0])["id"]
