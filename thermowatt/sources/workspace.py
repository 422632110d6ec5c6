"""Folders that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def _base(spark: SparkSession) -> str:
    """The cluster's shared folder: its setting, else the context's checkpoint folder, else one below the warehouse."""
    set_dir = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if set_dir:
        return set_dir
    checkpoints = spark.sparkContext._jsc.sc().getCheckpointDir()
    if checkpoints.isDefined():
        return checkpoints.get()
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder.

    Never a folder of one machine only: where ``spark.checkpoint.dir`` is unset
    the warehouse decides, which a cluster has to share anyway. A warehouse on
    a local disk is refused unless the session runs on one machine.
    """
    base = _base(spark)
    alone = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if base.endswith("/_shared") and base.startswith(("file:", "/")) and not alone:
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder``, wherever it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_folder(spark: SparkSession, path: str, to: str) -> bool:
    """Move a folder below the same shared folder; tells whether there was one."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    system = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(source):
        return False
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")
    return True


def list_folder(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, wherever they lie."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return [str(f.getPath().toString()) for f in found or []]
