"""Session helpers shared by every operator: table loading, shared work folders, lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    A machine-local folder is chosen only where that setting is absent and the
    master is local (tests); on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = "file://" + os.path.join(tempfile.gettempdir(), f"sparkloom-{os.getuid()}")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_MADE: list[str] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends: results may be read until then."""
    if not _MADE:
        atexit.register(_clean, spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def release(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Remove everything written to the shared folder so far, but for paths that begin with one of ``keep``; how much was removed.

    For drivers that live long: call it when the results made so far have been
    read or written. What cannot be removed stays on the list and is tried again.
    """
    jvm, conf, left, gone = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), [], 0
    for path in _MADE:
        if path.startswith(keep or ("\0",)):
            left.append(path)
            continue
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            gone += bool(p.getFileSystem(conf).delete(p, True))
        except Py4JJavaError:
            left.append(path)
    _MADE[:] = left
    return gone


def local_path(path: str) -> str:
    """A path of the shared folder for Python's own file functions; an error if it is not on a file system that all executors mount."""
    scheme, sep, rest = path.partition(":")
    if sep and scheme != "file":
        raise ValueError(f"{path} is not on a mounted file system")
    return "/" + rest.lstrip("/") if sep else path


def _clean(spark: SparkSession) -> None:
    try:
        release(spark)
    except Exception:  # noqa: BLE001 - the session may have ended before the driver did
        pass


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back.

    The files live in the folder that all executors share, so a lost executor
    costs a re-read, never a recomputation of the stage.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
