"""Where jobs may put intermediate files."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])

_made: list[str] = []


def let_workers_import(spark: SparkSession) -> None:
    """Tell Python workers where this package lies, whatever folder the session was started in.

    For a package that is not installed but lies at the same place on all machines; clusters
    install it (``pyproject.toml``) or are given it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *(path for path in paths if path)])


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where that setting is missing, the checkpoint folder of the context is used. With neither, a
    temporary folder is made in local mode only, where all tasks share this machine's disk; on a
    cluster that is an error, because executors would write to disks of their own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="textlake-"))
    return folder or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written intermediate table."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _made:
        _made.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has made.

    Results may still read them, so this is for the caller, once results are written.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
