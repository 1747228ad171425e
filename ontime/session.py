"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Engine settings only: masters, memory and executor counts belong to the
# submit command. AQE picks the number of reducers from the bytes it sees.
# The JVM never compiles a method of more than 8000 bytes, so larger generated
# stages run faster operator by operator. Recording the Python call site of
# every column expression doubles the time it takes to build a plan.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app_name: str = "ontime", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine settings above; keyword keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet, below a folder that all executors share.

    That is the folder in `spark.checkpoint.dir` or, where it is unset, one
    below the warehouse; both are shared on any cluster, whatever its master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ontime-work"
    folder = f"{shared.rstrip('/')}/ontime-{purpose}-{uuid.uuid4().hex}"
    for named in _SCOPES:
        named.append(folder)
    return folder


# Folders named inside each open `temporary_folders` block.
_SCOPES: list[list[str]] = []


@contextmanager
def temporary_folders(spark: SparkSession) -> Iterator[None]:
    """Remove the work folders that the block names when it ends, however it ends.

    Results that are still to be computed from them have to be written before.
    """
    named: list[str] = []
    _SCOPES.append(named)
    try:
        yield
    finally:
        _SCOPES.remove(named)
        for folder in named:
            remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `work_folder` named, once nothing reads it any more."""
    if "/ontime-" not in path:
        raise ValueError(f"not a work folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
