"""Session settings the library reads; nothing here starts a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

GROUP_ROWS_CONF = "wardflow.maxGroupRows"
GROUP_ROWS_DEFAULT = 2_000_000
BROADCAST_ROWS_CONF = "wardflow.maxBroadcastRows"
BROADCAST_ROWS_DEFAULT = 100_000

_settled: ContextVar[list[str] | None] = ContextVar("settled", default=None)


def max_group_rows(spark: SparkSession) -> int:
    """Rows one task may hold for one key before the key is split up."""
    return int(spark.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS_DEFAULT)))


def max_broadcast_rows(spark: SparkSession) -> int:
    """Rows (of a few narrow columns) that may be sent to every executor."""
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS_DEFAULT)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, taken from `spark.checkpoint.dir`.

    Only a local session may go without the setting: it gets a scratch folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if folder is None:
        if current is not None:
            return current
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="wardflow-")
    if current is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder on any file system that Spark reaches; nothing happens if it is not there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def settling(spark: SparkSession) -> Iterator[None]:
    """Removes at its end, after an error too, what `settle` wrote within it.

    Results are to be written or collected before the end: a DataFrame that still reads a settled relation
    fails afterwards. Within another such block, only what the inner one settled goes at its end.
    """
    paths: list[str] = []
    outer = _settled.set(paths)
    try:
        yield
    finally:
        _settled.reset(outer)
        for path in paths:
            remove(spark, path)


def settle(df: DataFrame) -> DataFrame:
    """The relation written to the shared folder and read back.

    For results that several jobs or branches go on with: what lies before runs once, survives lost
    executors, and later reads take only the columns they need.
    """
    path = fresh_path(df.sparkSession, "settled")
    paths = _settled.get()
    if paths is not None:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
