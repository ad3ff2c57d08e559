"""Where intermediate tables go: the shared folder that the session names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only where that is unset in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="keyscore-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/keyscore/{name}-{uuid.uuid4().hex}"


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table that several jobs read; what does not fit in memory goes to disk, and what is
    lost with an executor is computed again."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def forget(df: DataFrame) -> None:
    """Remove what ``materialize`` wrote for ``df``, once nothing reads it any more; any other table is left alone."""
    path = getattr(df, "_materialized", None)
    if path is not None:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later jobs start from files; with the session's compression
    if none is named."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._materialized = path
    return written
