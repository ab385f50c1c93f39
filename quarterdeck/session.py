"""Session helpers: shared scratch space, checkpoints and lenient arithmetic."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session in one machine may go without; it gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarterdeck-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/quarterdeck/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch paths taken inside are deleted at the end, also after an error. What is still read must be written elsewhere."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


#: Bytes of input files for a task of an exchange that grows with the input.
TASK_BYTES = 2 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame is made of, as Spark listed them; sources of unknown size don't count."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return sum(size for size in sizes if size < 1 << 60)


def more_tasks(df: DataFrame) -> int | None:
    """Tasks for an exchange of the frame, if its input asks for more than the session's number; else none."""
    tasks = -(-input_bytes(df) // TASK_BYTES)
    return tasks if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Partitioned by the keys, into as many tasks as the input asks for."""
    tasks = more_tasks(df)
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame, target: str) -> DataFrame:
    """Write a frame as parquet and read it back: for what several later steps read."""
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target)


@contextmanager
def lenient_arithmetic(spark: SparkSession):
    """Compile expressions so that division by zero and bad casts give NULL.

    The flag is captured when an expression is analysed, so the block must touch `.schema` of what it builds.
    """
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
