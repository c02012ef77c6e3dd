"""Shared storage for intermediate tables of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the session is local, as in
    tests, a temporary folder is taken.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="stemma-shared-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; no two calls return the same one."""
    return f"{shared_dir(spark).rstrip('/')}/stemma-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder and the lineage ends there."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, and its path.

    Iterations need this rather than ``cut``: a checkpoint carries its plan's estimated size on, which joins multiply round by
    round until planning takes longer than the work. A table has its real size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of stages that nothing refers to any more; Spark deletes them once the driver's JVM collects."""
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
