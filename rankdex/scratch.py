"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables.

    Executors may be lost at any time, so it has to be one that every executor can
    read: ``spark.checkpoint.dir``, or, where that is unset, a folder in the
    warehouse, which is shared wherever tables are. On a cluster a warehouse on local
    disks is refused: set ``spark.checkpoint.dir``.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = f"{_shared(spark.conf.get('spark.sql.warehouse.dir'), context.master)}/scratch"
    return f"{root.rstrip('/')}/rankdex-{context.applicationId}"


def _shared(warehouse: str, master: str) -> str:
    """``warehouse``, unless it is a folder of each machine of a cluster."""
    if warehouse.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"{warehouse} is on local disks: set spark.checkpoint.dir to a shared folder")
    return warehouse.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the application's folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: later uses scan the files, with column
    pruning and true sizes, instead of running the plan behind ``df`` again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the application's folder. Call it when no DataFrame that this package
    returned will be read any more, at the latest before the session stops."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
