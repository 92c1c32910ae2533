"""Cutting lineage in a place that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Folders that `stored` wrote, by the frame that reads them.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from spark.checkpoint.dir.

    Where it is unset and the master is local (tests, a single machine) a temporary folder is made once and
    set in the session's Spark context; on a cluster that would be a folder of one machine, so it raises.
    """
    context = spark.sparkContext
    told = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if told:
        return told.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="rivulet-shared-"))
    return context.getCheckpointDir().rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    Unlike a checkpointed RDD the copy is columnar and compressed, later readers prune its columns,
    and Spark knows its size, so a join broadcasts it only when it is small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _folders[back] = path
    return back


def reading(df: DataFrame, held: DataFrame) -> DataFrame:
    """df, made of a frame that `stored` gave: discarding it deletes that frame's folder."""
    if held in _folders:
        _folders[df] = _folders[held]
    return df


def discard(df: DataFrame) -> None:
    """Deletes the folder of a frame that `stored` gave, when all that was made of it is itself stored."""
    path = _folders.pop(df, None)
    if path is not None:
        remove(df.sparkSession, path)
