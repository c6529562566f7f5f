"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a new local folder where it is unset and driver and executors are one process, else an error."""
    sc = spark.sparkContext
    held = spark.conf.get("spark.checkpoint.dir", None)
    if held is None:
        held = sc.getCheckpointDir()
    if held is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        held = "file://" + tempfile.mkdtemp(prefix="strandline-")
        sc.setCheckpointDir(held)
    return held.rstrip("/")


#: Folders that this process wrote, for :func:`release`.
_HELD: set[str] = set()


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new folder's name, which :func:`release` deletes."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _HELD.add(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete all that this process wrote to the shared folder, once its results have been used."""
    for path in list(_HELD):
        drop_path(spark, path)


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends here, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, whatever store it lies in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _HELD.discard(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
