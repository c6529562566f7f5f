"""Work that remembers what it has done: checkpoints of parsed scripts, by batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.plans.pipeline import parse
from strandline.storage import drop_path


def latest(rows: DataFrame, key: Sequence[str] = ("script_name",), order: Sequence[str] = ("at",)) -> DataFrame:
    """The last record of each key; records without a key don't count."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*(F.col(c).desc() for c in order)))
    return rows.filter(" and ".join(f"`{k}` is not null" for k in key)).withColumn("rank", rank).filter("rank = 1").drop("rank")


def read_checkpoint(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The latest record of each script in a file of JSON lines; lines that are no JSON are skipped. Lines count in file order."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    parsed = lines.select("at", F.from_json("value", schema).alias("r")).select("at", "r.*")
    return latest(parsed).drop("at")


def pending(scripts: DataFrame, done: DataFrame, key: str = "script_name") -> DataFrame:
    """Scripts that aren't done."""
    return scripts.join(done.select(key), key, "left_anti")


def evicted(done: DataFrame, names: Sequence[str], key: str = "script_name") -> DataFrame:
    """A checkpoint without the scripts to do again."""
    again = done.sparkSession.createDataFrame([(n,) for n in names], f"{key} string")
    return done.join(again, key, "left_anti")


def reset(spark: SparkSession, path: str) -> None:
    drop_path(spark, path)


def parse_pending(scripts: DataFrame, checkpoint: str, **options) -> DataFrame:
    """Parse what the checkpoint table lacks, append it, and give all of it back: a stopped run goes on where it was."""
    spark = scripts.sparkSession
    try:
        done = spark.read.parquet(checkpoint).select("script_name").distinct()
        todo = pending(scripts, done)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        todo = scripts
    parse(todo, **options).write.mode("append").parquet(checkpoint)
    return spark.read.parquet(checkpoint)


def parse_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, **options) -> None:
    """Parse the scripts that are new in ``folder`` since the last call, into ``out``; what is done is remembered by the stream's checkpoint."""
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.[sS][hH]").load(folder)
    scripts = stream.select(F.element_at(F.split("path", "/"), -1).alias("script_name"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))

    def each(batch: DataFrame, number: int) -> None:
        parse(batch, **options).withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    scripts.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
