"""Files of equal content: which to keep, which could go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(files: DataFrame, key: str = "md5", name: str = "name") -> DataFrame:
    """With ``kept`` (the first name of each content) and ``duplicate``. Groups are joined, not windowed, so a content with very many copies stays spread out."""
    first = files.groupBy(key).agg(F.min(name).alias("kept"), F.count("*").alias("copies"))
    return files.join(first, key).withColumn("duplicate", F.col(name) != F.col("kept"))


def groups(files: DataFrame, key: str = "md5", name: str = "name") -> DataFrame:
    """Contents with more than one file: the one kept and how many could go."""
    return files.groupBy(key).agg(F.min(name).alias("kept"), F.count("*").alias("copies")).filter("copies > 1").withColumn("removable", F.col("copies") - 1)


def delete(files: DataFrame, really: bool = False) -> int:
    """Delete the duplicates of :func:`marked` files, if ``really``; how many there are."""
    from strandline.storage import drop_path

    gone = marked(files).filter("duplicate")
    n = 0
    for row in gone.select("path").toLocalIterator():
        n += 1
        if really:
            drop_path(files.sparkSession, row.path)
    return n
