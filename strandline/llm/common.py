"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.storage import drop_path, fresh_path, shared_dir, table, written

__all__ = ["drop_path", "fresh_path", "met", "shared_dir", "slices", "table", "written"]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python holds of them at a time stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: A key is hot with more than this part of the rows.
HOT = 1024


def met(rows: DataFrame, one: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``one``, which has each key once and, as ``n``, how many of the rows have it; an inner join without null keys.

    ``total``: the number of rows, or more. Fewer than HOT keys can have more than a part of 1 / HOT of them; these are joined
    by broadcast, and their rows then dealt by all columns, so that no task gets all rows of a hot key.
    """
    given = F.struct(*(c for c in one.columns if c not in (*on, "n")))
    hot = F.col("n") * HOT > total
    few = one.filter(hot).select(*on, given.alias("met few"))
    rest = one.filter(~hot).select(*on, F.lit(0).cast("long").alias("met deal"), given.alias("met rest"))
    deal = F.when(F.col("met few").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(*rows.columns))
    held = rows.join(F.broadcast(few), on, "left").withColumn("met deal", deal).join(rest, [*on, "met deal"], "left")
    held = held.withColumn("met one", F.coalesce("met few", "met rest")).filter("`met one` is not null")
    return held.select(*rows.columns, "met one.*")
