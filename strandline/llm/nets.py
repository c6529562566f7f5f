"""Small numpy networks: the optimiser, and training samples of a fixed bound."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Adam:
    """Updates a dict of arrays in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.003, decay: float = 0.0):
        self.params, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(p) for k, p in params.items()}
        self.v = {k: np.zeros_like(p) for k, p in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            unit = self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            self.params[k] -= self.rate * (unit + self.decay * self.params[k])


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of


def bounded(rows: DataFrame, class_col: str, key_cols: list[str], per_class: int, body_col: str | None = None, most_bytes: int = 64 << 20, longest: int = 1 << 20, most_classes: int = 200) -> DataFrame:
    """Distinct rows of class_col and key_cols: ``per_class`` of each class at most, chosen by a hash of the keys.

    Classes beyond the ``most_classes`` with the most rows aren't sampled. With ``body_col`` (one of the keys, binary), values
    longer than ``longest`` bytes aren't sampled and all values together have ``most_bytes`` at most; those sampled are whole.
    So what a driver gets has a fixed bound, whatever repeats: equal rows count once and are combined before they move.
    """
    keyed = rows.select(F.col(class_col).alias("class"), *key_cols).withColumn("h", F.xxhash64(F.lit("sample"), *key_cols))
    if body_col:
        keyed = keyed.filter(F.octet_length(body_col) <= longest)
    found = keyed.groupBy("class").agg(F.approx_count_distinct("h").alias("n"), F.count("*").alias("rows")).orderBy(F.desc("rows"), "class").limit(most_classes).collect()
    steps = 1 << 30
    low = [(r["class"], math.ceil(min(1.0, 1.3 * per_class / max(r["n"], 1)) * steps)) for r in found]
    limits = rows.sparkSession.createDataFrame(low, f"class {rows.schema[class_col].dataType.simpleString()}, below long")
    some = keyed.join(F.broadcast(limits), keyed["class"].eqNullSafe(limits["class"])).filter(F.pmod("h", F.lit(steps)) < F.col("below")).select(keyed["class"], *key_cols, "h")
    once = some.groupBy("class", "h").agg(*(F.first(k).alias(k) for k in key_cols))
    order = Window.partitionBy("class").orderBy("h")
    kept = once.withColumn("place", F.row_number().over(order))
    if body_col:
        kept = kept.withColumn("held", F.sum(F.octet_length(body_col).cast("long")).over(order)).filter(F.col("held") <= most_bytes // max(len(found), 1))
    return kept.filter(F.col("place") <= per_class).select(F.col("class").alias(class_col), *key_cols)
