"""The load patterns that analysed scripts contain, as DataFrame operators that can run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def nth_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (...) = n."""
    return numbered(df, keys, order, "nth row").filter(F.col("nth row") == n).drop("nth row")


def later_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (...) > 1: all but the first."""
    return numbered(df, keys, order, "nth row").filter(F.col("nth row") > 1).drop("nth row")


def top_with_ties(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """QUALIFY 1 = RANK() OVER (... ORDER BY value DESC), by a maximum joined back: partial sums and no sort. Nulls rank last."""
    best = df.groupBy(*keys).agg(F.max(value).alias("best value")).alias("best")
    same = F.col(f"own.{value}").eqNullSafe(F.col("best.best value"))
    for k in keys:
        same &= F.col(f"own.{k}").eqNullSafe(F.col(f"best.{k}"))
    return df.alias("own").join(best, same).select("own.*")


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``, by a maximum of structs: combined before the shuffle, so hot keys do no harm."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("last row"))
    return best.select(*keys, "last row.*").select(*df.columns)


def code_lookup(df: DataFrame, codes: DataFrame, on: Column, value: str, alias: str, default: Column) -> DataFrame:
    """A code's translation, or a default where there is none; a code with several translations gives a row for each, as the outer join does."""
    return df.join(codes, on, "left").withColumn(alias, F.coalesce(F.col(value), default))


def insert_new(source: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """LEFT JOIN ... WHERE key IS NULL: source rows whose key the target lacks."""
    return source.join(target, list(on), "left_anti")


def not_in(source: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """NOT IN (subquery), null-aware: no row where a value is null, none for a null column unless there are no values."""
    value = values.columns[0]
    has = values.agg(F.count_if(F.col(value).isNull()).alias("nulls"), F.count("*").alias("n"))
    left = source.join(values, source[column] == values[value], "left_anti").crossJoin(F.broadcast(has))  # one row
    return left.filter((F.col("n") == 0) | (F.col("nulls") == 0) & F.col(column).isNotNull()).drop("nulls", "n")


def delete_keys(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """DELETE ... WHERE (a, b, ...) IN (SELECT ...): the rows that stay."""
    return target.join(keys.select(*on).distinct(), list(on), "left_anti")


def delete_where(target: DataFrame, other: DataFrame, condition: Column) -> DataFrame:
    """DELETE b FROM a, b WHERE ...: the rows of b that no row of a meets. The condition has an equality, the rest is residual."""
    return target.join(other, condition, "left_anti")


def older(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "older") -> DataFrame:
    """With the number of rows of the same key that are lexicographically less over several columns: a rank, no pairs."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def one_each(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The source, checked as it is read: a key that stands twice is an error, as a target row would be written twice."""
    rest = [c for c in source.columns if c not in on]
    by_key = source.groupBy(*on).agg(F.count("*").alias("rows of key"), F.first(F.struct(F.lit(1).alias("rest of row"), *rest)).alias("row of key"))
    single = F.when(F.col("rows of key") == 1, True).otherwise(F.raise_error(F.lit("a key stands twice in the source of an update or merge")).cast("boolean"))
    return by_key.filter(single).select(*on, *(F.col(f"row of key.{c}").alias(c) for c in rest)).select(*source.columns)


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], sets: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... FROM: columns of matched rows set, the others as they were. A key that the source has twice is an error."""
    src = one_each(source, on).withColumn("matched row", F.lit(True))
    met = target.alias("t").join(src.alias("s"), list(on), "left")
    out = [F.when(F.col("matched row"), sets[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in sets else F.col(c if c in on else f"t.{c}").alias(c) for c in target.columns]
    return met.select(*out)


def upsert(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """MERGE: matched rows take the source's columns, new ones are added. A key that the source has twice is an error."""
    keep = target.join(source.select(*on), list(on), "left_anti")
    return keep.select(*target.columns).unionByName(one_each(source, on).select(*target.columns))


def unpivot(df: DataFrame, ids: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """One row for each column of ``values``, with its name, as the cross join with a list of numbers gives."""
    pairs = F.array(*(F.struct(F.lit(k).alias("attribute"), v.cast("string").alias("value")) for k, v in values.items()))
    return df.select(*ids, F.explode(pairs).alias("p")).select(*ids, "p.attribute", "p.value")
