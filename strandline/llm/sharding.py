"""Reproducible sharding by a Feistel permutation with cycle walking, in DataFrame operations only.

Rows get global row numbers in the order of a hash of id and text: a count for each of a fixed number of
hash buckets gives each bucket's first number, a window within the bucket the rest, so no sort has a
global range and no task more than a bucket; rows equal in id and text are counted first, and are one row of the
window. A keyed Feistel network over Z_a x Z_a, a = ceil(sqrt(n)),
permutes the numbers; those that leave [0, n) walk on along their cycle until they return. The permuted
number p gives shard p mod k and slot p div k, which :func:`locate` computes for any row number and
:func:`row_at` inverts, without a look at the data.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME = 2**31 - 1
ROUNDS = 6
#: Hash buckets, and so the most rows that a count sends to the driver.
BUCKET_BITS = 12
#: Equal rows that one task writes out at a time.
PART = 1 << 20
WALK = 64


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Multipliers and offsets below PRIME, from the seed alone."""
    keys = []
    for r in range(rounds):
        d = hashlib.sha256(f"{seed}:{r}".encode()).digest()
        keys.append(tuple(1 + int.from_bytes(d[i : i + 8], "big") % (PRIME - 1) for i in (0, 8, 16)))
    return keys


def side(n: int) -> int:
    return max(1, math.isqrt(max(n, 1) - 1) + 1)


def _f(r: int, key: tuple[int, int, int]) -> int:
    y = (r % PRIME * key[0] + key[1]) % PRIME
    return (y * y % PRIME * key[2] + y) % PRIME


def permute(x: int, n: int, seed: int = 42) -> int:
    """Where row number x of n goes."""
    a, keys = side(n), round_keys(seed)
    while True:
        left, right = divmod(x, a)
        for key in keys:
            left, right = right, (left + _f(right, key)) % a
        x = left * a + right
        if x < n:
            return x


def unpermute(p: int, n: int, seed: int = 42) -> int:
    a, keys = side(n), round_keys(seed)
    while True:
        left, right = divmod(p, a)
        for key in reversed(keys):
            left, right = (right - _f(left, key)) % a, left
        p = left * a + right
        if p < n:
            return p


def locate(row: int, n: int, shards: int = 16, seed: int = 42) -> tuple[int, int]:
    """(shard, slot) of a global row number."""
    p = permute(row, n, seed)
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int = 16, seed: int = 42) -> int:
    """The global row number that stands at (shard, slot)."""
    return unpermute(slot * shards + shard, n, seed)


def permuted(number: str, n: int, seed: int = 42) -> Column:
    """:func:`permute` of a bigint column as one SQL expression.

    A cycle leaves [0, n) for at most a*a - n steps; where that is more than WALK, the chance of a longer
    walk is below (2 / sqrt(n)) ** WALK, and such a row raises an error, never a wrong number.
    """
    a = side(n)
    keys = ", ".join(f"named_struct('m', {m}L, 'b', {b}L, 'c', {c}L)" for m, b, c in round_keys(seed))

    def network(x: str, tag: str) -> str:
        s, k = f"s{tag}", f"k{tag}"
        y = f"(({s}.r % {PRIME}L * {k}.m + {k}.b) % {PRIME}L)"
        return (
            f"aggregate(array({keys}), named_struct('l', {x} div {a}L, 'r', {x} % {a}L), ({s}, {k}) -> "
            f"named_struct('l', {s}.r, 'r', ({s}.l + ({y} * {y} % {PRIME}L * {k}.c + {y}) % {PRIME}L) % {a}L), "
            f"{s} -> {s}.l * {a}L + {s}.r)"
        )

    steps = max(1, min(a * a - n, WALK))
    return F.expr(
        f"aggregate(sequence(1, {steps}), {network(number, '1')}, (v, i) -> if(v < {n}L, v, {network('v', '2')}), "
        f"v -> if(v < {n}L, v, cast(raise_error('a cycle was longer than {steps}') as bigint)))"
    )


def shard(docs: DataFrame, shards: int = 16, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its size, checksum, global row number, shard and slot; shard sizes differ by one row at most.

    Null texts count as no bytes; null and repeated ids are rows like others. Rows equal in id and text are
    interchangeable: they get neighbouring row numbers in any order. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"),
    ).withColumn("bucket", F.expr(f"cast(shiftrightunsigned(hash, {64 - BUCKET_BITS}) as int)"))
    held = dict(rows.groupBy("bucket").count().collect())  # 2 ** BUCKET_BITS rows at most
    firsts, n = [], 0
    for b in range(2**BUCKET_BITS):
        firsts.append(str(n))
        n += held.get(b, 0)
    first = F.expr(f"cast(split('{','.join(firsts)}', ',') as array<bigint>)")  # folded to one literal
    same = ["bucket", "hash", "doc_id", "size", "text_crc32"]
    before = Window.partitionBy("bucket").orderBy(*same[1:]).rowsBetween(Window.unboundedPreceding, -1)
    kinds = rows.groupBy(*same).agg(F.count("*").alias("n"))
    kinds = kinds.withColumn("start", F.get(first, F.col("bucket")) + F.coalesce(F.sum("n").over(before), F.lit(0)))
    # rows repeated very often are dealt in parts, the others written out where they are
    parts = kinds.filter(F.col("n") > PART).select("*", F.explode(F.expr(f"sequence(start, start + n - 1, {PART}L)")).alias("at"))
    parts = parts.withColumn("n", F.least(F.col("start") + F.col("n") - F.col("at"), F.lit(PART))).withColumn("start", F.col("at")).repartition("hash", "start")
    numbered = kinds.filter(F.col("n") <= PART).union(parts.select(*kinds.columns))
    numbered = numbered.withColumn("row_number", F.explode(F.expr("sequence(start, start + n - 1)")))
    placed = numbered.withColumn("p", permuted("row_number", n, seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        (F.col("p") % shards).cast("int").alias("shard"),
        F.expr(f"p div {shards}L").alias("slot"),
    )


def op2_feistel(spark, sf_dir: str) -> DataFrame:
    from strandline.llm.common import table

    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )
