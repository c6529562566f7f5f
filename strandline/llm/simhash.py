"""SimHash near-duplicates by exact tiled comparison.

Fingerprints: the majority vote, bit by bit, of the XXH64 of a text's word shingles. Two fingerprints link
at ``radius`` or fewer differing bits, and every such pair is found: distinct fingerprints are cut into
tiles, a tile pair is compared with numpy's exclusive-or and bit counts, and tile pairs whose population
counts differ by more than the radius are skipped. Tiles lie within cells of a fixed size, which hold whole
groups of fingerprints that agree in all but ``radius`` of ``blocks`` bit ranges (a pair that differs in at
most ``radius`` bits agrees in one such choice of ranges at least), so the number of tile pairs grows with
the number of fingerprints, not with its square. A group beyond a cell is dealt over several, so that no
task gets an unbounded group. Cells give a spanning forest of their links, never all pairs; stars are then
contracted until each fingerprint points at its component's smallest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import drop_path, fresh_path, met, slices, table, written

SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, words: int = 3) -> int:
    """Of UTF-8 bytes: A-Z lowered, words between ASCII blanks, shingles with repeats; 0 for no words."""
    w = text.lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
    ones = sum(np.unpackbits(h[i : i + CHUNK].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64) for i in range(0, len(h), CHUNK))
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, keep: dict[str, Column], words: int = 3) -> DataFrame:
    """One row for each document: the columns of ``keep`` and ``fp``, its fingerprint as a signed long.

    Null and empty texts, and those of blanks alone, have fingerprint 0.
    """
    rows = docs.select(*(c.alias(k) for k, c in keep.items()), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    names = list(keep)
    schema = rows.drop("body").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for b in slices(batches):
            fp = np.fromiter((fingerprint(t, words) for t in b.column("body").to_pylist()), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(fp.view(np.int64))], [*names, "fp"])

    return rows.mapInArrow(run, schema)


def _propagate(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n over links i-j."""
    label = np.arange(n)
    while True:
        was = label.copy()
        np.minimum.at(label, j, label[i])
        np.minimum.at(label, i, label[j])
        label = label[label]
        if np.array_equal(was, label):
            return label


def _forest(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    label = _propagate(len(nodes), at[: len(i)], at[len(i) :])
    off = label != np.arange(len(nodes))
    return fp[nodes[off]], fp[nodes[label[off]]]


def compare_tiles(fp: np.ndarray, radius: int, tile: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int, int]:
    """(links, tile pairs compared, tile pairs skipped) of one cell; fp is in order of population count, each value once.

    Links are the forests of the tile pairs. A pair of tiles whose population counts differ by more than the radius can't
    have a link, nor can any later tile with the same first one.
    """
    pop, found, compared = np.bitwise_count(fp), [], 0
    n = -(-len(fp) // tile)
    for a in range(0, len(fp), tile):
        x = fp[a : a + tile]
        top = int(pop[min(a + tile, len(fp)) - 1])
        for b in range(a, len(fp), tile):
            if int(pop[b]) - top > radius:
                break
            compared += 1
            hit = np.bitwise_count(x[:, None] ^ fp[None, b : b + tile]) <= radius
            i, j = np.nonzero(np.triu(hit, 1) if a == b else hit)
            if len(i):
                found.append(_forest(fp, i + a, j + b))
    return found, compared, n * (n + 1) // 2 - compared


#: Fingerprints of a cell, about, and of the tiles that it is cut into.
CELL, TILE = 2048, 128


def cells(fps: DataFrame, radius: int, blocks: int, cell: int) -> DataFrame:
    """Columns cell, fp: every two distinct fingerprints within the radius are together in a cell of about ``cell`` at least once.

    ``blocks``: into how many bit ranges fingerprints are cut; more blocks mean smaller groups and more of them. Groups (that
    agree in all but ``radius`` ranges) are dealt whole to as many cells as their rows need; what lies in one cell by chance is
    compared as well. A group that alone is beyond a cell is cut by a hash into halves of cells, and every two halves meet.
    """
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        m = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    number = max(1, -(-fps.count() * len(masks) // cell))
    keyed = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "key"))
    at = F.xxhash64("mask", "key")
    hot = written(keyed.groupBy("mask", "key").count().filter(F.col("count") > cell), "simhash-hot")
    if hot.isEmpty():
        return keyed.select(F.pmod(at, F.lit(number)).alias("cell"), "fp")
    halves = F.ceil(F.col("count") * 2 / cell).cast("int")
    dealt = keyed.join(hot, ["mask", "key"], "left").select("mask", "key", "fp", F.coalesce(halves, F.lit(1)).alias("n"))
    dealt = dealt.withColumn("t", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    dealt = dealt.select("mask", "key", "fp", "n", "t", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("u"))
    own = F.when(F.col("n") == 1, F.pmod(at, F.lit(number))).otherwise(F.xxhash64("mask", "key", F.least("t", "u"), F.greatest("t", "u")))
    return dealt.select(own.alias("cell"), "fp")


def _compared(fps: DataFrame, radius: int, blocks: int, cell: int, tile: int, report: bool) -> DataFrame:
    dealt = cells(fps, radius, blocks, cell).repartition("cell").sortWithinPartitions("cell", F.bit_count("fp"), "fp")

    def run(batches):
        def out(parts):
            done = [compare_tiles(x[np.append(True, x[1:] != x[:-1])], radius, tile) for x in parts]
            if report:
                cols = [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(cols, ["compared", "skipped"])
            elif found := [x for d in done for x in d[0]]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in found]).view(np.int64)) for k in (0, 1)], ["a", "b"])

        at, fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)  # the last cell may go on in the next batch
        for b in batches:
            at = np.concatenate([at, b.column("cell").to_numpy()])
            fp = np.concatenate([fp, b.column("fp").to_numpy().view(np.uint64)])
            new = np.flatnonzero(at[1:] != at[:-1]) + 1
            if len(new):
                yield from out(np.split(fp[: new[-1]], new[:-1]))
                at, fp = at[new[-1] :], fp[new[-1] :]
        if len(fp):
            yield from out([fp])

    return dealt.mapInArrow(run, "compared long, skipped long" if report else "a long, b long")


def links(fps: DataFrame, radius: int = 3, blocks: int = 5, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """Columns a, b: links among the distinct values of ``fps.fp`` (a written table) that join all that any link joins.

    An empty table gives no links.
    """
    return _compared(fps, radius, blocks, cell, tile, False).distinct()


def tile_pairs(fps: DataFrame, radius: int = 3, blocks: int = 5, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """One row: how many tile pairs :func:`links` compares, and how many it skips by their population counts."""
    return _compared(fps, radius, blocks, cell, tile, True).agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))


def contract(edges: DataFrame) -> DataFrame:
    """Columns node, root: each end of a link (of any one type) and its component's smallest end.

    Large stars, then small stars, until nothing changes; every round is a written table, and the one before it goes.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b"), F.col("a"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        each = both.join(low, "a")
        if large:
            return each.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return each.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    def put(e: DataFrame) -> tuple[DataFrame, str]:
        e.write.parquet(path := fresh_path(spark, "simhash-stars"))
        return spark.read.schema(edges.select("a", "b").schema).parquet(path), path

    now, path = put(edges.filter("a <> b").select("a", "b"))
    was = None
    while (is_now := state(now)) != was:
        was, old = is_now, path
        now, path = put(star(star(now, True), False))
        drop_path(spark, old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def components(rows: DataFrame, id_col: str = "doc_id", radius: int = 3, blocks: int = 5) -> DataFrame:
    """Columns fp, n, component_id for each distinct fp of a written table: how many rows have it, and the smallest id that links reach.

    Null ids count only where a component has no other; its component_id is then null.
    """
    firsts = written(rows.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count("*").alias("rows")), "simhash-firsts")
    member = contract(links(firsts.select("fp"), radius, blocks))
    rooted = written(firsts.join(member.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", "rows", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    return written(met(rooted.select("fp", "rows", "root"), least, ["root"], rooted.count()).select("fp", F.col("rows").alias("n"), "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """One row for each row of ``docs``: its id, ``fp`` and ``component_id``.

    Repeated rows and equal texts share a fingerprint and so a component. Null, empty and blank texts have fingerprint 0,
    which links like any other. A text of any length counts whole, its shingles in parts of CHUNK at a time. Rows with a null id
    take part; other columns are ignored. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, text_col, {id_col: F.col(id_col)}, words), "simhash-rows")
    return met(rows, components(rows, id_col, radius), ["fp"], rows.count()).select(id_col, "fp", "component_id")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
