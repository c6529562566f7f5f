"""Near-duplicates of a given Jaccard similarity of word shingles, found by SimHash tiles and proved on the shingles.

A text's fingerprint has several words of majority bits, its size is the number of its distinct shingles. Sizes of
texts of similarity s differ by a factor of 1/s at most, so texts are put into geometric size classes and only tiles of
the same or neighbouring classes meet. Tiles of a class are dealt by a hash, as many as its size asks for. A pair of
tiles is compared exactly in numpy, block by block in order of population count: blocks whose counts differ beyond the
radius are skipped, the first word is compared by exclusive-or and bit count, the other words only where the first is
near. A cell gives each text's nearest few links and a spanning forest by distance, never all its pairs; each link is
then proved on the two texts' shingles.

Such a forest is one of unproved links, so a link that it left out can be the only true one. Texts that had a link left out
meet again in a second pass: all pairs within the radius of which the proved links don't join the ends are tested, block by
block, with exact counts from an inverted list of the block's shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import met, slices, written
from strandline.llm.simhash import CHUNK, SEED, contract

WORDS64 = 4
#: Odd multipliers that turn one hash into further independent words: fixed values.
MIX = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
NEAREST = 16
#: Texts of a block of the second pass, and the shingles that one side of it holds about at most.
BLOCK, HELD = 1024, 1 << 20


def shingles(text: bytes, words: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; none for a text without words."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, dtype=np.uint64)
    parts = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in parts), dtype=np.uint64))


def signature(h: np.ndarray) -> np.ndarray:
    """Majority bits of WORDS64 words."""
    ones = np.zeros(64 * WORDS64, dtype=np.int64)
    for i in range(0, len(h), CHUNK):
        x = h[i : i + CHUNK, None] * MIX
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), bitorder="little").view("<u8")


def angle(similarity: float) -> float:
    """The share of bits that differ, as expected of two sets of this similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def radius(similarity: float, bits: int, sigmas: float = 3.0) -> int:
    p = angle(similarity)
    return math.ceil(bits * p + sigmas * math.sqrt(bits * p * (1 - p)))


#: Texts of fewer distinct shingles are compared within a wider radius, as the angle formula is one for many.
FEW = 24


def radii(similarity: float, level: int) -> tuple[int, int]:
    """Of the first word and of all words, for texts of a size class and the one below it."""
    sigmas = 3.0 if (1 / similarity) ** (level + 1) > FEW else 7.0
    return radius(similarity, 64, sigmas), radius(similarity, 64 * WORDS64, sigmas)


def hits(x: np.ndarray, y: np.ndarray, same: bool, first: int, whole: int, block: int = 1024, most: int = 1 << 21, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of pairs within ``whole`` bits whose first words are within ``first``; ``same``: y is x.

    Of a dense block, and of more than ``most`` links, only those that :func:`chosen` takes are held, so that memory is bounded
    by the rows, not by the pairs; a forest of forests' links is a forest of them all. ``cut``, one flag for each row of x (and
    then of y), gets a true for both ends of each link that isn't held.
    """
    shift = 0 if same else len(x)

    def thin(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray, at: int = 0, to: int = 0) -> np.ndarray:
        k = chosen(n, i, j, d)
        if cut is not None:
            left = np.delete(np.arange(len(i)), k)
            cut[i[left] + at] = True
            cut[j[left] + to] = True
        return k

    px, py, held = *(np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x, y)), 0
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(x), block):
        p, top, low = x[a : a + block], px[a : a + block].max(), px[a : a + block].min()
        for b in range(a if same else 0, len(y), block):
            if py[b] - top > whole or low - py[min(b + block, len(y)) - 1] > whole:
                continue
            q = y[b : b + block]
            near = np.bitwise_count(p[:, 0][:, None] ^ q[:, 0][None]) <= first
            i, j = np.nonzero(np.triu(near, 1) if same and a == b else near)
            if len(i):
                d = np.bitwise_count(p[i] ^ q[j]).sum(1, dtype=np.int64)
                k = d <= whole
                i, j, d = i[k], j[k], d[k]
                if len(i) > 8 * block:  # a dense block: what matters of it is little
                    off = 0 if same and a == b else block
                    k = thin(2 * block, i, j + off, d, a, b - off + shift)
                    i, j, d = i[k], j[k], d[k]
                out.append((i + a, j + b, d))
                held += len(i)
                if held > most:
                    i, j, d = (np.concatenate(v) for v in zip(*out, strict=True))
                    k = thin(len(x) + len(y), i, j + shift, d)
                    out, held = [(i[k], j[k], d[k])], len(k)
                    most = max(most, 2 * held)
    if not out:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def chosen(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which links go on: each text's nearest few, and a forest of the shortest that joins all that any link joins."""
    order = np.lexsort((j, i, d))
    parent = list(range(n))
    used = [0] * n

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    keep = []
    for k, a, b in zip(order.tolist(), i[order].tolist(), j[order].tolist(), strict=True):
        few = used[a] < NEAREST or used[b] < NEAREST
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
        if few or ra != rb:
            used[a] += 1
            used[b] += 1
            keep.append(k)
    return np.array(keep, dtype=np.int64)


def text_key(c: Column) -> Column:
    """Sixteen bytes that stand for a text."""
    return F.unhex(F.md5(c.cast("binary")))


#: Bits of the filter below, and so its greatest size: 16 MB in rows of 4 kB.
FILTER_BITS = 1 << 27


def flagged(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` with ``flagged``: false where the key is surely not in ``wanted``. Its size is bounded whatever ``wanted`` holds; an exact join of the flagged rows follows."""
    at = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("filter bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("filter bits"))
    met = rows.withColumn("filter at", at).withColumn("filter bucket", F.bitmap_bucket_number("filter at")).join(F.broadcast(bits), "filter bucket", "left")
    place = F.bitmap_bit_position("filter at")
    byte = F.conv(F.hex(F.substring(F.col("filter bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(`filter byte`, cast(`filter place` % 8 as int)) & 1") == 1
    met = met.withColumn("filter place", place).withColumn("filter byte", byte)
    return met.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("flagged"))


def signatures(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """key (of the text), size and sig of each distinct text; null is an empty text."""
    bodies = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body"))

    def run(batches):
        for b in slices(batches):
            h = [shingles(t.encode(), words) for t in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(x) for x in h], pa.int64()), pa.array([signature(x).tobytes() for x in h], pa.binary())], ["key", "size", "sig"])

    return bodies.select(text_key(F.col("body")).alias("key"), "body").mapInArrow(run, "key binary, size long, sig binary").groupBy("key").agg(F.first("size").alias("size"), F.first("sig").alias("sig"))


def cells(texts: DataFrame, similarity: float, each, schema: str, extra: tuple[str, ...] = (), least_tile: int = 1024, most_tile: int = 1 << 18, grid: int = 16) -> DataFrame:
    """What ``each`` gives of every cell of a written table of signatures.

    It takes the cell's numbers (la, ta, lb, tb), the columns key and ``extra`` as lists, sig, and how many rows are the first
    tile's; each tile's rows are in order of population count.
    """
    level = F.when(F.col("size") == 0, -1).otherwise(F.floor(F.log(F.col("size").cast("double")) / math.log(1 / similarity))).cast("int")
    classed = texts.withColumn("level", level)
    counts = dict(classed.groupBy("level").count().collect())  # one row for each power of 1/similarity
    tile = min(max(sum(counts.values()) // grid, least_tile), most_tile)
    tiles = {k: -(-n // tile) for k, n in counts.items()}
    n_of = F.create_map(*(F.lit(x) for k, v in (tiles or {0: 1}).items() for x in (k, v)))
    own = classed.withColumn("n", F.element_at(n_of, F.col("level"))).withColumn("t", F.pmod(F.xxhash64("key"), F.col("n")).cast("int"))
    # a cell is (class, tile, class above or same, tile); a text is in the cells of its tile with its class's tiles and its neighbours'
    count = lambda c: F.coalesce(F.try_element_at(n_of, c), F.lit(0))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    lv, t = F.col("level"), F.col("t")
    inside = F.transform(upto(F.col("n")), lambda u: F.struct(lv.alias("la"), F.least(t, u).alias("ta"), lv.alias("lb"), F.greatest(t, u).alias("tb")))
    above = F.transform(upto(count(lv + 1)), lambda u: F.struct(lv.alias("la"), t.alias("ta"), (lv + 1).alias("lb"), u.alias("tb")))
    below = F.transform(upto(count(lv - 1)), lambda u: F.struct((lv - 1).alias("la"), u.alias("ta"), lv.alias("lb"), t.alias("tb")))
    dealt = own.select("key", *extra, "sig", (F.col("level") * (1 << 20) + t).alias("own"), F.explode(F.concat(inside, above, below)).alias("cell"))
    dealt = dealt.select("cell.*", "own", "key", *extra, "sig").repartition("la", "ta", "lb", "tb").sortWithinPartitions("la", "ta", "lb", "tb", "own", "key")

    def cell(at: tuple[int, ...], cols: list[list], own: np.ndarray, sig: np.ndarray):
        by = np.lexsort((np.bitwise_count(sig).sum(1), own))
        cols, own, sig = [[c[k] for k in by] for c in cols], own[by], sig[by]
        yield from each(at, *cols, sig, int(np.searchsorted(own, own[0], side="right")))

    def run(batches):
        held_id, cols, own, sig = None, [], [], []
        for b in batches:
            ids = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in ("la", "ta", "lb", "tb")], 1)
            starts = [0, *(np.flatnonzero(np.any(ids[1:] != ids[:-1], axis=1)) + 1).tolist(), len(ids)] if len(ids) else [0]
            bc, bo, bs = [b.column(c).to_pylist() for c in ("key", *extra)], b.column("own").to_numpy(zero_copy_only=False), b.column("sig").to_pylist()
            for x, z in zip(starts, starts[1:], strict=False):
                now = tuple(ids[x].tolist())
                if now != held_id:
                    if own:
                        yield from cell(held_id, cols, np.concatenate(own), np.concatenate(sig))
                    held_id, cols, own, sig = now, [[] for _ in bc], [], []
                for c, v in zip(cols, bc, strict=True):
                    c += v[x:z]
                own.append(bo[x:z])
                sig.append(np.frombuffer(b"".join(bs[x:z]), dtype="<u8").reshape(-1, WORDS64))
        if own:
            yield from cell(held_id, cols, np.concatenate(own), np.concatenate(sig))

    return dealt.mapInArrow(run, schema)


def candidates(texts: DataFrame, similarity: float, **tiles) -> DataFrame:
    """Columns a, b, cut: links to prove, from a written table of signatures; where cut, a is a text that had a link left out (and b the same)."""

    def each(at: tuple[int, ...], keys: list[bytes], sig: np.ndarray, split: int):
        first, whole = radii(similarity, max(at[0], at[2]))
        same, out = split == len(keys), np.zeros(len(keys), dtype=bool)
        i, j, d = hits(sig[:split], sig if same else sig[split:], same, first, whole, cut=out)
        j = j if same else j + split
        if len(i):
            k = chosen(len(keys), i, j, d)
            left = np.delete(np.arange(len(i)), k)
            out[i[left]] = True
            out[j[left]] = True
            some = np.flatnonzero(out).tolist()
            a, b = (pa.array([keys[x] for x in [*v[k].tolist(), *some]], pa.binary()) for v in (i, j))
            yield pa.RecordBatch.from_arrays([a, b, pa.array([False] * len(k) + [True] * len(some), pa.bool_())], ["a", "b", "cut"])

    return cells(texts, similarity, each, "a binary, b binary, cut boolean", **tiles).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "cut").distinct()


#: What names a block of the second pass.
PLACE = ["la", "ta", "lb", "tb", "x", "y"]


def untested(texts: DataFrame, similarity: float) -> DataFrame:
    """PLACE, side and key: blocks of the texts (key, group, size, sig) that have a pair within the radius of two groups."""

    def each(at: tuple[int, ...], keys: list[bytes], groups: list[bytes], sig: np.ndarray, split: int):
        whole = radii(similarity, max(at[0], at[2]))[1]
        count = np.bitwise_count(sig).sum(1, dtype=np.int64)
        group = np.unique(np.array([g.hex() for g in groups]), return_inverse=True)[1]
        same, size = split == len(keys), (1 / similarity) ** (max(at[0], at[2]) + 1)
        block = max(1, min(BLOCK, int(HELD / size)))
        for a in range(0, split, block):
            p = slice(a, min(a + block, split))
            for b in range(a if same else split, len(keys), block):
                q = slice(b, b + block)
                if count[q].min() - count[p].max() > whole or count[p].min() - count[q].max() > whole:
                    continue
                near = group[p][:, None] != group[q][None]
                if near.any():
                    d = np.zeros(near.shape, dtype=np.uint16)
                    for w in range(WORDS64):
                        d += np.bitwise_count(sig[p, w][:, None] ^ sig[q, w][None])
                    near &= d <= whole
                one, two = np.flatnonzero(near.any(1)) + a, np.flatnonzero(near.any(0)) + b
                if len(one):
                    two = two[:0] if same and a == b else two
                    rows = np.concatenate([one, two]).tolist()
                    place = [pa.array(np.full(len(rows), v, dtype=np.int32)) for v in (*at, a, b)]
                    yield pa.RecordBatch.from_arrays([*place, pa.array([0] * len(one) + [1] * len(two), pa.int32()), pa.array([keys[k] for k in rows], pa.binary())], [*PLACE, "side", "key"])

    return cells(texts, similarity, each, ", ".join(f"{c} int" for c in [*PLACE, "side"]) + ", key binary", ("group",))


def forest(x: list[np.ndarray], y: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join all that pairs of the similarity join, of sets x with y, or among x where y is empty; j counts on from x."""
    held, shift = (y, len(x)) if y else (x, 0)
    sizes = np.array([len(h) for h in held])
    listed, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
    by = np.argsort(listed)
    listed, owner = listed[by], owner[by]
    label, out = np.arange(len(x) + len(y)), []
    for i, h in enumerate(x):
        low = np.searchsorted(listed, h)
        n = np.searchsorted(listed, h, side="right") - low
        both = np.bincount(owner[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(held))
        good = np.flatnonzero(both >= similarity * (len(h) + sizes - both)) + shift
        other, at = np.unique(label[good], return_index=True)
        for k, j in zip(other.tolist(), good[at].tolist(), strict=True):
            if k != label[i]:
                out.append((i, j))
                label[label == k] = label[i]
    return out


def bodies(ends: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """key and body, once for each key of ``ends``; only these texts move."""
    body = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body")).withColumn("key", text_key(F.col("body")))
    body = flagged(body, ["key"], ends).filter("flagged").drop("flagged")
    # copies are one row before they move; then false hits of the filter go
    return written(body.groupBy("key").agg(F.first("body").alias("body")).join(ends, "key", "left_semi"), "similar-texts")


def proved_blocks(blocks: DataFrame, docs: DataFrame, text_col: str, words: int, similarity: float) -> DataFrame:
    """Columns a, b: links that join what pairs of the similarity join within each of the written blocks."""
    texts = bodies(written(blocks.select("key").distinct(), "similar-ends"), docs, text_col)
    dealt = blocks.join(texts, "key").select(*PLACE, "side", "key", "body").repartition(*PLACE).sortWithinPartitions(*PLACE, "side", "key")

    def block(keys: list[list[bytes]], sets: list[list[np.ndarray]]):
        if found := forest(*sets, similarity):
            both = keys[0] + keys[1]
            yield pa.RecordBatch.from_arrays([pa.array([both[v[k]] for v in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    def run(batches):
        held_id, keys, sets = None, [[], []], [[], []]
        for b in slices(batches):
            ids = zip(*(b.column(c).to_pylist() for c in PLACE), strict=True)
            for now, side, key, body in zip(ids, *(b.column(c).to_pylist() for c in ("side", "key", "body")), strict=True):
                if now != held_id:
                    if held_id:
                        yield from block(keys, sets)
                    held_id, keys, sets = now, [[], []], [[], []]
                keys[side].append(key)
                sets[side].append(shingles(body.encode(), words))
        if held_id:
            yield from block(keys, sets)

    return dealt.mapInArrow(run, "a binary, b binary")


def proved(links: DataFrame, docs: DataFrame, text_col: str, words: int, similarity: float) -> DataFrame:
    """Links whose texts have the similarity; only texts with a link move."""
    ends = written(links.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "similar-ends")
    texts = bodies(ends, docs, text_col)
    pairs = links.join(texts.select(F.col("key").alias("a"), F.col("body").alias("body_a")), "a").join(texts.select(F.col("key").alias("b"), F.col("body").alias("body_b")), "b")

    def run(batches):
        for b in slices(batches):
            good, held = [], {}
            for pair in zip(*(b.column(c).to_pylist() for c in ("a", "body_a", "b", "body_b")), strict=True):
                for k, t in (pair[:2], pair[2:]):
                    if k not in held:
                        held[k] = shingles(t.encode(), words)
                p, q = held[pair[0]], held[pair[2]]
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(both >= similarity * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "body_a", "body_b").mapInArrow(run, "a binary, b binary")


def classes(docs: DataFrame, text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """node and root: texts (by key) that have a near-duplicate, and their group; texts without one aren't there."""
    texts = written(signatures(docs, text_col, words), "similar-signatures")
    found = written(candidates(texts, similarity), "similar-links")
    near = contract(proved(found.filter("not cut").select("a", "b"), docs, text_col, words, similarity))
    cut = found.filter("cut").select(F.col("a").alias("key"))
    if cut.isEmpty():
        return near
    again = texts.join(cut, "key", "left_semi").join(near.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("group"), "size", "sig")
    blocks = written(untested(written(again, "similar-again"), similarity), "similar-blocks")
    if blocks.isEmpty():
        return near
    more = proved_blocks(blocks, docs, text_col, words, similarity)
    return contract(near.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` less all but one of each group: that with the smallest id (nulls last).

    Equal texts are one group; texts without words (null, empty, blank) are one group as well. Of rows with one id and different
    columns the first by a hash of all columns stays, of rows equal in every column one. Texts of any length count whole. An
    empty table gives no rows, extra columns pass through whatever their names.
    """
    mark, key = F.xxhash64(*docs.columns), text_key(F.coalesce(F.col(text_col), F.lit("")))
    rows = written(docs.select(F.col(id_col).alias("doc"), mark.alias("mark"), key.alias("key")).groupBy("doc", "mark", "key").agg(F.count("*").alias("n")), "similar-rows")
    member = classes(docs, text_col, words, similarity).select(F.col("node").alias("key"), "root")
    # combined by text before the join, so that a text with very many copies is one row of it
    each = rows.groupBy("key").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "mark")).alias("kept"), F.sum("n").alias("copies"), F.count("*").alias("rows"))
    grouped = written(each.join(member, "key", "left").select("key", "kept", "copies", "rows", F.coalesce("root", "key").alias("group")), "similar-groups")
    best = grouped.groupBy("group").agg(F.min("kept").alias("kept"), F.sum("copies").alias("copies"), F.count("*").alias("n")).filter("copies > 1").drop("copies")
    several = met(grouped.select("key", "rows", "group"), best, ["group"], grouped.count())
    several = written(several.select("key", F.col("rows").alias("n"), F.col("kept.doc").alias("kept_doc"), F.col("kept.mark").alias("kept_mark")), "similar-several")
    those = met(rows.withColumnRenamed("n", "copies"), several, ["key"], rows.count())
    best_row = F.col("doc").eqNullSafe(F.col("kept_doc")) & (F.col("mark") == F.col("kept_mark"))
    gone = written(those.select("doc", "mark", best_row.alias("best"), "copies").filter("not best or copies > 1"), "similar-gone")
    # rows that are surely kept stay where they are; the others move by their id and mark
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.select("*", mark.alias("row mark")).toDF(*names, "mark").withColumn("doc", F.col(names[docs.columns.index(id_col)]))
    split = flagged(own, ["doc", "mark"], gone)
    # equal rows are one before they move
    once = split.filter("flagged").groupBy("mark", "doc").agg(F.first(F.struct(*names)).alias("row")).alias("o")
    once = once.join(gone.filter("not best").alias("g"), (F.col("o.mark") == F.col("g.mark")) & F.col("o.doc").eqNullSafe(F.col("g.doc")), "left_anti").select("row.*")
    return split.filter("not flagged").select(*names).union(once.select(*names)).toDF(*docs.columns)
