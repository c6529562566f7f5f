"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

Documents become pieces of at most ``capacity`` tokens where they are read; only the pieces' numbers travel.
They are dealt by a hash into blocks of about ``per_block`` documents, whatever the input's partitions are,
and each block is packed by itself: best fit in order of decreasing length, then exchanges between underfull
sequences (move one, one for one, two for one, one for two) that increase the sum of squared fills, until none
does; there is no bound on rounds, partners or pieces. Every such exchange makes fuller sequences fuller and emptier
ones emptier, until the latter vanish. A block wastes about one sequence where lengths are mixed, so the whole stays near
the least number at any size; what remains above it for lengths that don't add up to a sequence is a local optimum.
"""

from __future__ import annotations

import functools
import os
import string
import struct
import zlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table

CAPACITY = 2048
PER_BLOCK = 50_000
#: Pieces of less than a sequence that one task packs together at most; blocks have half of that by their size.
PER_TASK = 100_000


#: Fixed by the byte-level pre-tokenizer: what it splits a text into.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space but the blank, of ASCII and beyond.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
MORE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Punctuation of ASCII: neither letters nor numbers nor white space.
MARKS = string.punctuation


class Tokenizer:
    """Packed ids by a file of the ``tokenizers`` library, which encodes each word once while the memo holds it.

    A byte-level vocabulary never merges across a blank that stands alone between other characters, so texts are cut before
    each; a word that the memo doesn't know is cut into pre-tokens, and those that it doesn't know either are encoded many at a
    time. For any other kind of file, whole texts are encoded. ``memo``: words in either half of the memo; the older half goes
    when the younger is full, so its size bounds memory and changes no result.
    """

    def __init__(self, path: str, memo: int = 400_000):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import tokenizers

        self.own = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        pre, added = said.get("pre_tokenizer") or {}, said.get("added_tokens") or ()
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not said.get("normalizer") and not said.get("truncation")
        self.cuts = plain and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")) and not any(c.isspace() for t in added for c in t["content"])
        self.added = [t["content"] for t in added]
        ids = self.own.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(ids.values()) + 1, dtype=bool)
        self.blank[[i for t, i in ids.items() if t[:1] == "\u0120"]] = True  # how such vocabularies write a blank
        self.line = ids.get("\u010a")  # the end of a line
        self.memo: dict[str, bytes] = {}  # by word: ids of a blank and the word
        self.aged: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # by pre-token without a blank before it
        self.limit = memo

    def _encode(self, texts: list[str]) -> list[bytes]:
        encode = getattr(self.own, "encode_batch_fast", self.own.encode_batch)
        return [struct.pack(f"<{len(ids)}I", *ids) for e in encode(texts, add_special_tokens=False) for ids in (e.ids,)]

    def _encode_tokens(self, new: list[str], together: int = 1000) -> dict[str, bytes]:
        """Ids of a blank and each pre-token, many at a time: each begins with its only token that begins with a blank."""
        parts, out, rest = [new[k : k + together] for k in range(0, len(new), together)], {}, []
        for part, data in zip(parts, self._encode([" " + " ".join(p) for p in parts]), strict=True):
            starts = np.flatnonzero(self.blank[np.frombuffer(data, dtype="<u4")])
            if len(starts) != len(part) or starts[0]:
                rest += part
                continue
            edges = [*(4 * starts).tolist(), len(data)]
            out.update(zip(part, [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], strict=True))
        out.update(zip(rest, self._encode([" " + w for w in rest]), strict=True))
        return out

    def _encode_bare(self, new: list[str], together: int = 1000) -> dict[str, bytes]:
        """Ids of each pre-token without a blank; those of letters many at a time, a line each, as a line's end is a token of its own."""
        letters, rest, out = [], [], {}
        for t in new:
            (letters if t.isalpha() and self.line is not None else rest).append(t)
        parts = [letters[k : k + together] for k in range(0, len(letters), together)]
        for part, data in zip(parts, self._encode(["\n".join(p) for p in parts]), strict=True):
            ends = np.flatnonzero(np.frombuffer(data, dtype="<u4") == self.line)
            if len(ends) != len(part) - 1:
                rest += part
                continue
            edges = (4 * ends).tolist()
            out.update(zip(part, [data[a:b] for a, b in zip([0, *(e + 4 for e in edges)], [*edges, len(data)], strict=True)], strict=True))
        out.update(zip(rest, self._encode(rest), strict=True))
        return out

    def _learn(self, words: set[str], odd: list[str]) -> dict[str, bytes]:
        """Ids of a blank and each word; ``odd``: added tokens that may be in some."""
        known, aged, own = self.memo.get, self.aged, self.bare
        out = {w: aged[w] for w in aged.keys() & words}
        plain = set(filter(str.isalpha, words.difference(out)))
        others = list(words.difference(out, plain))
        whole = [w for w in others if any(t in w for t in odd)] if odd else []
        if whole:
            others = list(set(others).difference(whole))
        stems = [w.rstrip(MARKS) for w in others]
        ends = [w[len(s) :] if s.isalpha() else None for w, s in zip(others, stems, strict=True)]  # of letters and marks
        cut = [PRE_TOKEN.findall(" " + w) for w, end in zip(others, ends, strict=True) if end is None]
        heads, bare = {s for s, end in zip(stems, ends, strict=True) if end is not None}, set(filter(None, ends))
        heads.update([first[1:] for first, *_ in cut])
        for _, *more in cut:
            bare.update(more)
        found = {h: ids for h in heads if (ids := known(h) or aged.get(h)) is not None}
        plain |= heads.difference(found)
        fresh = self._encode_tokens(list(plain))
        out.update(fresh)
        found.update(fresh)
        loose = self._encode_bare([t for t in bare if t not in own])
        tail = {t: own.get(t) or loose[t] for t in bare}
        tail_of, rest = tail.__getitem__, iter(cut)
        for w, s, end in zip(others, stems, ends, strict=True):
            if end is not None:
                out[w] = found[s] + tail[end]
            else:
                first, *more = next(rest)
                out[w] = found[first[1:]] + b"".join(map(tail_of, more))
        out.update(zip(whole, self._encode([" " + w for w in whole]), strict=True))
        if len(own) + len(loose) > self.limit // 4:
            self.bare = {}
        self.bare.update((t, x) for t, x in loose.items() if len(t) <= 64)
        return out

    @staticmethod
    def cut(text: str) -> list[str] | None:
        """The first stretch and the words after each blank; None where a blank is beside other white space or at an end."""
        if "  " in text or text[0] == " " or text[-1] == " ":
            return None
        for c in SPACES if text.isascii() else SPACES + MORE_SPACES:
            if c in text and (f" {c}" in text or f"{c} " in text):
                return None
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        cuts = [self.cut(t) if t and self.cuts else None for t in texts]
        alone = [k for k, c in enumerate(cuts) if c is None]
        done = dict(zip(alone, self._encode([texts[k] for k in alone]), strict=True))
        heads = [k for k, c in enumerate(cuts) if c]
        firsts = self._encode_bare(list({cuts[k][0] for k in heads}))
        get, missing, open_ = self.memo.get, set(), []
        for k in heads:
            words = cuts[k]
            ids = list(map(get, words))
            ids[0] = firsts[words[0]]
            if gaps := [n for n, x in enumerate(ids) if x is None]:
                new = [words[n] for n in gaps]
                missing.update(new)
                open_.append((k, ids, gaps, new))
            else:
                done[k] = b"".join(ids)
            cuts[k] = None
        own = self._learn(missing, [t for t in self.added if any(t in x for x in texts)]) if missing else {}
        for k, ids, gaps, new in open_:
            for n, w in zip(gaps, new, strict=True):
                ids[n] = own[w]
            done[k] = b"".join(ids)
        if len(self.memo) + len(own) > self.limit:
            self.memo, self.aged = {}, self.memo
        for w in [w for w in own if len(w) > 64]:  # not worth keeping
            del own[w]
        self.memo.update(own)
        return [done[k] for k in range(len(texts))]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, nth and, if asked for, ``ids``.

    A document is its tokens and ``end`` (null and empty texts: ``end`` alone); one longer than ``capacity`` is cut so that
    all pieces but the first are full. ``nth`` counts documents of equal id and tokens within an input partition from 0, so
    that very many of them can be dealt to several blocks. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    stop = int(end).to_bytes(4, "little")

    def run(batches):
        own, met = tokenizer(path), {}
        for some in slices(batches):
            take, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            names = some.column("id").to_pylist()
            for k, packed in enumerate(own.encode(some.column("body").to_pylist())):
                packed += stop
                same = hash((str(names[k]), packed))
                met[same] = again = met.get(same, -1) + 1
                n = len(packed) // 4
                count = -(-n // capacity)
                edges = [0, *range(n - (count - 1) * capacity, n + 1, capacity)]
                for p, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                    data = packed[4 * lo : 4 * hi]
                    take.append(k)
                    piece.append(p)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(data))
                    nth.append(again)
                    if tokens:
                        ids.append(np.frombuffer(data, dtype="<u4").astype(np.int32))
            cols = [some.column("id").take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, nth))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.list_(pa.int32()))] * tokens, ["id", "piece", "start", "length", "ids_crc32", "nth"] + ["ids"] * tokens)

    schema = rows.select("id", F.lit(0).alias("piece"), *(F.lit(0).cast("long").alias(c) for c in ("start", "length", "ids_crc32", "nth")), *([F.array(F.lit(0)).alias("ids")] * tokens)).schema
    return rows.mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes, by best fit in order of decreasing length."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        if fit := rooms >> n:
            room = n + (fit & -fit).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > n:
            by_room[room - n].append(k)
            rooms |= 1 << (room - n)
    return bins


class Exchange:
    """Local search over the underfull bins of a packing, until no exchange increases the sum of squared fills."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.lengths, self.capacity, self.bins = lengths, capacity, bins
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.open = {k for k, f in enumerate(self.fill) if f < capacity}
        #: By bin: pieces, and pairs of them, by their total length.
        self.parts: dict[int, dict[int, tuple[int, ...]]] = {}
        #: By one or two pieces and total: (fill, bin) of bins that have it, emptiest first; entries of changed bins are passed over.
        self.offers: tuple[list[list[tuple[int, int]]], ...] = tuple([[] for _ in range(capacity + 1)] for _ in range(2))
        self.count = [[0] * (capacity + 1) for _ in range(2)]
        self.mask = [0, 0]  # bit t: some bin has a piece, or a pair, of total t
        for k in self.open:
            self._offer(k)

    def _all_parts(self, k: int) -> dict[int, tuple[int, ...]]:
        """Each total once; a piece stands before a pair of the same total, as it can go where a pair can't."""
        by_length: dict[int, list[int]] = {}
        for i in self.bins[k]:
            by_length.setdefault(self.lengths[i], []).append(i)
        found: dict[int, tuple[int, ...]] = {n: (own[0],) for n, own in by_length.items()}
        lengths = list(by_length)
        for x, n in enumerate(lengths):
            if len(by_length[n]) > 1:
                found.setdefault(2 * n, tuple(by_length[n][:2]))
            for m in lengths[:x]:
                found.setdefault(n + m, (by_length[n][0], by_length[m][0]))
        return found

    def _offer(self, k: int) -> None:
        self.parts[k] = own = self._all_parts(k)
        entry = (self.fill[k], k)
        for total, part in own.items():
            kind = len(part) - 1
            heappush(self.offers[kind][total], entry)
            self.count[kind][total] += 1
            self.mask[kind] |= 1 << total

    def _withdraw(self, k: int) -> None:
        for total, part in self.parts.pop(k).items():
            kind = len(part) - 1
            self.count[kind][total] -= 1
            if not self.count[kind][total]:
                self.mask[kind] ^= 1 << total

    def _emptiest(self, kind: int, total: int, but: int) -> int:
        """The emptiest bin with such a part other than ``but``, or -1."""
        heap, mine = self.offers[kind][total], None
        while heap:
            fill, k = heap[0]
            part = self.parts.get(k, {}).get(total)
            if part is None or len(part) != kind + 1 or self.fill[k] != fill:
                heappop(heap)
            elif k == but:
                mine = heappop(heap)
            else:
                break
        found = heap[0][1] if heap else -1
        if mine:
            heappush(heap, mine)
        return found

    def _better(self, b: int) -> tuple[int, int, tuple[int, ...], int] | None:
        """(gain, donor, what leaves b, total that comes) with the largest gain for bin b; two for two isn't among the moves."""
        own, gap, best = self.fill[b], self.capacity - self.fill[b], None
        for out, leaves in [(0, ()), *self.parts[b].items()]:
            kinds = (0,) if len(leaves) == 2 else (0, 1)
            reach = (self.mask[0] | (self.mask[1] if len(kinds) == 2 else 0)) & ((1 << (min(out + gap, self.capacity) + 1)) - 1)
            while (total := reach.bit_length() - 1) > out and (best is None or total - out > best[0]):
                donors = [a for kind in kinds if (a := self._emptiest(kind, total, b)) >= 0]
                if donors and self.fill[a := min(donors, key=lambda a: (self.fill[a], a))] < own + total - out:
                    best = (total - out, a, leaves, total)
                    break
                reach ^= 1 << total
            if best and best[0] == gap:
                break
        return best

    def run(self) -> list[list[int]]:
        """Each exchange increases the sum of squares by one at least, so this ends."""
        changed = True
        while changed:
            changed = False
            for b in sorted(self.open, key=lambda k: (-self.fill[k], k)):
                while b in self.open and (found := self._better(b)):
                    gain, a, leaves, total = found
                    comes = self.parts[a][total]
                    for k in (a, b):
                        self._withdraw(k)
                    self.bins[a] = [i for i in self.bins[a] if i not in comes] + list(leaves)
                    self.bins[b] = [i for i in self.bins[b] if i not in leaves] + list(comes)
                    self.fill[a] -= gain
                    self.fill[b] += gain
                    for k in (a, b):
                        if 0 < self.fill[k] < self.capacity:
                            self._offer(k)
                        else:
                            self.open.discard(k)
                    changed = True
        return [b for b in self.bins if b]


def fill_bins(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return Exchange(best_fit(lengths, capacity), lengths, capacity).run()


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text", per_block: int = PER_BLOCK, per_task: int = PER_TASK, tokens: bool = False) -> DataFrame:
    """One row for each piece (see :func:`pieces`) with its ``sequence_id`` and ``offset``; offsets in a sequence have no gaps.

    Null and repeated ids are documents like others; rows that are equal throughout may trade places, and many of them are
    dealt to several blocks. Texts of any length count whole. A block of more than ``per_task`` pieces that aren't full is
    packed in parts of that many, each with about one sequence to spare. Other columns are ignored. An empty table gives no
    rows. With ``tokens``, ids travel too and a sequence can be laid out from its rows.
    """
    cut = pieces(docs, path, capacity, end, id_col, text_col, tokens)
    blocks = max(1, -(-docs.count() // per_block))
    key = F.xxhash64("id", "piece", "ids_crc32", "length", "nth")
    dealt = cut.withColumn("key", key).repartition(blocks, "key").sortWithinPartitions("key", "id", "piece", "ids_crc32", "nth").drop("key", "nth")
    schema = dealt.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    names = [f.name for f in schema]

    def run(batches):
        first = TaskContext.get().partitionId() << 40

        def laid(t: pa.Table, bins: list[list[int]], lengths: list[int]):
            nonlocal first
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            for k, own in enumerate(bins):
                at = 0
                for i in own:
                    sequence[i], offset[i] = first + k, at
                    at += lengths[i]
            first += len(bins)
            return pa.Table.from_arrays([*t.columns, pa.array(sequence), pa.array(offset)], names).to_batches()

        def packed(held):
            t = pa.Table.from_batches(held).combine_chunks()
            lengths = t.column("length").to_pylist()
            return laid(t, fill_bins(lengths, capacity), lengths)

        held, n = [], 0
        for b in batches:
            full = pc.equal(b.column("length"), capacity)
            whole = pa.Table.from_batches([b.filter(full)])  # a sequence each
            yield from laid(whole, [[i] for i in range(whole.num_rows)], [capacity] * whole.num_rows)
            held.append(b.filter(pc.invert(full)))
            n += held[-1].num_rows
            if n >= per_task:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)

    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
