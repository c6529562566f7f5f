"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary (hash, displace, compress; built in numpy from the rank
file) says in one probe whether a whole pre-token is a token. Tier two, for the rest: a heap of mergeable pairs
over a doubly linked list of bytes, so that a pre-token of n bytes takes n log n steps, however long it is.
Encoded stretches between blanks are kept in a memo of bounded size, as texts repeat most of theirs.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table

#: Stretches in either half of a worker's memo.
MEMO = 500_000


class PerfectHash:
    """Byte strings to 0..n-1 without collisions and without gaps.

    Level by level: keys that are alone at their position of a bit table stay there, the others go on to the next,
    smaller level. A position's number is the count of set bits before it. ``keys`` and ``values`` stand at these
    numbers; a string that isn't there is found out by one comparison.
    """

    ODD = 0x9E3779B97F4A7C15
    MASK = (1 << 64) - 1

    def __init__(self, items: dict[bytes, int], room: float = 2.0):
        names = list(items)
        left = np.arange(len(names))
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, names), dtype=np.uint64, count=len(names))
        self.levels: list[tuple[int, int, list[int]]] = []  # salt, size, number of each position or -1
        self.keys: list[bytes] = []
        self.values: list[int] = []
        while len(left):
            size, salt = max(int(room * len(left)), 8), (len(self.levels) * 2 + 1) * self.ODD & self.MASK
            with np.errstate(over="ignore"):
                at = (((h[left] ^ np.uint64(salt)) * np.uint64(self.ODD)) >> np.uint64(24)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size)[at.astype(np.int64)] == 1
            number = np.full(size, -1)
            put = np.argsort(at[alone], kind="stable")
            number[at[alone][put].astype(np.int64)] = len(self.keys) + np.arange(alone.sum())
            own = [names[k] for k in left[alone][put].tolist()]
            self.keys += own
            self.values += [items[k] for k in own]
            self.levels.append((salt, size, number.tolist()))
            left = left[~alone]

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        for salt, size, number in self.levels:
            if (n := number[(((h ^ salt) * self.ODD & self.MASK) >> 24) % size]) >= 0:
                return self.values[n] if self.keys[n] == key else -1
        return -1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


#: Patterns by which no pre-token goes on across a blank that stands alone between other characters.
PLAIN_PATTERNS = frozenset((
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s""",
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
))


class Codec:
    """``encode`` and ``decode`` by a rank file and the pattern that splits text before the merges.

    With a pattern beyond PLAIN_PATTERNS each text is split whole, which is slower and takes any pattern.
    """

    def __init__(self, path: str, pattern: str, memo: int = MEMO):
        self.ranks = load_ranks(path)
        self.whole = PerfectHash(self.ranks)
        self.token = {i: t for t, i in self.ranks.items()}
        self.byte = [self.ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}  # (left id << 32 | right id) to the id that they merge into
        for t, i in self.ranks.items():
            for cut in range(1, len(t)):
                if (a := self.ranks.get(t[:cut])) is not None and (b := self.ranks.get(t[cut:])) is not None:
                    self.pairs[a << 32 | b] = i
        known = [self.token.get(i, b"") for i in range(max(self.token) + 1)]
        self.letters = np.frombuffer(b"".join(known), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in known])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.split = regex.compile(pattern).findall
        self.cuts = pattern in PLAIN_PATTERNS
        self.memo: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}
        self.limit = memo

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token: the lowest rank merges first, of equal ones the leftmost."""
        n, pair = len(piece), self.pairs.get
        ids = list(map(self.byte.__getitem__, piece))
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        rank = [pair(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]  # of each with its right neighbour
        rank.append(-1)
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            low = heappop(heap)
            r, i = low >> 32, low & 0xFFFFFFFF
            if rank[i] != r:
                continue  # one of the two has merged since
            j = after[i]
            ids[i], ids[j], rank[j] = r, -1, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                rank[i] = x = pair(r << 32 | ids[k], -1)
                if x >= 0:
                    heappush(heap, x << 32 | i)
            else:
                rank[i] = -1
            k = before[i]
            if k >= 0:
                rank[k] = x = pair(ids[k] << 32 | r, -1)
                if x >= 0:
                    heappush(heap, x << 32 | k)
        return [i for i in ids if i >= 0]

    def piece(self, text: str) -> bytes:
        """Packed ids of one pre-token."""
        data = text.encode()
        found = self.whole.get(data)
        return found.to_bytes(4, "little") if found >= 0 else struct.pack(f"<{len(ids := self.merge(data))}I", *ids)

    def stretches(self, text: str) -> list[str]:
        """Cuts of ``text`` at which every pre-token ends: before each blank that stands alone between other characters.

        A text with a blank beside other white space, or at an end, is cut into its pre-tokens.
        """
        if not self.cuts or "  " in text or text[0] == " " or text[-1] == " ":
            return self.split(text)
        for c in filter(str.isspace, set(text) - {" "}):
            if f" {c}" in text or f"{c} " in text:
                return self.split(text)
        head, *rest = text.split(" ")
        return [head, *map(" ".__add__, rest)]

    def _new(self, cut: str) -> bytes:
        if (ids := self.aged.get(cut)) is None:
            parts = self.split(cut)
            ids = self.piece(cut) if len(parts) == 1 else b"".join(map(self._one, parts))
        if len(cut) <= 64:
            if len(self.memo) >= self.limit:  # the older half goes; what is still in use comes back from it
                self.memo, self.aged = {}, self.memo
            self.memo[cut] = ids
        return ids

    def _one(self, part: str) -> bytes:
        return self.memo.get(part) or self._new(part) if len(part) > 1 else self.piece(part)

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        cuts = self.stretches(text)
        out = list(map(self.memo.get, cuts))
        if None in out:
            get, new = self.memo.get, self._new
            out = [x or get(c) or new(c) for x, c in zip(out, cuts, strict=True)]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode_many(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of many lists of ids, which end at ``ends`` of ``ids``; one gather for them all."""
        size = self.sizes[ids]
        stop = np.cumsum(size)
        at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.starts[ids] - stop + size, size)
        data, edge = self.letters[at].tobytes(), np.concatenate([[0], stop])[ends]
        return [data[a:b] for a, b in zip([0, *edge[:-1].tolist()], edge.tolist(), strict=True)]


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary in a worker; the path must be readable on every executor."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id and ``ids``, its tokens; null and empty texts have none.

    Repeated rows stay, with null ids as well; other columns are ignored. Whole texts of any length, special tokens' strings
    being ordinary text. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))

    def run(batches):
        own = codec(path, pattern)
        for b in slices(batches):
            packed = [own.encode_packed(t) for t in b.column("body").to_pylist()]
            flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "ids"])

    schema = rows.select(F.col("id"), F.array(F.lit(0)).alias("ids")).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row for each list of ids: its id and ``data``, the decoded bytes (null: none).

    Repeated rows stay; other columns are ignored. An empty table gives no rows. An id that the vocabulary lacks is an error.
    """
    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        own = codec(path, pattern)
        for b in slices(batches):
            lists = b.column("ids")
            data = [own.decode(x or ()) for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(data, pa.binary())], ["id", "data"])

    return rows.mapInArrow(run, rows.select("id", F.lit(b"").alias("data")).schema).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass, of which only counts and checksums leave the worker."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        own = codec(path, pattern)
        word = np.array([str(i) for i in range(max(own.token) + 1)], dtype=object)
        for b in slices(batches, 256):
            packed = [own.encode_packed(t) for t in b.column("body").to_pylist()]
            ids = np.frombuffer(b"".join(packed), dtype="<u4")
            ends = np.cumsum([len(p) // 4 for p in packed])
            said = word[ids].tolist()
            ids_sha = [hashlib.sha256(" ".join(said[a:z]).encode()).hexdigest() for a, z in zip([0, *ends[:-1]], ends, strict=True)]
            data_sha = [hashlib.sha256(d).hexdigest() for d in own.decode_many(ids, ends)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())], names)

    schema = rows.select("id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
