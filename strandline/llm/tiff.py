"""TIFF columns: image directories walked, strips and tiles decoded, one row for each page.

Baseline TIFF in either byte order: strips or tiles; no compression, PackBits, LZW (most significant bit first,
early change) or deflate; horizontal and floating-point predictors; chunky or planar samples of 1, 2, 4, 8, 16, 32 or
64 bits, integers or floating-point numbers. A writer for the same forms stands beside the reader. Files aren't trusted: tags
are checked before memory is taken, a page takes no more than its bytes can hold, and what can't be read is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table

NONE, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
#: Fixed by the format: tags by number, and bytes of each field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, CHANNELS, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


#: Fixed by the formats: how many bytes one byte can stand for at most.
MOST = {NONE: 1, PACKBITS: 64, LZW: 2560, DEFLATE: 1032, 32946: 1032}


class TiffError(ValueError):
    pass


#: What damaged bytes can lead to; each is a row with ``error``.
DAMAGE = (TiffError, ArithmeticError, IndexError, ValueError, MemoryError, struct.error)


# -- decoding of one strip or tile -------------------------------------------------------------------


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while i < len(data) and len(out) < size:
        n = data[i]
        i += 1
        if n < 128:
            out += data[i : i + n + 1]
            i += n + 1
        elif n > 128:
            out += data[i : i + 1] * (257 - n)
            i += 1
    return bytes(out[:size])


def pack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        run = 1
        while run < 128 and i + run < len(data) and data[i + run] == data[i]:
            run += 1
        if run >= 3:
            out += bytes([257 - run, data[i]])
            i += run
            continue
        end = i
        while end < len(data) and end - i < 128 and data[end : end + 3] != data[end : end + 1] * 3:
            end += 1
        end = max(end, i + 1)
        out.append(end - i - 1)
        out += data[i:end]
        i = end
    return bytes(out)


def unlzw(data: bytes, size: int) -> bytes:
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    words, width, held, bits, last = start[:], 9, 0, 0, None
    out, n = [], 0
    for byte in data:
        held = held << 8 | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            words, width, last = start[:], 9, None
            continue
        if last is None:
            if code > 255:
                raise TiffError("an LZW code before its word")
            word = words[code]
        else:
            if code < len(words):
                word = words[code]
            elif code == len(words):
                word = last + last[:1]
            else:
                raise TiffError("an LZW code before its word")
            if len(words) < 4096:
                words.append(last + word[:1])
        out.append(word)
        n += len(word)
        last = word
        if len(words) >= (1 << width) - 1 and width < 12:
            width += 1
        if n >= size:
            break
    return b"".join(out)[:size]


def lzw(data: bytes) -> bytes:
    out, held, bits, width = bytearray(), 0, 0, 9

    def put(code: int) -> None:
        nonlocal held, bits
        held = held << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    words = {bytes([i]): i for i in range(256)}
    put(256)
    word = b""
    for k in range(len(data)):
        more = word + data[k : k + 1]
        if more in words:
            word = more
            continue
        put(words[word])
        words[more] = len(words) + 2
        if len(words) + 2 == 4094:  # the table is full
            put(256)
            words, width = {bytes([i]): i for i in range(256)}, 9
        elif len(words) + 2 >= 1 << width:
            width += 1
        word = data[k : k + 1]
    if word:
        put(words[word])
        if len(words) + 3 >= 1 << width and width < 12:
            width += 1
    put(257)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def expand(data: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        out = data[:size]
    elif compression == PACKBITS:
        out = unpack_bits(data, size)
    elif compression == LZW:
        out = unlzw(data, size)
    elif compression in (DEFLATE, 32946):
        try:
            d = zlib.decompressobj()
            out = d.decompress(data, size)
            while not d.eof and (d.decompress(d.unconsumed_tail, 1 << 16) or d.unconsumed_tail):
                pass  # the checksum stands at the end
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from e
        if not d.eof:
            raise TiffError("deflate: the data end early")
    else:
        raise TiffError(f"compression {compression} isn't known")
    if len(out) < size:
        raise TiffError(f"a segment has {len(out)} of {size} bytes")
    return out


# -- directories and pages ----------------------------------------------------------------------------


@dataclass
class Page:
    """samples: height x width x channels; those of less than 8 bits are a byte each, ``bits`` says how many count."""

    samples: np.ndarray
    compression: int
    predictor: int
    bits: int


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """(byte order, tags) of each directory, in the order of their chain; a chain that meets itself is an error."""
    if len(data) < 8 or data[:4] not in (b"II*\0", b"MM\0*"):
        raise TiffError("not a TIFF")
    order = "<" if data[:2] == b"II" else ">"
    at, met = struct.unpack_from(f"{order}I", data, 4)[0], set()
    while at:
        if at in met:
            raise TiffError("the chain of directories has a loop")
        met.add(at)
        try:
            (n,) = struct.unpack_from(f"{order}H", data, at)
            tags = {}
            for k in range(n):
                tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
                size = TYPE_BYTES.get(kind, 0) * count
                place = at + 10 + 12 * k
                if size > 4:
                    (place,) = struct.unpack_from(f"{order}I", data, place)
                if kind in (1, 3, 4):
                    tags[tag] = struct.unpack_from(f"{order}{count}{'BHI'[kind - (kind > 1) - 1]}", data, place)
            (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
        except struct.error as e:
            raise TiffError(f"a directory ends early: {e}") from e
        yield order, tags


def _plan(tags: dict[int, tuple]) -> tuple:
    """What a page's tags say, checked: every number is there, positive and within what the format and the bytes allow."""

    def one(tag: int, default: int | None = None) -> int:
        found = tags.get(tag) or (default,)
        if found[0] is None:
            raise TiffError(f"tag {tag} is missing")
        return found[0]

    width, height, channels, planar, predictor, compression = one(WIDTH), one(HEIGHT), one(CHANNELS, 1), one(PLANAR, 1), one(PREDICTOR, 1), one(COMPRESSION, 1)
    bits, form, tiled = one(BITS, 1), one(SAMPLE_FORMAT, 1), TILE_OFFSETS in tags
    box = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS, height), height), width)
    offsets, counts = (tags.get(t) or () for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS)))
    if not all((width, height, channels, *box)) or planar not in (1, 2):
        raise TiffError("a size is zero")
    if form == 4:
        form = 1
    kind = {1: "u", 2: "i", 3: "f"}.get(form)
    if kind is None or len(set(tags.get(BITS) or (1,))) > 1 or bits not in ((1, 2, 4, 8, 16, 32, 64) if kind == "u" else (8, 16, 32, 64) if kind == "i" else (16, 32, 64)):
        raise TiffError(f"samples of {bits} bits and format {form} aren't read")
    if predictor not in (1, 2, 3) or predictor == 2 and (bits < 8 or kind == "f") or predictor == 3 and kind != "f":
        raise TiffError(f"predictor {predictor} isn't read with samples of {bits} bits and format {form}")
    if compression not in MOST:
        raise TiffError(f"compression {compression} isn't known")
    down, across, each = -(-height // box[0]), -(-width // box[1]), 1 if planar == 2 else channels
    segments = down * across * (channels // each)
    if min(len(offsets), len(counts)) < segments:
        raise TiffError("segments are missing")
    line = -(-box[1] * each * bits // 8)
    if (box[0] if tiled else 1) * line * segments > MOST[compression] * sum(counts[:segments]) or height * -(-width * each * bits // 8) * (channels // each) > MOST[compression] * sum(counts[:segments]):
        raise TiffError("the segments can't hold the page")
    return width, height, channels, planar, predictor, compression, bits, kind, tiled, box, offsets[:segments], counts[:segments], down, across, each, line


def _unpredicted(raw: bytes, order: str, rows: int, across: int, each: int, bits: int, kind: str, predictor: int) -> np.ndarray:
    """Samples (rows x across x each) of a strip or tile."""
    if bits < 8:
        whole = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(rows, -1), axis=1)
        whole = whole[:, : across * each * bits].reshape(rows, across, each, bits)
        return (whole << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(3, dtype=np.uint8)
    size = bits // 8
    if predictor == 3:  # bytes of a row by significance, then differences
        data = np.frombuffer(raw, dtype=np.uint8).reshape(rows, size * across, each)
        planes = np.cumsum(data, axis=1, dtype=np.uint8).reshape(rows, size, across * each)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, across, each).astype(f"f{size}")
    got = np.frombuffer(raw, dtype=f"{order}{kind}{size}").reshape(rows, across, each)
    return np.cumsum(got, axis=1, dtype=got.dtype.newbyteorder("=")) if predictor == 2 else got


def decode_page(data: bytes, order: str, tags: dict[int, tuple]) -> Page:
    """Any damage is a :class:`TiffError`."""
    try:
        width, height, channels, planar, predictor, compression, bits, kind, tiled, box, offsets, counts, down, across, each, line = _plan(tags)
        if sum(len(data[at : at + n]) for at, n in zip(offsets, counts, strict=True)) * MOST[compression] < height * -(-width * channels * bits // 8):
            raise TiffError("the file can't hold the page")
        samples = np.empty((height, width, channels), dtype=f"{kind}{max(1, bits // 8)}")
        for k, (at, n) in enumerate(zip(offsets, counts, strict=True)):
            plane, cell = divmod(k, down * across)
            top, left = cell // across * box[0], cell % across * box[1]
            rows = box[0] if tiled else min(box[0], height - top)
            got = _unpredicted(expand(data[at : at + n], compression, rows * line), order, rows, box[1], each, bits, kind, predictor)
            part = got[: height - top, : width - left]
            samples[top : top + part.shape[0], left : left + part.shape[1], plane : plane + each if planar == 2 else channels] = part
    except TiffError:
        raise
    except DAMAGE as e:
        raise TiffError(f"{type(e).__name__}: {e}") from e
    return Page(samples, compression, predictor, bits)


def pages(data: bytes) -> Iterator[Page]:
    for order, tags in directories(data):
        yield decode_page(data, order, tags)


# -- writing ---------------------------------------------------------------------------------------------


def _predicted(part: np.ndarray, order: str, bits: int, predictor: int) -> bytes:
    """The bytes of a strip or tile before it is compressed."""
    rows, across, each = part.shape
    if bits < 8:
        whole = np.unpackbits(part.astype(np.uint8)[..., None], axis=3)[..., 8 - bits :]
        return np.packbits(whole.reshape(rows, -1), axis=1).tobytes()
    size = bits // 8
    if predictor == 3:
        planes = np.ascontiguousarray(part.astype(f">f{size}")).view(np.uint8).reshape(rows, across * each, size).transpose(0, 2, 1).reshape(rows, size * across, each)
        return np.diff(planes, axis=1, prepend=np.zeros_like(planes[:, :1])).tobytes()
    if predictor == 2:
        part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
    return part.astype(part.dtype.newbyteorder(order)).tobytes()


def encode(images: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, order: str = "<", box: tuple[int, int] | None = None, planar: bool = False, strip: int = 1 << 16, bits: int | None = None) -> bytes:
    """One directory for each image (height x width x channels); ``box``: tiles of (height, width), else strips of ``strip`` bytes; ``bits``: 1, 2 or 4 of each byte."""
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + bytes(4))
    link = 4
    shrink = {NONE: bytes, PACKBITS: pack_bits, LZW: lzw, DEFLATE: lambda d: zlib.compress(d, 2)}[compression]
    for image in images:
        height, width, channels = image.shape
        own = bits or 8 * image.dtype.itemsize
        rows, cols = box or (max(1, min(height, strip * 8 // max(1, width * channels * own))), width)
        offsets, counts = [], []
        for plane in [image[:, :, c : c + 1] for c in range(channels)] if planar else [image]:
            for top in range(0, height, rows):
                for left in range(0, width, cols):
                    part = plane[top : top + rows, left : left + cols]
                    if box and part.shape[:2] != box:
                        part = np.pad(part, ((0, rows - part.shape[0]), (0, cols - part.shape[1]), (0, 0)))
                    data = shrink(_predicted(part, order, own, predictor))
                    offsets.append(len(out))
                    counts.append(len(data))
                    out += data
        tags: dict[int, tuple[str, list[int]]] = {
            WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: ("H", [own] * channels), COMPRESSION: ("H", [compression]), PHOTOMETRIC: ("H", [2 if channels == 3 else 1]),
            CHANNELS: ("H", [channels]), PLANAR: ("H", [2 if planar else 1]), PREDICTOR: ("H", [predictor]),
        }
        if image.dtype.kind != "u":
            tags[SAMPLE_FORMAT] = ("H", [{"i": 2, "f": 3}[image.dtype.kind]])
        tags |= {TILE_WIDTH: ("I", [cols]), TILE_HEIGHT: ("I", [rows]), TILE_OFFSETS: ("I", offsets), TILE_COUNTS: ("I", counts)} if box else {OFFSETS: ("I", offsets), ROWS: ("I", [rows]), COUNTS: ("I", counts)}
        entries = b""
        for tag, (code, values) in sorted(tags.items()):
            packed = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(packed) > 4:
                out += bytes(len(out) % 2)
                place, packed = len(out), out.extend(packed) or b""
                packed = struct.pack(f"{order}I", place)
            entries += struct.pack(f"{order}HHI", tag, {"H": 3, "I": 4}[code], len(values)) + packed.ljust(4, b"\0")
        out += bytes(len(out) % 2)
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + entries
        link = len(out)
        out += bytes(4)
    return bytes(out)


# -- operators ---------------------------------------------------------------------------------------------


def feature(samples: np.ndarray) -> str:
    """Shape, and mean, deviation and entropy of the samples' most significant bytes."""
    flat = samples.reshape(-1).view(f"u{samples.dtype.itemsize}")
    n = np.bincount(flat if flat.dtype.itemsize == 1 else (flat >> (8 * flat.dtype.itemsize - 8)).astype(np.uint8), minlength=256)
    p = n / max(flat.size, 1)
    mean = float(p @ np.arange(256))
    spread = float(np.sqrt(max(0.0, p @ np.arange(256) ** 2 - mean**2)))
    entropy = float(-(p[p > 0] * np.log2(p[p > 0])).sum())
    return f"{'x'.join(map(str, samples.shape))} mean {mean:.3f} deviation {spread:.3f} entropy {entropy:.3f}"


PAGE = {"page": "int", "width": "int", "height": "int", "channels": "int", "bits": "int", "compression": "int", "predictor": "int", "samples": "binary", "feature": "string", "error": "string"}


def read_pages(media: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and those of PAGE, a row for each page of each file, pages from 0.

    A page that can't be decoded is a row with its number, ``error`` and nulls, and the pages after it go on. A null or unreadable
    file, and the rest of a file from a broken directory on, give one row with ``error`` and nulls.
    Repeated rows stay; other columns are ignored, so their names can't clash. An empty table gives no rows. A file of any length
    is held whole by its task, as are the pages of one file.
    """
    rows = media.select(*keep, F.col(media_col).alias("media to read"))
    schema = rows.drop("media to read").withColumns({k: F.lit(None).cast(t) for k, t in PAGE.items()}).schema
    kinds = [pa.int32()] * 7 + [pa.binary(), pa.string(), pa.string()]
    names = [f.name for f in schema]

    def run(batches):
        for some in slices(batches, 256):
            take, out = [], []
            for k, data in enumerate(some.column(len(keep)).to_pylist()):
                page = -1
                try:
                    if data is None:
                        raise TiffError("no media")
                    for page, (order, tags) in enumerate(directories(data)):
                        take.append(k)
                        try:
                            p = decode_page(data, order, tags)
                        except TiffError as e:
                            out.append((page, *[None] * 8, str(e)))
                            continue
                        h, w, c = p.samples.shape
                        out.append((page, w, h, c, p.bits, p.compression, p.predictor, p.samples.tobytes(), feature(p.samples), None))
                    if page < 0:
                        raise TiffError("no page")
                except DAMAGE as e:
                    take.append(k)
                    out.append((None,) * 9 + (str(e),))
            cols = [some.column(i).take(pa.array(take, pa.int64())) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 64, channels: int = 3, compression: int = DEFLATE) -> DataFrame:
    """One row for each document: id, n_bytes and ``media``, a one-page TIFF of its UTF-8 bytes and blanks up to whole pixel rows.

    Null texts are empty, and an empty text is one row of blanks. Whole texts of any length; repeated rows stay, equal texts give
    equal files; other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    schema = rows.select("id", F.lit(0).cast("long").alias("n_bytes"), F.lit(b"").alias("media")).schema
    line = width * channels

    def run(batches):
        for some in slices(batches, 256):
            body = some.column("body").to_pylist()
            media = []
            for data in body:
                n = max(1, -(-len(data) // line))
                image = np.frombuffer(data.ljust(n * line, b" "), dtype=np.uint8).reshape(n, width, channels)
                media.append(encode([image], compression))
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array([len(d) for d in body], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op1_tiff(spark, sf_dir: str) -> DataFrame:
    stored = store_texts(table(spark, sf_dir, "documents"))
    kept = stored.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    read = read_pages(kept, keep=("doc_id", "n_bytes", "media_bytes", "media_sha256"))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -16, 16)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
    )
