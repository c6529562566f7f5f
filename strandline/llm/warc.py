"""WARC archives as a PySpark data source, for reading and writing.

``spark.read.format("warc").load(folder)`` plans partitions from file sizes (small files together; compressed files
beyond ``partitionBytes`` in ranges that begin at the next record), takes predicates on record type and header
columns from the plan, reads each record's headers first and passes over the rest of a record that they rule out:
by a seek in plain files, by the member length that the writer leaves in each gzip header in compressed ones, and by
inflating without parsing where a foreign file has no such length. With option ``payload`` false no payload is
decoded at all. Writing gives one gzip member for each record and a manifest, which names the files of the tasks
that succeeded, so that files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage

from strandline.llm.common import fresh_path, table, written

#: Fixed by the format: column and header.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile",
}
SCHEMA = "record_type string, record_id string, target_uri string, date string, content_type string, payload_digest string, refers_to string, profile string, content_length long, http_status int, http_length long, payload binary, file string, offset long"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
BLOCK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
FIRST = b"WARC/"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """By URI, or a local path."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


# -- records ----------------------------------------------------------------------------------------------


def header_block(headers: dict[str, str | None], length: int) -> bytes:
    """Control characters in values are percent-encoded, so that no value ends its line."""
    clean = lambda v: re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", v)
    lines = ["WARC/1.1", *(f"{k}: {clean(v)}" for k, v in headers.items() if v is not None), f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def parse_headers(block: bytes) -> dict[str, str]:
    """Names in lower case; a line that begins with a blank goes on from the one before."""
    found: dict[str, str] = {}
    last = ""
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            found[last] = value.strip()
    return found


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member whose extra field ``sl`` is its whole length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    extra = 2 + 2 + 4
    size = 10 + 2 + extra + len(body) + 8
    return MAGIC + b"\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", extra) + b"sl" + struct.pack("<HI", 4, size) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def member_length(head: bytes) -> int:
    """From the extra field ``sl``; 0 if there is none."""
    if len(head) < 12 or not head.startswith(MAGIC) or not head[3] & 4:
        return 0
    extra, at = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        (n,) = struct.unpack_from("<H", extra, at + 2)
        if extra[at : at + 2] == b"sl" and n == 4 and at + 8 <= len(extra):
            return struct.unpack_from("<I", extra, at + 4)[0]
        at += 4 + n
    return 0


class Window:
    """A file read in blocks, forward, with a look ahead."""

    def __init__(self, f, size: int, at: int = 0):
        self.f, self.size, self.at, self.held = f, size, at, b""

    def ahead(self, n: int) -> bytes:
        """The next n bytes, or what is left."""
        if len(self.held) < n and self.at + len(self.held) < self.size:
            self.f.seek(self.at + len(self.held))
            parts = [self.held]
            while (have := sum(map(len, parts))) < n and (more := self.f.read(max(BLOCK, n - have))):
                parts.append(more)
            self.held = b"".join(parts)
        return self.held[:n]

    def skip(self, n: int) -> None:
        self.held = self.held[n:]
        self.at += n

    def find(self, mark: bytes, grow: int = 1 << 16) -> int:
        """How far ahead ``mark`` is, or -1."""
        n = grow
        while True:
            some = self.ahead(n)
            if (k := some.find(mark)) >= 0:
                return k
            if len(some) < n:
                return -1
            n *= 4


def _inflate(w: Window, wanted) -> tuple[bytes | None, int]:
    """(the member's data if ``wanted`` takes its header block, its length in the file)."""
    z, out, used, keep, n = zlib.decompressobj(31), [], 0, None, 1 << 12
    known = member_length(w.ahead(64))
    while not z.eof:
        some = w.ahead(used + n)[used:]
        if not some:
            raise ValueError("a gzip member ends early")
        got = z.decompress(some)
        used += len(some)
        n = BLOCK
        if keep is not False:
            out.append(got)
        if keep is None and (b"\r\n\r\n" in (head := b"".join(out)) or z.eof):
            keep = bool(wanted(head[: head.find(b"\r\n\r\n") + 4]))
            if not keep:
                out = []
                if known:
                    return None, known
    return (b"".join(out) if keep else None), used - len(z.unused_data)


def records(f, size: int, start: int, stop: int, wanted) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, content) of the records that begin in [start, stop) and whose header block ``wanted`` takes."""
    w = Window(f, size, start)
    if start:  # a range of a compressed file begins with the first member from there on that is a record
        while True:
            k = w.find(MAGIC)
            if k < 0 or w.at + k >= stop:
                return
            w.skip(k)
            try:
                if zlib.decompressobj(31).decompress(w.ahead(1 << 12), 5) == FIRST:
                    break
            except zlib.error:
                pass
            w.skip(1)
    while w.at < stop and (head := w.ahead(5)):
        at = w.at
        if head.startswith(MAGIC):
            data, used = _inflate(w, wanted)
            w.skip(used)
            if data is not None:
                end = data.find(b"\r\n\r\n") + 4
                headers = parse_headers(data[: end - 4])
                yield at, headers, data[end : end + int(headers.get("content-length", 0))]
        elif head == FIRST:
            end = w.find(b"\r\n\r\n")
            if end < 0:
                raise ValueError(f"the headers at {at} don't end")
            block = w.ahead(end + 4)
            headers = parse_headers(block[:-4])
            n = int(headers.get("content-length", 0))
            w.skip(end + 4)
            if wanted(block):
                content = w.ahead(n)
                yield at, headers, content
            w.skip(n)
            while w.ahead(2) == b"\r\n":
                w.skip(2)
        elif head[:2] == b"\r\n":
            w.skip(2)
        else:
            raise ValueError(f"no record at {at}")


def http(headers: dict[str, str], content: bytes, decode: bool) -> tuple[int | None, int | None, bytes | None]:
    """(status, Content-Length, payload) of an HTTP response, or the content itself of another record."""
    if not headers.get("content-type", "").startswith("application/http"):
        return None, None, content if decode else None
    head, _, body = content.partition(b"\r\n\r\n")
    status = re.match(rb"HTTP/\S+ (\d{3})", head)
    length = re.search(rb"\r\nContent-Length: *(\d+)", head, re.I)
    return int(status[1]) if status else None, int(length[1]) if length else None, (body if headers.get("warc-type") != "revisit" else None) if decode else None


# -- data source --------------------------------------------------------------------------------------------


@dataclass
class Ranges(InputPartition):
    ranges: list[tuple[str, int, int, int]]  # file, size, start, stop


COMPARISONS = {
    EqualTo: lambda x, v: x is not None and x == v, EqualNullSafe: lambda x, v: x == v, GreaterThan: lambda x, v: x is not None and x > v, GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v, LessThanOrEqual: lambda x, v: x is not None and x <= v, In: lambda x, v: x is not None and x in v, StringStartsWith: lambda x, v: x is not None and x.startswith(v),
    StringEndsWith: lambda x, v: x is not None and x.endswith(v), StringContains: lambda x, v: x is not None and v in x,
}


def holds(f, row: dict) -> bool:
    """A pushed filter on the header columns of one record."""
    if isinstance(f, Not):
        return row[_column(f.child)] is not None and not holds(f.child, row)
    x = row[_column(f)]
    if isinstance(f, IsNull | IsNotNull):
        return (x is None) == isinstance(f, IsNull)
    return COMPARISONS[type(f)](x, f.value)


def _column(f) -> str | None:
    return f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None


def _taken(f) -> bool:
    if isinstance(f, Not):
        return not isinstance(f.child, IsNull | IsNotNull | EqualNullSafe | Not) and _taken(f.child)
    return (type(f) in COMPARISONS or isinstance(f, IsNull | IsNotNull)) and _column(f) in {*HEADERS, "content_length"}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.size = int(options.get("partitionbytes", 64 << 20))
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.filters: list = []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if _taken(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, root = file_system(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            files = [fs.get_file_info(root)]
        else:
            listed = {f.path: f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if f.type == pafs.FileType.File}
            if any(p.endswith("/" + MANIFEST) for p in listed):
                with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
                    named = {f"{root}/{x}" for x in json.loads(f.read())["files"]}
                files = [listed[p] for p in sorted(named)]
            else:
                files = [f for p, f in sorted(listed.items()) if re.search(r"\.warc(\.gz)?$", p)]
        out: list[Ranges] = []
        held, n = [], 0
        for f in files:
            cuts = [0, f.size]
            if f.path.endswith(".gz"):
                cuts = [*range(0, f.size, self.size), f.size]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and n + b - a > self.size:
                    out.append(Ranges(held))
                    held, n = [], 0
                held.append((f.path, f.size, a, b))
                n += b - a
        return out + [Ranges(held)] * bool(held) or [Ranges([])]

    def read(self, partition):
        fs, _ = file_system(self.path)
        filters, names = self.filters, [c.split()[0] for c in SCHEMA.split(", ")]
        schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in SCHEMA.split(", ")])
        kept: dict = {}

        def wanted(block: bytes) -> bool:
            headers = parse_headers(block[:-4])
            row = {c: headers.get(h.lower()) for c, h in HEADERS.items()} | {"content_length": int(headers.get("content-length", 0))}
            kept.clear()
            kept.update(row)
            return all(holds(f, row) for f in filters)

        rows, held = [], 0
        for path, size, start, stop in partition.ranges:
            with fs.open_input_file(path) as f:
                for at, headers, content in records(f, size, start, stop, wanted):
                    status, length, payload = http(headers, content, self.payload)
                    rows.append(dict(kept) | {"http_status": status, "http_length": length, "payload": payload, "file": path, "offset": at})
                    held += len(payload or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in rows], schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    records: int


class WarcWriter(DataSourceArrowWriter):
    """Rows of record_type, record_id, target_uri, date, payload, payload_digest, refers_to; HTTP responses around the payloads."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("filebytes", 1 << 30))

    def write(self, iterator):
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, n, out = [], 0, None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or out.tell() >= self.most:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")  # each attempt has names of its own
                    out = fs.open_output_stream(f"{root}/{files[-1]}", compression=None)  # records are compressed one by one
                payload = row["payload"] or b""
                revisit = row["record_type"] == "revisit"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
                headers = {HEADERS[k]: row.get(k) for k in ("record_type", "record_id", "target_uri", "date")}
                headers |= {"WARC-Payload-Digest": f"sha256:{row.get('payload_digest') or hashlib.sha256(payload).hexdigest()}", "Content-Type": "application/http; msgtype=response"}
                if revisit:
                    headers |= {"WARC-Refers-To": row.get("refers_to"), "WARC-Profile": REVISIT}
                out.write(member(header_block(headers, len(block)) + block + b"\r\n\r\n"))
                n += 1
        if out is not None:
            out.close()
        return Written(files, n)

    def commit(self, messages):
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        done = [m for m in messages if m is not None]
        old = []
        if not self.overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
                old = json.loads(f.read())["files"]
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"files": old + [x for m in done for x in m.files], "records": sum(m.records for m in done)}).encode())

    def abort(self, messages):
        fs, root = file_system(self.path)
        for m in messages:
            for x in m.files if m is not None else ():
                fs.delete_file(f"{root}/{x}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite):
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let its plans push filters to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# -- operators ------------------------------------------------------------------------------------------------


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each page. Of records with equal payloads of at least ``least`` bytes, that with the smallest id is a response, the others revisit it.

    Null pages are empty payloads. A null id is larger than any other; rows that share the smallest id are all responses.
    Other columns are ignored. An empty table gives an archive without files.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least)
    again = large.groupBy("payload_digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    # a written table has a known size: a small one is broadcast, pages move only for a large one; small pages are dealt by id
    deal = F.when(F.octet_length("payload") < least, F.xxhash64("id", "target_uri")).otherwise(F.lit(0).cast("long"))
    copies = written(again.withColumn("deal", F.lit(0).cast("long")), "warc-copies")
    met = rows.withColumn("deal", deal).join(copies, ["payload_digest", "deal"], "left")
    revisits = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    met.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"), name("id").alias("record_id"), "target_uri", F.lit(date).alias("date"), "payload", "payload_digest", F.when(revisits, name("first")).alias("refers_to")
    ).write.format("warc").mode("append").save(path)


def op4_warc(spark, sf_dir: str) -> DataFrame:
    register(spark)
    path = fresh_path(spark, "warc")
    archive(table(spark, sf_dir, "pages"), path)
    read = spark.read.format("warc").load(path).filter(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) as bigint)")
    full = F.col("record_type") == "response"
    return read.select(
        page("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("http_length")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.expr("substring(payload_digest, 8)")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
