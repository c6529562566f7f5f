"""TIFF, sharding and WARC."""

import hashlib
import io
import struct
import zlib

import numpy as np
import pytest
from helpers import empty, odd_docs, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.llm import sharding, tiff, warc
from strandline.llm.queries import queries

RNG = np.random.default_rng(0)


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("box", [None, (16, 32)])
@pytest.mark.parametrize("planar", [False, True])
def test_tiff_round_trip(compression, predictor, order, box, planar):
    images = [RNG.integers(0, top, shape).astype(kind) for kind in ("u1", "u2") for top in (3, 200) for shape in ((1, 1, 1), (37, 53, 3), (64, 64, 4))]
    got = list(tiff.pages(tiff.encode(images, compression, predictor, order, box, planar, strip=1000)))
    assert all(np.array_equal(a, b.samples) for a, b in zip(images, got, strict=True))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=3000) | st.integers(1, 9000).map(lambda n: bytes(i * i % 7 for i in range(n))))
def test_tiff_codecs(data):
    assert tiff.unlzw(tiff.lzw(data), len(data)) == data
    assert tiff.unpack_bits(tiff.pack_bits(data), len(data)) == data


def test_tiff_full_lzw_table():
    data = bytes(RNG.integers(0, 256, 60_000).astype("u1"))
    assert tiff.unlzw(tiff.lzw(data), len(data)) == data


def test_tiff_bad_files(spark):
    good = tiff.encode([np.zeros((2, 2, 1), dtype=np.uint8)] * 2)
    loop = bytearray(tiff.encode([np.zeros((2, 2, 1), dtype=np.uint8)]))
    loop[-4:] = loop[4:8]
    media = [(1, None), (2, b""), (3, b"II*\0"), (4, good[:40]), (5, bytes(loop)), (6, good), (6, good)]
    got = tiff.read_pages(with_clashes(spark.createDataFrame(media, "doc_id long, picture binary")), "picture").collect()
    assert sorted((r.doc_id, r.page) for r in got if r.error is None) == [(5, 0), (6, 0), (6, 0), (6, 1), (6, 1)]
    assert {r.doc_id for r in got if r.error} == {1, 2, 3, 4, 5}
    assert tiff.read_pages(spark.createDataFrame([], "doc_id long, media binary")).count() == 0


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("box", [None, (16, 32)])
@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff_other_samples(compression, box, order):
    """Bits, half bytes, signed and floating-point numbers, with the floating-point predictor."""
    for bits in (1, 2, 4):
        images = [RNG.integers(0, 1 << bits, shape).astype("u1") for shape in ((1, 1, 1), (5, 37, 3), (40, 64, 1))]
        got = list(tiff.pages(tiff.encode(images, compression, 1, order, box, strip=100, bits=bits)))
        assert all(np.array_equal(a, b.samples) and b.bits == bits for a, b in zip(images, got, strict=True))
    for kind, predictor in (("i1", 2), ("i2", 2), ("u4", 2), ("i8", 1), ("f2", 3), ("f4", 1), ("f4", 3), ("f8", 3)):
        images = [(RNG.random((9, 35, c)) * 100 - 50).astype(kind) for c in (1, 3)]
        for planar in (False, True):
            got = list(tiff.pages(tiff.encode(images, compression, predictor, order, box, planar, strip=500)))
            assert all(np.array_equal(a, b.samples) and a.dtype == b.samples.dtype and tiff.feature(b.samples) for a, b in zip(images, got, strict=True))


def test_tiff_fuzz():
    """Ten thousand damaged files of every compression: each is pages or an error, in little memory and time."""
    r = np.random.default_rng(7)
    images = [r.integers(0, 4, (20, 30, 3)).astype("u1"), r.integers(0, 900, (7, 5, 1)).astype("u2")]
    good = [tiff.encode(images, c, p, o, b) for c in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS) for p in (1, 2) for o in "<>" for b in (None, (16, 16))]
    seen = {"pages": 0, "errors": 0}
    for k in range(10_000):
        data = bytearray(good[k % len(good)])
        start = len(data) - 420 if k % 3 else 0  # most damage to directories, which stand last
        for at in r.integers(start, len(data), r.integers(1, 6)).tolist():
            data[at] = int(r.choice([0, 1, 2, 127, 128, 255, r.integers(0, 256)]))
        if k % 7 == 0:
            del data[r.integers(0, len(data)) :]
        try:
            for order, tags in tiff.directories(bytes(data)):
                try:
                    page = tiff.decode_page(bytes(data), order, tags)
                    tiff.feature(page.samples)
                    seen["pages"] += 1
                except tiff.TiffError:
                    seen["errors"] += 1
        except tiff.DAMAGE:
            seen["errors"] += 1
    assert min(seen.values()) > 2000


def altered(data, tag, value, page=0):
    """``data`` with a tag of a page set; value None: its count."""
    data = bytearray(data)
    at = struct.unpack_from("<I", data, 4)[0]
    for _ in range(page):
        at = struct.unpack_from("<I", data, at + 2 + 12 * struct.unpack_from("<H", data, at)[0])[0]
    for k in range(struct.unpack_from("<H", data, at)[0]):
        if struct.unpack_from("<H", data, at + 2 + 12 * k)[0] == tag:
            struct.pack_into("<I", data, at + (6 if value is None else 10) + 12 * k, value or 0)
    return bytes(data)


def test_tiff_lies(spark):
    """Tags without values, no channels, sizes beyond the file, a wrong checksum; an unknown page between two sound ones."""
    good = tiff.encode([np.full((2, 2, 1), v, dtype=np.uint8) for v in (1, 2, 3)])
    huge = altered(altered(altered(tiff.encode([np.zeros((8, 8, 1), dtype=np.uint8)]), tiff.WIDTH, 1 << 30), tiff.HEIGHT, 1 << 30), tiff.ROWS, 1 << 30)
    wrong = bytearray(tiff.encode([np.arange(64, dtype=np.uint8).reshape(8, 8, 1)]))
    size = struct.unpack_from("<I", wrong, 4)[0]
    at = next(struct.unpack_from("<I", wrong, size + 10 + 12 * k)[0] for k in range(20) if struct.unpack_from("<H", wrong, size + 2 + 12 * k)[0] == tiff.COUNTS)
    wrong[8 + at - 1] ^= 1  # the last byte of the checksum
    media = [(1, altered(good, tiff.WIDTH, None)), (2, altered(good, tiff.CHANNELS, 0)), (3, huge), (4, bytes(wrong)), (7, altered(good, tiff.BITS, 5, 1))]
    got = sorted(tiff.read_pages(spark.createDataFrame(media, "doc_id long, media binary")).collect(), key=lambda r: (r.doc_id, r.page))
    assert all(r.error for r in got if r.doc_id in (3, 4) or r.doc_id in (1, 2) and r.page == 0)
    assert [(r.page, r.samples and r.samples[0], r.error is None) for r in got if r.doc_id == 7] == [(0, 1, True), (1, None, False), (2, 3, True)]


def test_tiff_query(spark, data, rows):
    got = {r.doc_id: r for r in queries()["op1_tiff"](spark, data).collect()}
    assert len(got) == len(rows)
    for r in rows:
        payload = r.text.encode()
        payload += b" " * (-len(payload) % 192 or 192 * (not payload))
        g = got[r.doc_id]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(r.text.encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    odd = tiff.read_pages(tiff.store_texts(with_clashes(odd_docs(spark)))).collect()
    assert len(odd) == 10 and sum(bytes(r.samples) == b" " * 192 for r in odd) == 3


@given(st.integers(1, 400), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_feistel_permutes(n, seed):
    there = [sharding.permute(x, n, seed) for x in range(n)]
    assert sorted(there) == list(range(n))
    assert [sharding.unpermute(p, n, seed) for p in there] == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 4000, 10**9 + 7])
def test_feistel_expression(spark, n):
    top = min(n, 500)
    got = spark.range(top).select("id", sharding.permuted("id", n, 9).alias("p")).collect()
    assert [r.p for r in got] == [sharding.permute(r.id, n, 9) for r in got]


def test_sharding(spark, data, rows):
    got = queries()["op2_feistel"](spark, data).collect()
    n = len(rows)
    assert sorted(r.row_number for r in got) == list(range(n))
    by_id = {r.doc_id: r.text.encode() for r in rows}
    slots = {}
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(by_id[r.doc_id]) + 1, zlib.crc32(by_id[r.doc_id]), "rows", None)
        assert sharding.locate(r.row_number, n) == (r.shard, r.slot)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = spark.read.parquet(f"{data}/documents.parquet").repartition(7)
    assert {(r.doc_id, r.shard, r.slot) for r in sharding.shard(again).collect()} == {(r.doc_id, r.shard, r.slot) for r in got}


def test_sharding_odd_rows(spark):
    got = sharding.shard(with_clashes(odd_docs(spark)), 3).collect()
    assert sorted(r.row_number for r in got) == list(range(10))
    assert sorted(r.size for r in got)[:4] == [1, 1, 1, 5]
    assert sharding.shard(empty(odd_docs(spark))).count() == 0


def payload_of(r):
    return (r.html or "").encode()


def test_warc_query(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet").collect()
    got = {r.page_id: r for r in queries()["op4_warc"](spark, data).collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert (got[p.page_id].payload_bytes, got[p.page_id].payload_digest) == (len(payload_of(p)), hashlib.sha256(payload_of(p)).hexdigest())


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    warc.register(spark)
    same, small = "<p>" + "x" * 200, "tiny"
    rows = [(5, "http://a/5", same), (2, "http://a/2", same), (9, "https://b/9\r\nX: y", same), (1, "u", small), (3, "u", small), (4, None, None), (None, "n", same), (7, "r", "WARC/1.1\r\n" * 50), (7, "r", "WARC/1.1\r\n" * 50)]
    path = str(tmp_path_factory.mktemp("w") / "a")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.archive(with_clashes(df).repartition(3), path)
    return path, rows


def test_warc_revisits(spark, archive):
    path, rows = archive
    read = spark.read.format("warc").load(path)
    got = sorted((r.record_id, r.record_type, r.refers_to) for r in read.collect())
    page = lambda i: f"<urn:page:{i}>"
    assert got == sorted(
        [(page(2), "response", None), (page(5), "revisit", page(2)), (page(9), "revisit", page(2)), (page(""), "revisit", page(2)), (page(1), "response", None), (page(3), "response", None), (page(4), "response", None)] + [(page(7), "response", None)] * 2
    )
    bodies = {r.record_id: bytes(r.payload) for r in read.filter("record_type = 'response'").collect()}
    assert bodies == {page(i): (h or "").encode() for i, _, h in rows if page(i) in bodies}
    assert all(r.http_length == 203 and r.payload is None for r in read.filter("record_type = 'revisit'").collect())


@pytest.mark.parametrize("size", [150, 400, 1 << 20])
def test_warc_ranges_and_predicates(spark, archive, size):
    path, _ = archive
    read = spark.read.format("warc").option("partitionBytes", size).load(path)
    assert read.count() == 9
    for condition in ("record_type = 'revisit'", "target_uri like 'http://a%'", "target_uri is null", "record_type in ('response') and content_length > 200", "not record_type = 'response'", "refers_to is not null and target_uri like '%9%'", "http_status = 200"):
        assert sorted(r.record_id for r in read.filter(condition).collect()) == sorted(r.record_id for r in read.withColumn("keep", F.expr(condition) & (F.rand() >= 0)).filter("keep").collect())
    assert "Filter " not in read.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert read.sparkSession.read.format("warc").option("payload", "false").load(path).filter("payload is not null").count() == 0


def test_warc_foreign_files():
    block = lambda kind, n, body: warc.header_block({"WARC-Type": kind, "X-Long": "a\r\n b"[:1]}, n) + body + b"\r\n\r\n"
    plain = block("warcinfo", 3, b"abc") + block("response", 5, b"WARC/") + block("resource", 0, b"")
    for data in (plain, b"".join(zlib_member(x) for x in (block("warcinfo", 3, b"abc"), block("response", 5, b"WARC/"), block("resource", 0, b"")))):
        got = [(h["warc-type"], c) for _, h, c in warc.records(io.BytesIO(data), len(data), 0, len(data), lambda b: True)]
        assert got == [("warcinfo", b"abc"), ("response", b"WARC/"), ("resource", b"")]
        only = [h["warc-type"] for _, h, _ in warc.records(io.BytesIO(data), len(data), 0, len(data), lambda b: b"resource" in b)]
        assert only == ["resource"]
    for cut in (7, 50, 120):  # every record of a compressed file belongs to one range
        found = []
        for a in range(0, len(data), cut):
            found += [o for o, _, _ in warc.records(io.BytesIO(data), len(data), a, min(a + cut, len(data)), lambda b: True)]
        assert len(found) == 3 and len(set(found)) == 3


def zlib_member(data):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def test_warc_empty(spark, tmp_path):
    warc.register(spark)
    warc.archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert spark.read.format("warc").load(str(tmp_path / "e")).count() == 0
