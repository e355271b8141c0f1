import gzip
import hashlib
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quire.llm.common import fresh_path
from quire.llm.warc import chunked, dechunked, parse, read_records, read_warc, reassembled, write_warc

BIG = "<html>" + "wörld " * 400 + "</html>"
TRICKY = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n0\r\n\r\n" * 40


@pytest.fixture()
def pages(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.withColumns({c: F.lit("other") for c in ("sha1", "number", "refers", "block")})

    return make


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunks(size):
    for body in (b"", b"a", b"0\r\n\r\n" * 50, bytes(range(256)) * 40):
        assert dechunked(chunked(body, size)) == body
    assert dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_round_trip(spark, pages):
    rows = [(1, "u1", BIG), (2, "u2", BIG), (9, "u9", BIG), (3, None, None), (4, "u4", ""), (5, "u5", TRICKY), (None, "n", BIG),
            (6, "short", "abc"), (7, "short", "abc"), (8, "u8", BIG + "é"), (9, "u9", BIG), (10, "l\nf", "x" * 100_000)]
    path = fresh_path(spark, "t")
    write_warc(pages(rows).repartition(3), path, segment_bytes=700, chunk_bytes=333)
    got = read_warc(spark, path).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for i, _, html in rows:
        raw = (html or "").encode()
        for r in by[i]:
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
            if i in (1, 2):
                assert (r.record_type, r.refers_to, r.payload) == ("revisit", 9, None)
            else:
                assert r.record_type == "response" and r.refers_to is None and bytes(r.payload) == raw
    records = read_records(spark, path)
    assert records.filter("type = 'continuation'").count() > 20


def test_lost_segment_fails(spark, pages):
    path = fresh_path(spark, "t")
    write_warc(pages([(1, "u", BIG)]), path, segment_bytes=500)
    records = read_records(spark, path)
    assert reassembled(records).count() == 1
    for lost in (2, 1):
        with pytest.raises(PySparkException, match="incomplete segments"):
            reassembled(records.filter(f"segment <> {lost}")).collect()


def test_segments_in_any_order_and_file(spark, pages):
    path = fresh_path(spark, "t")
    write_warc(pages([(k, "u", BIG + str(k)) for k in range(5)]), path, segment_bytes=400)
    mixed = reassembled(read_records(spark, path).orderBy(F.rand(3))).collect()
    assert len(mixed) == 5


def test_foreign_archives():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nX-Folded: a\r\n b\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    members = gzip.compress(one) + gzip.compress(two)
    got = list(parse(gzip.GzipFile(fileobj=io.BytesIO(members))))
    assert [b for _, b in got] == [b"ab\r\nc", b""] and got[0][0]["x-folded"] == "a b"
    with pytest.raises(ValueError, match="ends within"):
        list(parse(io.BytesIO(one[:-8])))


def test_empty_table(spark, pages):
    path = fresh_path(spark, "t")
    write_warc(pages([]), path)
    assert read_warc(spark, path).collect() == []
