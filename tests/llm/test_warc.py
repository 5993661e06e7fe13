import hashlib

import pytest

from fieldloom.llm import warc
from fieldloom.storage import new_path
from tests.oracle import connect, differences


def test_query_matches_oracle(spark, root):
    assert differences(warc.op5_warc(spark, root), connect(root), warc.ORACLES["op5_warc"]) == []


@pytest.mark.parametrize("body", [b"", b"x", b"a" * 4096, b"\r\n0\r\n\r\n" * 3000])
def test_framing_round_trip(body):
    assert warc.unchunked(warc.chunked(body)) == body
    assert warc.unchunked(warc.chunked(body)[:-3]) is None
    assert warc.unchunked(b"5\r\nabc") is None and warc.unchunked(b"zz\r\n") is None


def test_archives_hold_what_was_written(spark):
    long = "é\r\n\r\nWARC/1.1\r\n" * 4000
    rows = [(1, "u", None), (2, None, ""), (3, "a b\r\nX: y", "short"), (4, "u", "short"), (5, "u", long), (6, "u", long), (7, "u", "z" * 1000), (8, "u", "z" * 1000), (9, "u", "y" * 999), (10, "u", "y" * 999)]
    rows += [(11, "u", "v" * 20000), (11, "u", "v" * 20000), (None, "u", "v" * 20000)]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "page_id long, url string, html string, digest string, n int")
    path = new_path(spark, "test-archives")
    warc.write_archives(df, path)
    records = warc.read_archives(spark, path)
    assert records.where("record_type = 'response' and payload is null").count() == 0
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in warc.pages_of(records).collect())

    def row(page, text, kind="response", to=None):
        data = (text or "").encode()
        return page or 0, len(data), hashlib.sha1(data).hexdigest(), kind, to, True

    kinds = {5: ("revisit", 6), 7: ("revisit", 8), None: ("revisit", 11)}
    assert got == sorted(row(p, t, *kinds.get(p, ())) for p, _, t in rows)
    warc.write_archives(df.limit(0), path + "-none")
    assert warc.pages_of(warc.read_archives(spark, path + "-none")).count() == 0


def test_damaged_segments(spark):
    digest = "d" * 40
    parts = list(warc.page_records(1, "u", b"q" * 50000, digest, None, False))
    assert len(parts) == 4

    def read(name, chosen):
        path = new_path(spark, name)
        spark.createDataFrame([(p.decode(),) for p in chosen], "value string").write.option("lineSep", "\r\n\r\n").text(path)
        return [None if r.payload is None else bytes(r.payload) for r in warc.read_archives(spark, path).collect()]

    assert read("whole", [parts[2], parts[0], parts[3], parts[1], parts[2]]) == [b"q" * 50000]
    assert read("lost", [parts[0], parts[1], parts[3]]) == [None]
    assert read("unended", parts[:3]) == [None]
    assert read("plain", [b"".join([b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort"])]) == [None]


def test_odd_headers_and_padded_archives():
    import gzip

    def record(length, block=b"HTTP/1.1 200 OK\r\n\r\nbody", page=b"7"):
        head = b"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: " + page + (b"\r\nContent-Length: " + length if length is not None else b"")
        return head + b"\r\n\r\n" + block + b"\r\n\r\n"

    good = record(b"25", b"HTTP/1.1 200 OK\r\n\r\nfirst!")
    for bad in (b"-33", b"many", b"", None, b"9" * 30, "٣".encode()):
        rows = list(warc.parse(record(bad) + good))
        assert [r[-1] for r in rows] == [None, b"HTTP/1.1 200 OK\r\n\r\nfirst!"], bad
        assert list(warc.parse(good + record(bad)))[1][-1] is None
    assert [r[3] for r in warc.parse(record(b"23", page=b"x9") + good)] == [None, 7]
    whole = gzip.compress(good) + gzip.compress(good)
    assert warc.inflate(whole) == good * 2 and warc.inflate(whole + bytes(700)) == good * 2 and warc.inflate(good) == good
    assert good.startswith(warc.inflate(gzip.compress(good)[:-12])) and warc.inflate(whole[:len(whole) // 2] + b"\x1f\x8bxx") == good
    large = gzip.compress(bytes(range(256)) * 5000, 0)
    assert warc.inflate(large + large + b"\0") == bytes(range(256)) * 10000
