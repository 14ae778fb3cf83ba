import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from qmeasures.llm import warc
from qmeasures.llm.common import scratch


def pages():
    long = "é" * 60
    return [(5, "http://a/x y", long), (3, "http://a", long), (9, None, long), (4, "http://b", "short"), (2, "http://c", "short"),
            (7, "http://d", None), (8, "", ""), (10, "http://e", "a\r\n\r\nWARC/1.1\r\n\r\nfiledesc://x 1 2 3 4\n" * 5),
            (11, "http://f", "z" * 300_000), (3, "http://again", long), (None, "http://n", long), (12, "http://g", "z" * 300_000)]


def expected(rows):
    low = {}
    for k, _, html in rows:
        body = (html or "").encode()
        if k is not None and len(body) >= 100:
            low[body] = min(low.get(body, k), k)
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        ref = low.get(body)
        again = k is not None and ref is not None and k > ref
        out.append((k, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", ref if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 400, 8 << 20])
def test_round_trip(spark, size):
    df = spark.createDataFrame([(*r, "x") for r in pages()], "page_id long, url string, html string, head string")
    got = warc.convert_pages(df, scratch(spark, "w"), size=size)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == expected(pages())
    assert {r.url for r in got.where("page_id = 5").collect()} == {"http://a/x%20y"}
    assert {r.date for r in got.collect()} == {"2001-02-03T04:05:06Z"}
    ids = {(r.page_id, r.payload_digest): r.record_id for r in got.collect()}
    assert len(set(ids.values())) == len(ids)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.convert_pages(df, scratch(spark, "w")).collect() == []


def test_foreign_arc_files(spark, tmp_path):
    one = (b"filedesc://old.arc 0.0.0.0 19970101 text/plain 73\n1 0 Some Crawler\n"
           b"URL IP-address Archive-date Content-type Archive-length\n\n"
           b"http://x/a b 1.2.3.4 199702031122 text/html 8\n<p>\n\nhi\xff\nhttp://x/c 1.2.3.4 19980101000000 text/plain 0\n\n")
    assert one[one.index(b"\n") + 1:].index(b"http://x") == 74
    two_body = b"HTTP/1.0 200 OK\nA: b\n\nbody"
    two = (warc.version_block("n.arc", 2, "20000101000000")
           + warc.arc_record(2, b"http://y/", "5.6.7.8", "20000102030405", "text/html", two_body, 0, "n.arc")
           + b"http://y/cut 5.6.7.8 20000102030405 text/html 200 - - 0 n.arc 50\nonly this")
    (tmp_path / "one.arc").write_bytes(one)
    (tmp_path / "two.arc.gz").write_bytes(gzip.compress(two[:100]) + gzip.compress(two[100:]))
    records = warc.parse_arc(warc.read_archives(spark, str(tmp_path)))
    got = sorted((r.version, r.url, r.date, bytes(r.head), bytes(r.payload), r.truncated) for r in records.collect())
    assert got == [(1, "http://x/a b", "199702031122", b"", b"<p>\n\nhi\xff", False),
                   (1, "http://x/c", "19980101000000", b"", b"", False),
                   (2, "http://y/", "20000102030405", b"HTTP/1.0 200 OK\nA: b\n\n", b"body", False),
                   (2, "http://y/cut", "20000102030405", b"", b"only this", True)]
    typed = warc.with_revisits(records.withColumn("key", F.xxhash64("archive", "offset")), "key")
    path = str(tmp_path / "out")
    warc.write_archives(warc.warc_archives(typed, "key"), path)
    back = [x for r in warc.read_archives(spark, path).collect() for x in warc.warc_records(warc.inflate(bytes(r.content)))]
    assert sorted(b for _, b in back) == sorted([b"<p>\n\nhi\xff", b"", two_body, b"only this"])
    assert {f["WARC-Type"] for f, _ in back} == {"response", "resource"}
    assert {f["WARC-Date"] for f, _ in back if "/a" in f["WARC-Target-URI"]} == {"1997-02-03T11:22:00Z"}
    assert sum(f.get("WARC-Truncated") == "length" for f, _ in back) == 1


def test_bad_files():
    for bad in (b"nonsense", b"filedesc://x 0 0 t 20\n3 0 new\nURL Other\n\n", b"http://x 1 2 t five\nabc"):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))
