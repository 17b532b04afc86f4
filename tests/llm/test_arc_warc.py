import gzip
import hashlib
import io

import pytest
from helpers import same_rows

from mergestat.llm import arc_warc as aw
from mergestat.llm.files import stream_reader
from mergestat.llm.queries import op2_arc_warc

SCHEMA = "page_id long, url string, html string, file string, place int, digest string"
BIG = "é<p>" * 400


def odd_pages():
    rows = [(1, "http://a.example/x", BIG), (2, "http://a.example/a b\n\tc", BIG), (3, None, BIG), (4, "", None),
            (5, "http://e.example/é文", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", "y" * 1000),
            (9, "u", "y" * 1000), (None, "u", BIG), (None, "n", "only" * 300), (10, "u", "z\r\n\r\nWARC/1.1\r\n" * 50_000),
            (11, "u", "HTTP/1.1 200 OK\r\n\r\n" * 60), (9, "u", "y" * 1000)]
    return [(*r, None, 3, "d") for r in rows]


def slow(rows):
    out, best = [], {}
    for k, r in enumerate(rows):
        body = (r[2] or "").encode()
        d = hashlib.sha1(body).hexdigest()
        if len(body) >= 1000 and (d not in best or (r[0] is not None, r[0] or 0) > (rows[best[d]][0] is not None, rows[best[d]][0] or 0)):
            best[d] = k
    for k, r in enumerate(rows):
        body = (r[2] or "").encode()
        d = hashlib.sha1(body).hexdigest()
        again = len(body) >= 1000 and best[d] != k
        out.append((r[0], len(body), d, "revisit" if again else "response", rows[best[d]][0] if again else None))
    return out


def test_odd_pages(spark):
    pages = spark.createDataFrame(odd_pages(), SCHEMA).repartition(3)
    out = aw.read_warc(aw.convert(aw.write_arc(pages, file_bytes=2000)))
    assert same_rows([tuple(r)[:5] for r in out.collect()], slow(odd_pages()))


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert aw.read_warc(aw.convert(aw.write_arc(pages))).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_of_both_versions(version):
    body = b"HTTP/1.0 404 Not Found\r\nServer: x\r\n\r\nbody\nwith lines\n"
    raw = aw.arc_head(version, "f.arc", "19970102030405")
    raw += aw.arc_line(version, "http://a/ b", "1.2.3.4", "19970102030405", "text/html", len(body)) + body + b"\n"
    raw += (f"http://old/with blank 5.6.7.8 1997 text/plain {'404 - - 9 f.arc ' if version == 2 else ''}3\nabc\n").encode()
    got = list(aw.read_arc(io.BytesIO(raw)))
    assert got[0][0]["version"] == str(version)
    assert got[1][0]["URL"] == "http://a/%20b" and got[1][1] == body
    assert got[2][0]["URL"] == "http://old/with blank" and got[2][1] == b"abc"
    if version == 2:
        assert got[2][0]["Result-code"] == "404" and got[2][0]["Filename"] == "f.arc"
    info, page, other = (aw.warc_record("f.arc", k, h, b, None) for k, (h, b) in enumerate(got))
    assert b"WARC-Type: warcinfo" in info[0] and f"converted-from: ARC {version}".encode() in info[1]
    assert b"WARC-Type: response" in page[0] and b"WARC-Date: 1997-01-02T03:04:05Z" in page[0] and page[1] == body
    assert b"WARC-Type: resource" in other[0] and b"WARC-Date: 1970-01-01T00:00:00Z" in other[0]


@pytest.mark.parametrize("raw", [b"no header\n", aw.arc_line(1, "http://x", "0", "1", "t", 5) + b"hello\n",
                                 aw.arc_head(1, "f", "1") + b"http://x 0 1 text 50\nshort\n"])
def test_malformed_archives_are_errors(raw):
    with pytest.raises(ValueError):
        list(aw.read_arc(io.BytesIO(raw)))


def test_plain_arc_files_convert_too(spark, tmp_dir):
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\nContent-Length: 5\r\n\r\nhello"
    with open(f"{tmp_dir}/p.arc", "wb") as f:
        f.write(aw.arc_head(1, "p.arc", "20010101000000") + aw.arc_line(1, "http://x", "0", "20010101000000", "text/html", len(body)) + body + b"\n")
    warcs = aw.convert(spark.createDataFrame([(f"{tmp_dir}/p.arc",)], "file string"))
    assert [tuple(r)[:5] for r in aw.read_warc(warcs).collect()] == [(4, 5, hashlib.sha1(b"hello").hexdigest(), "response", None)]
    raw = gzip.GzipFile(fileobj=stream_reader(warcs.first().file)).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and raw.endswith(b"hello\r\n\r\n")


def test_ids_are_the_same_in_a_retried_task():
    assert aw.record_id("a/f.arc", 3, b"d" * 20) == aw.record_id("b/f.arc", 3, b"d" * 20) != aw.record_id("f.arc", 4, b"d" * 20)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert same_rows([tuple(r)[:5] for r in op2_arc_warc(spark, sf).collect()], slow(rows))
