import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tracefold.cluster import shared_path
from tracefold.llm import warc as W

LONG = "<p>" + "text " * 40 + "</p>"
PAGES = [(5, "http://a/1", LONG), (3, "http://a/2 with space", LONG), (9, "http://b/", LONG), (9, "http://b/", LONG), (1, None, None), (2, "http://c", ""),
         (4, "http://d", "short"), (6, "http://e", "short"), (7, "http://f", "WARC/1.0\r\n\r\nhttp://x 0.0.0.0 2024 text/html 5\n" + "é漢" * 60 + "\r\n\r\n\r\n"),
         (None, "http://g", LONG), (8, "http://h", "x" * 99), (10, "http://i", "x" * 99), (11, "http://j", "y" * 100), (12, "http://k", "y" * 100), (13, "http://l", "z" * 300_000)]


def test_pages_there_and_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("key", "body", "path", "value")}).repartition(3)
    arc, out = shared_path(spark, "arc"), shared_path(spark, "warc")
    W.write_arc(pages, arc)
    W.convert(spark, arc, out)
    found = W.read_warc(spark, out).collect()
    assert len({r.record_id for r in found}) == len(found) == len(PAGES)
    by_id = {r.record_id: r for r in found}
    got = sorted((str(r.number), r.payload_bytes, r.payload_digest, r.record_type, str(by_id[r.refers_to_id].number) if r.refers_to_id else None) for r in found)
    wanted = []
    first_of, done = {}, set()
    for k, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        data = (html or "").encode()
        again = len(data) >= 100 and data in done
        wanted.append((str(k), len(data), "sha256:" + hashlib.sha256(data).hexdigest(), "revisit" if again else "response", str(first_of[data]) if again else None))
        first_of.setdefault(data, k)
        done.add(data)
    assert got == sorted(wanted)
    bodies = {(html or "").encode() for _, _, html in PAGES}
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == bodies


def test_no_pages(spark):
    arc, out = shared_path(spark, "arc"), shared_path(spark, "warc")
    W.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), arc)
    W.convert(spark, arc, out)
    assert W.read_warc(spark, out).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_versions_and_record_types(version, packed):
    dns = b"20240203040506\na.example. 60 IN A 1.2.3.4\n"
    http = b"HTTP/1.1 404 Not Found\r\nA: b\r\n\r\n\nbody\n\n"
    data = W.arc_head(version, "x.arc", "20240203040506")
    for url, mime, content in (("dns:a.example", "text/dns", dns), ("http://a.example/q r", "text/html", http), ("ftp://a/f", "application/octet-stream", b"\x00\xff\n")):
        data += b"\n" + W.arc_line(version, url, "20240203040506", mime, content, ip="1.2.3.4", status="404") + content
    records = list(W.parse_arc(gzip.compress(data) if packed else data))
    assert [r.version for r in records] == [version] * 4 and [r.content for r in records[1:]] == [dns, http, b"\x00\xff\n"]
    made = [W.converted(r, "f") for r in records]
    assert [m.headers["WARC-Type"] for m in made] == ["warcinfo", "resource", "response", "resource"]
    assert made[2].headers["WARC-Date"] == "2024-02-03T04:05:06Z" and made[2].headers["WARC-IP-Address"] == "1.2.3.4"
    assert made[2].headers["WARC-Payload-Digest"] == W.sha256(b"\nbody\n\n")
    again = list(W.parse_warc(b"".join(m.dump() + b"\r\n\r\n" for m in made)))
    assert [(a.headers, a.block) for a in again] == [(m.headers, m.block) for m in made]
    with pytest.raises(ValueError):
        list(W.parse_arc(data[:-1]))
    broken = b"".join(m.dump() + b"\r\n\r\n" for m in made).replace(b"\nbody\n", b"\nBODY\n")
    with pytest.raises(ValueError):
        list(W.parse_warc(broken))


def test_a_page_with_a_filedesc_address_stays_a_page():
    page = b"HTTP/1.1 200 OK\r\n\r\nbody"
    data = b"\n" + W.arc_head(1, "x.arc", "20240203040506") + b"\n" + W.arc_line(1, "filedesc://a/b", "20240203040506", "text/html", page) + page
    made = [W.converted(r, "f") for r in W.parse_arc(data)]
    assert [m.headers["WARC-Type"] for m in made] == ["warcinfo", "response"]
    assert made[1].headers["WARC-Target-URI"] == "filedesc://a/b" and made[1].payload == b"body"


def test_dates():
    assert W.warc_date("2024") == "2024-01-01T00:00:00Z" and W.warc_date("199612310159") == "1996-12-31T01:59:00Z"
