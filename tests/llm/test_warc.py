from __future__ import annotations

import base64
import gzip
import hashlib

from touchline.llm import warc
from touchline.session import shared_dir

SCHEMA = "page_id long, url string, html string, payload string, path string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, min_bytes=0):
    first = {}
    for p, _, html, *_ in sorted(pages, key=lambda r: (r[0] is None, r[0])):
        first.setdefault((html or "").encode(), p)
    out = []
    for p, _, html, *_ in pages:
        b = (html or "").encode()
        same = len(b) < min_bytes or first[b] == p or first[b] is None
        out.append((p, len(b), digest(b), "response" if same else "revisit", None if same else first[b]))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a b/é", "<p>x</p>", "1", "2"), (3, None, "<p>x</p>", "1", "2"), (9, "http://c", None, None, None), (1, "u", "", "", ""),
    (4, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200\r\n\r\n" * 3, "", ""), (4, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200\r\n\r\n" * 3, "", ""),
    (7, "u", "é\x00 \n\r\n" * 20000, "", ""), (None, "u", "<p>x</p>", "", ""), (8, "u", "\n\n", "", ""),
]


def test_pages_through_archives(spark):
    for least in (0, 3):
        got = warc.pages_through_archives(spark.createDataFrame(PAGES, SCHEMA), least)
        assert got.filter("error IS NOT NULL").count() == 0
        rows = [tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(rows, key=repr) == expected(PAGES, least)


def test_no_pages(spark):
    assert warc.pages_through_archives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_arc_versions_and_damage():
    for version in (1, 2):
        data = warc.arc_file(version, "f x", [("http://a b", "20010203040506", b"HTTP/1.0 200 OK\r\nX-Page-Id: 12\r\n\r\nhi\n\n"), ("u", "200102030405", b"no head")])
        for content in (data, gzip.compress(data)):
            a, b = list(warc.parse_arc("f", content))
            assert (a["version"], a["url"], a["payload"], a["page_id"], a["date"]) == (version, "http://a%20b", b"hi\n\n", 12, "2001-02-03T04:05:06Z")
            assert a["payload_digest"] == digest(b"hi\n\n") and a["record_id"].startswith("<urn:uuid:")
            assert (b["head"], b["payload"], b["date"]) == (b"", b"no head", "2001-02-03T04:05:00Z")
        assert list(warc.parse_arc("f", data)) == list(warc.parse_arc("f", data))  # ids are repeatable
        cut = list(warc.parse_arc("f", data[:-4]))
        assert "error" not in cut[0] and cut[1]["error"].startswith("bad record line")
    assert list(warc.parse_arc("f", b"nonsense"))[0]["error"]
    assert list(warc.parse_arc("f", b"")) == []


def test_files_in_a_folder(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.arc").write_bytes(warc.arc_file(1 + i % 2, f"{i}", [(f"http://{i}", "20200101000000", warc.http_message(b"same", i))]))
    rec = warc.convert_arc(warc.read_arc(spark, str(tmp_path)))
    out = shared_dir(spark, "warc-test")
    warc.write_warc(warc.mark_revisits(rec, rec), out)
    rows = {r["page_id"]: r for r in warc.read_warc(spark, out).collect()}
    assert bytes(rows[0]["payload"]) == b"same" and rows[0]["record_type"] == "response"
    assert rows[2]["refers_to"] == 0 and rows[2]["payload"] is None and rows[2]["date"] == "2020-01-01T00:00:00Z"
