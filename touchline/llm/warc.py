"""Legacy archive converter: ARC records to WARC records, files and back.

An ARC file begins with a version block (``filedesc://`` record) that names its
version; every later record has one header line whose fields the version fixes,
then exactly as many bytes as the line declares. :func:`convert_arc` parses such
files and synthesises what WARC asks for: record ids (repeatable UUIDs of file,
offset and payload digest), ISO times, record types and SHA-1 digests.
:func:`mark_revisits` makes one response of the records with equal payloads and
revisits of the others. :func:`write_warc` writes gzip WARC files of bounded size
with Spark's own writer, :func:`read_warc` parses them.

Null payloads are empty; null urls or times become ``urn:unknown`` and the epoch.
Records whose line or length is damaged are returned by ``convert_arc`` with
``error`` set, never skipped in silence. Repeated rows (same id and payload) are
all of the type of the first; a null page id is refered to only where no other exists.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import bound_batches, stage
from touchline.session import shared_dir

# The field lines of the two ARC versions, and protocol texts.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
EPOCH = "19700101000000"
RECORD_BREAK = "\r\n\r\n"
#: Records of one WARC file.
FILE_RECORDS = 1000
#: Records of one ARC file that write_arc makes.
ARC_RECORDS = 200

ARC_SCHEMA = "path string, content binary"
RECORD_SCHEMA = ("path string, offset long, version int, url string, ip string, date string, mime string, page_id long, "
                 "head binary, payload binary, payload_bytes long, payload_digest string, record_id string, error string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _field(value: str | None, empty: str = "-") -> str:
    """ARC fields are separated by single blanks, so a blank inside one is escaped."""
    return re.sub(r"\s", "%20", value) if value else empty


def arc_record(version: int, url: str, date: str, body: bytes, offset: int, name: str) -> bytes:
    common = [_field(url, "urn:unknown"), "0.0.0.0", date, "text/html"]
    if version == 2:
        common += ["200", "-", "-", str(offset), _field(name)]
    return " ".join([*common, str(len(body))]).encode("utf-8") + b"\n" + body + b"\n"


def arc_file(version: int, name: str, records: list[tuple[str, str, bytes]]) -> bytes:
    """An ARC file of (url, 14-digit date, body) records, uncompressed."""
    info = f"{version} 0 touchline\n{ARC_FIELDS[version]}\n\n".encode()
    head = [f"filedesc://{_field(name)}", "0.0.0.0", EPOCH, "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", _field(name)]
    out = bytearray(" ".join([*head, str(len(info))]).encode() + b"\n" + info)
    for url, date, body in records:
        out += arc_record(version, url, date, body, len(out), name)
    return bytes(out)


def http_message(payload: bytes, page_id) -> bytes:
    own = b"" if page_id is None else f"X-Page-Id: {page_id}\r\n".encode()
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + own + b"\r\n" + payload


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload; a body without an HTTP head is all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, gap, payload = body.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap else (b"", body)


def parse_arc(path: str, data: bytes) -> Iterator[dict]:
    """Records of one ARC file in order; a damaged one ends the file and carries ``error``."""
    if data[:2] == b"\x1f\x8b":
        data = _gunzip(data)
    at, version = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # the separator between records
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        want = 5 if version in (None, 1) else 10
        if version is None and len(parts) == 10:
            want = 10
        ok = end >= 0 and len(parts) == want and parts[-1].isdigit() and end + 1 + int(parts[-1]) <= len(data)
        if version is None:
            ok = ok and line.startswith("filedesc://")
        if not ok:
            yield {"path": path, "offset": at, "version": version, "error": f"bad record line: {line[:200]}"}
            return
        body = data[end + 1:end + 1 + int(parts[-1])]
        if version is None:
            number = body.split(b" ", 1)[0]
            fields = body.split(b"\n")[1].decode("ascii", "replace") if b"\n" in body else ""
            version = next((v for v, names in ARC_FIELDS.items() if names == fields), None) or (
                int(number) if number in (b"1", b"2") else None)
            if version is None:
                yield {"path": path, "offset": at, "error": f"unknown version: {number[:20]!r}"}
                return
        else:
            head, payload = split_http(body)
            digest = sha1_base32(payload)
            own = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
            yield {"path": path, "offset": at, "version": version, "url": parts[0], "ip": parts[1],
                   "date": _iso(parts[2]), "mime": parts[3], "page_id": int(own[1]) if own else None,
                   "head": head, "payload": payload, "payload_bytes": len(payload), "payload_digest": digest,
                   "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{at}:{digest}')}>"}
        at = end + 1 + int(parts[-1])


def _iso(date: str) -> str:
    d = date if re.fullmatch(r"\d{14}", date) else (date + "0" * 14)[:14] if re.fullmatch(r"\d{12}", date) else EPOCH
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _gunzip(data: bytes) -> bytes:
    out = bytearray()
    while data:
        d = zlib.decompressobj(31)
        out += d.decompress(data) + d.flush()
        data = d.unused_data
    return bytes(out)


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    cols = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in cols], names=[n for n, _ in cols])


def pages_to_arc(pages: DataFrame, records: int = ARC_RECORDS) -> DataFrame:
    """``path, content``: ARC files of both versions in turn, made from ``page_id, url, html``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for b in batches:
            rows = list(zip(*[b.column(i).to_pylist() for i in range(3)]))
            for at in range(0, len(rows), records):
                part, version = rows[at:at + records], 1 + made % 2
                # The name is of the content, so a task that runs again makes the same file.
                seal = hashlib.sha1(repr([(r[0], len(r[2])) for r in part]).encode()).hexdigest()[:16]
                name = f"legacy-{seal}.arc"
                content = arc_file(version, name, [(u, EPOCH, http_message(html, p)) for p, u, html in part])
                made += 1
                yield _batch([{"path": name, "content": content}], ARC_SCHEMA)

    bound_batches(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    return p.mapInArrow(run, ARC_SCHEMA)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def convert_arc(arc: DataFrame, with_payload: bool = True) -> DataFrame:
    """ARC files (``path, content``) to WARC record rows, see RECORD_SCHEMA.

    Without payload, ``head`` and ``payload`` are null (for passes over digests)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for r in parse_arc(path, content):
                    if not with_payload:
                        r.pop("head", None), r.pop("payload", None)
                    rows.append(r)
                    if len(rows) >= 500:
                        yield _batch(rows, RECORD_SCHEMA)
                        rows = []
                if rows:
                    yield _batch(rows, RECORD_SCHEMA)

    return arc.mapInArrow(run, RECORD_SCHEMA)


def mark_revisits(records: DataFrame, digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers_to``: the smallest page id with an equal payload, null for responses.

    ``digests`` has page_id, payload_bytes, payload_digest of the same records. Only
    these narrow rows are grouped by digest (partial minimum first); payloads are
    joined by page id, so a payload that a third of all pages share meets nowhere.
    """
    d = digests.select("page_id", "payload_bytes", "payload_digest").filter(F.col("payload_bytes") >= min_bytes)
    d = stage(d, "warc-digests")
    first = stage(d.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                  .filter("n > 1 AND first_id IS NOT NULL").select(F.col("payload_digest").alias("_d"), F.col("payload_bytes").alias("_b"), "first_id"), "warc-first")
    again = d.join(first, (F.col("payload_digest") == F.col("_d")) & (F.col("payload_bytes") == F.col("_b")))
    again = again.filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
    again = again.select(F.col("page_id").alias("_p"), F.col("payload_digest").alias("_d"), F.col("first_id").alias("refers_to")).distinct()
    return records.join(again, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("payload_digest") == F.col("_d")), "left").drop("_p", "_d")


def write_warc(records: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Gzip WARC files of at most ``file_records`` records each, written by Spark's text writer.

    A record ends with two line ends: they are the writer's line separator.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            out = []
            for vals in zip(*[c.to_pylist() for c in b.columns]):
                out.append(_warc_record(dict(zip(names, vals))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    cols = ["url", "ip", "date", "page_id", "head", "payload", "payload_bytes", "payload_digest", "record_id", "refers_to", "path", "offset"]
    # cast of bytes to string keeps them as they are, whatever they hold
    text = records.select(*cols).mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", RECORD_BREAK).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def _warc_record(r: dict) -> bytes:
    revisit = r["refers_to"] is not None
    block = r["head"] if revisit else r["head"] + r["payload"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {r['record_id']}",
             f"WARC-Date: {r['date']}", f"WARC-Target-URI: {r['url']}", f"WARC-IP-Address: {r['ip']}",
             f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
             "Content-Type: application/http; msgtype=response", f"X-Payload-Length: {r['payload_bytes']}",
             f"X-Source: {_field(r['path'])}@{r['offset']}"]
    if r["page_id"] is not None:
        lines.append(f"X-Page-Id: {r['page_id']}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page: {r['refers_to']}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block


WARC_SCHEMA = ("record_type string, record_id string, url string, date string, page_id long, refers_to long, payload binary, "
               "payload_bytes long, payload_digest string, error string")


def parse_warc(data: bytes, with_payload: bool = True) -> Iterator[dict]:
    """Records of a WARC file by declared length; digests are computed from the bytes read."""
    if data[:2] == b"\x1f\x8b":
        data = _gunzip(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            yield {"error": f"bad record at {at}"}
            return
        h = dict(x.split(": ", 1) for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        begin, size = end + 4, int(h["Content-Length"])
        if begin + size + 4 > len(data):
            yield {"error": f"cut record at {at}"}
            return
        block = data[begin:begin + size]
        head, payload = split_http(block)
        out = {"record_type": h["WARC-Type"], "record_id": h["WARC-Record-ID"], "url": h["WARC-Target-URI"], "date": h["WARC-Date"],
               "page_id": int(h["X-Page-Id"]) if "X-Page-Id" in h else None,
               "refers_to": int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None}
        stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
        if out["record_type"] == "response":
            out |= {"payload": payload if with_payload else None, "payload_bytes": len(payload), "payload_digest": sha1_base32(payload)}
            if out["payload_digest"] != stated:
                out["error"] = "payload digest differs"
        else:  # a revisit holds no payload: what it states is what there is
            out |= {"payload_bytes": int(h["X-Payload-Length"]), "payload_digest": stated}
        yield out
        at = begin + size + 4


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = []
                for r in parse_warc(content, with_payload):
                    rows.append(r)
                    if len(rows) >= 500:
                        yield _batch(rows, WARC_SCHEMA)
                        rows = []
                if rows:
                    yield _batch(rows, WARC_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, WARC_SCHEMA)


def pages_through_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC, ARC to WARC files in the shared folder, and the records read back."""
    spark = pages.sparkSession
    arc = pages_to_arc(pages)
    marked = mark_revisits(convert_arc(arc), convert_arc(arc, with_payload=False), min_bytes)
    path = shared_dir(spark, "warc")
    write_warc(marked, path)
    return read_warc(spark, path, with_payload=False)
