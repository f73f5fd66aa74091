"""Legacy archives: ARC files written, converted to WARC, and WARC files read.

An ARC file starts with a version block that names the fields of its header lines; version 1 has five
fields, version 2 ten. A header line ends with the declared length of the content that follows. The
converter parses these and makes WARC records of them: identifiers from the file and the place in it,
ISO timestamps, types by scheme and content, SHA-256 digests. Records of the same payload of at least
``MIN_REVISIT`` bytes become revisits of the first one (smallest number in the ordering header, then
date, then id).

Files are read whole by a task but unpacked as a stream, so a task holds one packed file and one
record. Archives are written by Spark's text writer: records are its rows, and the line separator is
what the format puts after a record. Bytes go through unchanged.

Defined cases: a null or empty body is an empty payload; a page without an id has ``-`` in the
ordering header and comes after all others; equal rows are a response and its revisits; a null
address becomes ``unknown:``. No pages give no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.llm.common import written

# fixed values of the ARC formats: fields of a header line by version
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ORDER_HEADER = "X-Page-Id"
MIN_REVISIT = 100
# fixed value of the WARC format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# --- ARC ----------------------------------------------------------------------------


def arc_line(version: int, url: str, date: str, mime: str, content: bytes, ip: str = "0.0.0.0", status: str = "200") -> bytes:
    clean = re.sub(r"\s", lambda m: quote(m[0]), url)
    extra = [status, hashlib.md5(content).hexdigest(), "-", "0", "-"] if version == 2 else []
    return " ".join([clean, ip, date, mime, *extra, str(len(content))]).encode() + b"\n"


def arc_head(version: int, name: str, date: str) -> bytes:
    content = f"{version} 0 tracefold\n{ARC_FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", date, "text/plain", content) + content


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", date: str = "20240101000000") -> None:
    """A file for each partition, versions 1 and 2 in turn."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version, head = 1 + task % 2, arc_head(1 + task % 2, f"pages-{task}.arc", date)
        for batch in batches:
            out = [head] if head else []
            head = b""
            for key, url, body in zip(*(batch[c] for c in ("key", "url", "body"))):
                payload = (body.as_py() or "").encode()
                shown = key.as_py() if key.is_valid else "-"
                content = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                           f"{ORDER_HEADER}: {shown}\r\n\r\n").encode() + payload
                out.append(arc_line(version, url.as_py() or "unknown:", date, "text/html", content) + content)
                if len(out) == 200:
                    yield made(out)
                    out = []
            yield made(out)

    def made(out: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(body).alias("body"))
    rows.mapInArrow(records, "value binary").select(F.col("value").cast("string")).write.option("compression", "gzip").text(path)


@dataclass
class ArcRecord:
    place: int
    version: int
    fields: dict[str, str]
    content: bytes
    leads: bool = False  # the version block


def opened(data: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """All records, the version block first."""
    stream, place, version, names = opened(data), 0, 0, ARC_FIELDS[1].split()
    while line := stream.readline():
        start, place = place, place + len(line)
        if not line.strip():
            continue
        # an address may hold spaces: the other fields are taken from the end
        values = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if not version:  # the first line may have the fields of either version; its length is last in both
            values = line.decode("utf-8", "replace").split()
            values = [*values[:4], values[-1]]
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no ARC header line at {start}: {line[:100]!r}")
        content = stream.read(int(values[-1]))
        if len(content) < int(values[-1]):
            raise ValueError(f"the record at {start} is cut short")
        place += len(content)
        if not version:
            version = int(content.split(None, 1)[0])
            yield ArcRecord(start, version, dict(zip(names, values)), content, True)
            names = (content.decode().splitlines()[1:2] or [ARC_FIELDS[version]])[0].split()
        else:
            yield ArcRecord(start, version, dict(zip(names, values)), content)


# --- WARC ---------------------------------------------------------------------------


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    def dump(self) -> bytes:
        lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in self.headers.items()), f"Content-Length: {len(self.block)}", "", ""]
        return "\r\n".join(lines).encode() + self.block


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    head, mark, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + mark, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, payload


def sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def warc_date(digits: str) -> str:
    """ISO form of up to 14 digits; what is left out is the least that is valid."""
    d = (re.sub(r"\D", "", digits) + "00000101000000"[len(re.sub(r"\D", "", digits)):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def converted(record: ArcRecord, file: str) -> WarcRecord:
    """The WARC record of an ARC record."""
    url, ip = record.fields["URL"], record.fields.get("IP-address", "")
    headers = {"WARC-Type": "resource", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{record.place}')}>",
               "WARC-Date": warc_date(record.fields["Archive-date"])}
    if record.leads and url.startswith("filedesc:"):
        block = f"software: tracefold\r\nformat: WARC File Format 1.0\r\ndescription: from ARC version {record.version}, {url}\r\n".encode()
        return WarcRecord(headers | {"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields", "WARC-Block-Digest": sha256(block)}, block)
    headers["WARC-Target-URI"] = url
    if ip not in ("", "0.0.0.0", "-"):
        headers["WARC-IP-Address"] = ip
    if record.content.startswith(b"HTTP/"):
        _, http, payload = split_http(record.content)
        headers |= {"WARC-Type": "response", "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": sha256(payload)}
    else:
        http, payload = {}, record.content
        headers |= {"Content-Type": record.fields["Content-type"], "WARC-Payload-Digest": sha256(payload)}
    return WarcRecord(headers | {"WARC-Block-Digest": sha256(record.content)}, record.content, http, payload)


def as_revisit(record: WarcRecord, to: dict[str, str]) -> WarcRecord:
    """The HTTP head stays, the payload goes."""
    head = split_http(record.block)[0]
    headers = record.headers | {
        "WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": to["id"],
        "WARC-Refers-To-Target-URI": to["uri"], "WARC-Refers-To-Date": to["date"], "WARC-Block-Digest": sha256(head)}
    return WarcRecord(headers, head, record.http)


def parse_warc(data: bytes) -> Iterator[WarcRecord]:
    stream = opened(data)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:100]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        size = int(headers.pop("Content-Length"))
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the last record is cut short")
        is_http = headers.get("Content-Type", "").startswith("application/http")
        _, http, payload = split_http(block) if is_http else (b"", {}, block)
        record = WarcRecord(headers, block, http, payload)
        if headers["WARC-Type"] in ("response", "resource") and headers.get("WARC-Payload-Digest", "").startswith("sha256:") \
                and sha256(payload) != headers["WARC-Payload-Digest"]:
            raise ValueError(f"wrong payload digest of {headers['WARC-Record-ID']}")
        yield record


# --- on Spark -----------------------------------------------------------------------


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _number(shown: str | None) -> int | None:
    return int(shown) if shown and re.fullmatch(r"-?\d+", shown) else None


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _index(files: DataFrame) -> DataFrame:
    """Where each response or resource is, its digest and what orders it."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("id", pa.string()), ("uri", pa.string()), ("date", pa.string()),
                        ("number", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                rows = []
                for arc in parse_arc(content.as_py()):
                    w = converted(arc, path)
                    if w.headers["WARC-Type"] == "response":
                        rows.append({"path": path, "place": arc.place, "id": w.headers["WARC-Record-ID"], "uri": w.headers["WARC-Target-URI"],
                                     "date": w.headers["WARC-Date"], "number": _number(w.http.get(ORDER_HEADER.lower())),
                                     "digest": w.headers["WARC-Payload-Digest"], "size": len(w.payload)})
                yield _rows(rows, schema)

    return files.mapInArrow(read, "path string, place long, id string, uri string, date string, number long, digest string, size long")


def convert(spark: SparkSession, arc_path: str, warc_path: str, *, min_revisit: int = MIN_REVISIT) -> None:
    """Write a WARC file for each ARC file."""
    files = _files(spark, arc_path)
    index = written(_index(files).filter(F.col("size") >= min_revisit), "arc-index")
    rank: Column = F.struct(F.col("number").isNull().alias("unnamed"), "number", "date", "id", "uri")
    firsts = (index.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
              .select("digest", F.col("first.id").alias("first_id"), F.struct(F.col("first.id").alias("id"), F.col("first.uri").alias("uri"), F.col("first.date").alias("date")).alias("to")))
    revisits = (index.join(firsts, "digest").filter(F.col("id") != F.col("first_id"))
                .groupBy("path").agg(F.collect_list(F.struct("place", "to")).alias("revisits")))
    # written, so that its size is known before the files are moved for it
    revisits = written(revisits, "revisits")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, revisits in zip(batch["path"].to_pylist(), batch["content"], batch["revisits"].to_pylist()):
                to, out = {r["place"]: r["to"] for r in revisits or ()}, []
                for arc in parse_arc(content.as_py()):
                    record = converted(arc, path)
                    out.append((as_revisit(record, to[arc.place]) if arc.place in to else record).dump())
                    if len(out) == 200:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out = []
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    packed = files.join(revisits, "path", "left").mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    packed.write.options(compression="gzip", lineSep="\r\n\r\n").text(warc_path)


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """A row for each record but warcinfo: its headers, number (of the ordering header), payload_bytes, payload.

    ``payload_bytes`` of a revisit is what its HTTP head says of the payload it stands for.
    """
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("date", pa.string()),
                        ("number", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to_id", pa.string()),
                        *([("payload", pa.binary())] if with_payload else [])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for w in parse_warc(content.as_py()):
                    h, kind = w.headers, w.headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    size = _number(w.http.get("content-length")) if kind == "revisit" else len(w.payload)
                    rows.append({"record_type": kind, "record_id": h["WARC-Record-ID"], "uri": h.get("WARC-Target-URI"), "date": h["WARC-Date"],
                                 "number": _number(w.http.get(ORDER_HEADER.lower())), "payload_digest": h.get("WARC-Payload-Digest"),
                                 "payload_bytes": size, "refers_to_id": h.get("WARC-Refers-To"), "payload": w.payload})
                    if len(rows) == 200:
                        yield _rows(rows, schema)
                        rows = []
                yield _rows(rows, schema)

    kinds = ("record_type string, record_id string, uri string, date string, number long, payload_digest string, "
             "payload_bytes long, refers_to_id string" + (", payload binary" if with_payload else ""))
    return _files(spark, path).mapInArrow(read, kinds)
