"""Legacy archive converter: ARC files of version 1 and 2 to WARC 1.1.

An ARC file opens with a version block, whose own header line and declared
length frame the field list of the later header lines.  Each record is a header
line (five fields in version 1, ten in version 2, counted from the right, as old
URLs may hold spaces), the declared number of bytes and a line end.  The
converter reads that and synthesises what WARC asks for beyond it: record ids
(a UUID of file name, place and digest, so a retried task writes the same),
timestamps, record types, block and payload digests.  Records whose payload has
occurred become revisits of the one kept in full.

Steps: ``write_arc`` makes ARC files of pages; ``index`` reads headers and
digests; ``revisits`` picks the record kept per payload; ``convert`` writes WARC
files; ``read_warc`` reads them, checking digests.  Files are gzip, one member
per record; ARC input may also be plain.

Scale: a task holds one record at a time; files roll at ``FILE_BYTES``; only
digests and numbers are shuffled, never payloads, and a payload that a third of
all records share is found by a combining aggregate and split by the skew join.

Defined cases: a null payload is empty; a null id leaves the record without one
(as response of a group it comes after all others); records alike in id and
payload are separate records, one of which is kept; a null URL becomes
``unknown:`` and blanks and controls in URLs are percent-encoded; dates that are
not 14 digits become 1970; blocks that are no HTTP response become resource
records; a malformed header line or short block is an error; an empty table
writes nothing and reads back as no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import staged
from .files import new_name, stream_reader, writer

FILE_BYTES = 128 << 20
REVISIT_BYTES = 1000
LEVEL = 1
BROADCAST_ROWS = 100_000
# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class _Members:
    """An output file with one gzip member per record."""

    def __init__(self, uri: str):
        self.uri, self.out, self.at = uri, writer(uri), 0

    def add(self, *parts: bytes) -> None:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = b"".join([*map(z.compress, parts), z.flush()])
        self.out.write(member)
        self.at += len(member)

    def close(self) -> None:
        self.out.close()


def _opened(uri: str) -> BinaryIO:
    raw = io.BufferedReader(stream_reader(uri), 1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def _exactly(f: BinaryIO, n: int, where: str) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError(f"{where}: {n} bytes declared, {len(data)} found")
    return data


def _url(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url or "unknown:") or "unknown:"


# ---- ARC ---------------------------------------------------------------

def arc_line(version: int, url: str, ip: str, date: str, kind: str, length: int, status: str = "200",
             checksum: str = "-", offset: int = 0, filename: str = "-") -> bytes:
    extra = f"{status} {checksum} - {offset} {filename} " if version == 2 else ""
    return f"{_url(url)} {ip} {date} {kind} {extra}{length}\n".encode()


def arc_head(version: int, filename: str, date: str) -> bytes:
    body = f"{version} 0 converter\n{ARC_FIELDS[version]}\n".encode()
    # the version block's own line has the five short fields in both versions
    return arc_line(1, f"filedesc://{filename}", "0.0.0.0", date, "text/plain", len(body)) + body + b"\n"


def read_arc(f: BinaryIO, where: str = "arc") -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record after the version block."""
    fields: list[str] | None = None
    while line := f.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
        names = fields or ARC_FIELDS[1].split()
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"{where}: not a header line: {text[:200]!r}")
        head = dict(zip(names, values))
        block = _exactly(f, int(head["Archive-length"]), where)
        if fields is None:
            version, _, rest = block.partition(b"\n")
            if not head["URL"].startswith("filedesc:") or version[:1] not in (b"1", b"2"):
                raise ValueError(f"{where}: no version block")
            fields = rest.split(b"\n")[0].decode().split()
            if fields != ARC_FIELDS[int(version[:1])].split():
                raise ValueError(f"{where}: unknown fields {fields}")
            yield {"version": version[:1].decode(), **head}, block
            continue
        yield head, block


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """(head with its blank line, payload) of an HTTP response, else None."""
    if not block.startswith(b"HTTP/"):
        return None
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def http_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def write_arc(pages: DataFrame, ident: str = "page_id", url: str = "url", payload: str = "html",
              date: str = "20200101000000", folder: str | None = None,
              file_bytes: int = FILE_BYTES) -> DataFrame:
    """ARC files of pages, even partitions as version 1, odd as 2; returns (file)."""
    folder = folder or scratch_path(pages.sparkSession, "arc")
    src = pages.select(F.col(f"`{ident}`").cast("long"), F.col(f"`{url}`"), F.col(f"`{payload}`"))

    def run(batches):
        version = 1 + TaskContext.get().partitionId() % 2
        out, done = None, []
        for b in batches:
            for k in range(b.num_rows):
                i, u, p = (c[k].as_py() for c in b.columns)
                if out is None:
                    out = _Members(new_name(folder, ".arc.gz"))
                    name = out.uri.rsplit("/", 1)[-1]
                    out.add(arc_head(version, name, date))
                body = (p or "").encode()
                head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(body)}\r\n" + (f"X-Page-Id: {i}\r\n" if i is not None else "") + "\r\n").encode()
                out.add(arc_line(version, u, "0.0.0.0", date, "text/html", len(head) + len(body),
                                 offset=out.at, filename=name), head, body, b"\n")
                if out.at >= file_bytes:
                    out.close()
                    done.append(out.uri)
                    out = None
        if out is not None:
            out.close()
            done.append(out.uri)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["file"])

    return staged(src.mapInArrow(run, "file string"), "arc-manifest")


# ---- conversion --------------------------------------------------------

def _spread(files: DataFrame) -> DataFrame:
    return files.repartition(max(1, min(files.count(), 10_000)))


def index(arcs: DataFrame) -> DataFrame:
    """(file, place, page, digest, bytes) of every HTTP record of ARC files."""
    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                for place, (_, block) in enumerate(read_arc(_opened(file), file)):
                    parts = http_parts(block)
                    if parts:
                        page = http_fields(parts[0]).get("x-page-id")
                        rows.append((file, place, int(page) if page else None,
                                     hashlib.sha1(parts[1]).digest(), len(parts[1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
                        pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64()))],
                    ["file", "place", "page", "digest", "bytes"])

    return staged(_spread(arcs.select("file")).mapInArrow(
        run, "file string, place int, page long, digest binary, bytes long"), "arc-index")


def revisits(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(file, place, kept): records to write as revisits and the record kept.

    Of records with equal payloads of ``least`` bytes or more the one with the
    largest page id is kept.
    """
    big = records.where(F.col("bytes") >= least)
    kept = big.groupBy("digest", "bytes").agg(
        F.count("*").alias("n"), F.max(F.struct("page", "file", "place")).alias("kept")).where("n > 1").drop("n")
    if kept.count() <= BROADCAST_ROWS:
        kept = F.broadcast(kept)
    return big.join(kept, ["digest", "bytes"]).where(
        (F.col("file") != F.col("kept.file")) | (F.col("place") != F.col("kept.place"))).select(
        "file", "place", F.struct("kept.file", "kept.place", "kept.page").alias("kept"))


def record_id(file: str, place: int, digest: bytes) -> str:
    name = file.rsplit("/", 1)[-1]
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{place}#{digest.hex()}')}>"


def _digest(d: bytes) -> str:
    return "sha1:" + base64.b32encode(d).decode()


def _date(d: str) -> str:
    ok = len(d) == 14 and d.isdigit()
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z" if ok else "1970-01-01T00:00:00Z"


def warc_record(file: str, place: int, head: dict[str, str], block: bytes, kept: dict | None) -> tuple[bytes, bytes]:
    """(header, block) of the WARC record equivalent to one ARC record."""
    parts = http_parts(block)
    payload = hashlib.sha1(parts[1] if parts else block).digest()
    kind, mime = "resource", head["Content-type"]
    if "version" in head:
        kind, mime = "warcinfo", "application/warc-fields"
        block = f"software: arc converter\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC {head['version']}\r\n".encode()
        payload = hashlib.sha1(block).digest()
    elif parts:
        kind, mime = "revisit" if kept else "response", "application/http; msgtype=response"
        block = parts[0] if kept else block
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": record_id(file, place, payload), "WARC-Date": _date(head["Archive-date"]),
        "WARC-Target-URI": None if kind == "warcinfo" else head["URL"],
        "WARC-IP-Address": None if kind == "warcinfo" else head["IP-address"],
        "WARC-Filename": file.rsplit("/", 1)[-1] if kind == "warcinfo" else None,
        "WARC-Payload-Digest": _digest(payload) if parts else None,
        "WARC-Block-Digest": _digest(hashlib.sha1(block).digest()), "Content-Type": mime,
    }
    if kept:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(kept["file"], kept["place"], payload),
                   "X-Refers-To-Page": None if kept["page"] is None else str(kept["page"])}
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogateescape"), block


def convert(arcs: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES) -> DataFrame:
    """WARC files equivalent to ARC files, one for each; returns (file)."""
    folder = folder or scratch_path(arcs.sparkSession, "warc")
    again = revisits(index(arcs), least).groupBy("file").agg(
        F.collect_list(F.struct("place", "kept")).alias("again"))
    work = staged(arcs.select("file").join(again, "file", "left"), "warc-work")

    def run(batches):
        for b in batches:
            for file, again in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                kept = {x["place"]: x["kept"] for x in again or ()}
                out = _Members(new_name(folder, ".warc.gz"))
                for place, (head, block) in enumerate(read_arc(_opened(file), file)):
                    header, block = warc_record(file, place, head, block, kept.get(place))
                    out.add(header, block, b"\r\n\r\n")
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array([out.uri], pa.string())], ["file"])

    return staged(_spread(work).mapInArrow(run, "file string"), "warc-manifest")


# ---- WARC --------------------------------------------------------------

def read_warc_records(f: BinaryIO, where: str = "warc") -> Iterator[tuple[dict[str, str], bytes]]:
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"{where}: not a WARC record: {line[:80]!r}")
        head = {}
        while (line := f.readline()).strip():
            k, _, v = line.decode("utf-8", "surrogateescape").partition(":")
            head[k.strip().lower()] = v.strip()
        yield head, _exactly(f, int(head["content-length"]), where)


def read_warc(files: DataFrame, ident: str = "page_id") -> DataFrame:
    """One row per response or revisit record of WARC files.

    Payload bytes and digest are those of the full payload also for revisits;
    blocks and full payloads are checked against their digests.
    """
    names = [ident, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "warc_date", "record_id"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def parsed(file):
        for head, block in read_warc_records(_opened(file), file):
            if _digest(hashlib.sha1(block).digest()) != head["warc-block-digest"]:
                raise ValueError(f"{file}: {head['warc-record-id']} fails its block digest")
            if head["warc-type"] not in ("response", "revisit"):
                continue
            http, payload = http_parts(block)
            fields, digest = http_fields(http), head["warc-payload-digest"]
            if head["warc-type"] == "response" and _digest(hashlib.sha1(payload).digest()) != digest:
                raise ValueError(f"{file}: {head['warc-record-id']} fails its payload digest")
            page, refers = fields.get("x-page-id"), head.get("x-refers-to-page")
            yield (int(page) if page else None,
                   len(payload) if head["warc-type"] == "response" else int(fields["content-length"]),
                   base64.b32decode(digest.removeprefix("sha1:")).hex(), head["warc-type"],
                   int(refers) if refers else None, head["warc-target-uri"].encode("utf-8", "replace").decode(),
                   head["warc-date"], head["warc-record-id"])

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                for row in parsed(file):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return _spread(files.select("file")).mapInArrow(
        run, f"`{ident}` long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "url string, warc_date string, record_id string")
