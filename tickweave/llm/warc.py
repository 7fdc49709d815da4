"""Legacy ARC archives, their conversion to WARC, and the reading of both.

An ARC file is a version block, whose second line names the version and third the fields of
every record header, and records: a header line in that version's fields, the last of which
declares the length, then that many bytes. The converter reads header lines by version,
trusts only declared lengths, and makes up what WARC wants: record identifiers from the
content (equal on every rerun), ISO dates, types and SHA-256 digests. Of equal payloads of
``revisit_from`` bytes or more the one with the smallest page id is a response, the others
are revisits that refer to it and carry the HTTP head only.

Archives are written by Spark's text writer (gzip), so a lost executor or a repeated task
leaves no half file; a task reads its archives one by one. Which payloads repeat is counted
by digest, and only records with a repeated digest are shuffled, found by a bitmap of fixed size.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import shared_folder

from .common import materialise, settings, split_by_ids

FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_CAPTURE = "page_id long, url string, ip string, date string, mime string, head binary, payload binary, payload_bytes long, digest string"
#: Archives are read about as often as written: fast compression costs the least in all.
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_BLANK = re.compile(r"[\x00-\x20\x7f]")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder that nothing else uses, where all executors can reach it."""
    return f"{shared_folder(spark).rstrip('/')}/tickweave-llm/{kind}-{uuid.uuid4().hex}"


def arc_record(version: str, url: str, ip: str, date: str, mime: str, block: bytes) -> bytes:
    more = " 200 - - 0 -" if version == "2" and not url.startswith("filedesc:") else " 200 - - 0 archive" if version == "2" else ""
    return f"{url} {ip} {date} {mime}{more} {len(block)}\n".encode() + block


def version_block(version: str, date: str) -> bytes:
    minor = "0 archive-writer"
    return arc_record(version, "filedesc://archive.arc", "0.0.0.0", date, "text/plain", f"{version} {minor}\n{FIELDS[version]}\n".encode())


def _arc(batches: Iterator[pa.RecordBatch], version: str | None, date: str) -> Iterator[pa.RecordBatch]:
    version = version or "12"[TaskContext.get().partitionId() % 2]
    yield pa.RecordBatch.from_arrays([pa.array([version_block(version, date)], pa.binary())], names=["value"])
    for batch in batches:
        out = []
        for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            body = (html or "").encode()
            name = "" if page is None else str(page)
            url = _BLANK.sub(lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{name or 'none'}")
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {name}\r\nContent-Length: {len(body)}\r\n\r\n"
            out.append(arc_record(version, url, "0.0.0.0", date, "text/html", head.encode() + body))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_arc(pages: DataFrame, folder: str, version: str | None = None, date: str = "20240101000000", split_bytes: str = "32m") -> None:
    """Pages (page_id, url, html) as gzipped ARC archives, one per task of about ``split_bytes`` of input.

    ``version`` is "1" or "2"; None alternates. Null urls become a urn, null html an empty
    payload, a null page id an empty header field; other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    with settings(pages.sparkSession, spark__sql__files__maxPartitionBytes=split_bytes):
        records = rows.mapInArrow(lambda it: _arc(it, version, date), "value binary")
        records.select(F.col("value").cast("string")).write.options(**_GZIP).option("lineSep", "\n").text(folder)


class Bytes:
    """Sequential reading of a gzipped buffer (any number of members), a piece at a time."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.have, self.pos, self.zip = memoryview(raw), 0, bytearray(), 0, zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.pos > 1 << 20:
            del self.have[: self.pos]
            self.pos = 0
        while self.at < len(self.raw) or self.zip.unconsumed_tail:
            feed = self.zip.unconsumed_tail or self.raw[self.at : self.at + (1 << 18)]
            if not self.zip.unconsumed_tail:
                self.at += len(feed)
            got = self.zip.decompress(feed, 1 << 22)
            if self.zip.eof:
                self.at -= len(self.zip.unused_data)
                self.zip = zlib.decompressobj(31)
            if got:
                self.have += got
                return True
        return False

    def line(self) -> bytes | None:
        """Up to and with the next line feed; None at the end."""
        seen = self.pos
        while (end := self.have.find(b"\n", seen)) < 0:
            seen = len(self.have) - self.pos
            if not self._more():
                return None
            seen += self.pos
        out = bytes(self.have[self.pos : end + 1])
        self.pos = end + 1
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) - self.pos < n:
            if not self._more():
                raise ValueError(f"archive ends {n - len(self.have) + self.pos} bytes before a declared length")
        out = bytes(self.have[self.pos : self.pos + n])
        self.pos += n
        return out


def arc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records behind the version block of a gzipped ARC file."""
    source, names = Bytes(raw), None
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        block = source.take(int(parts[-1]))
        if names is None:
            version, fields = block.decode().split("\n")[:2]
            names = FIELDS.get(version.split(" ")[0], fields).split(" ")
            continue
        if len(parts) != len(names):
            raise ValueError(f"header of {len(parts)} fields where the version has {len(names)}: {parts[0][:200]}")
        yield dict(zip(names, parts, strict=True)), block


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP head with its blank line, and the payload; a block without head is all payload."""
    if block.startswith(b"HTTP/") and (end := block.find(b"\r\n\r\n")) >= 0:
        return block[: end + 4], block[end + 4 :]
    return b"", block


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace") if m else None


def _flush(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(columns[n], k) for n, k in kinds.items()], names=list(kinds))
    for c in columns.values():
        c.clear()
    return out


def _rows(files: Iterator[pa.RecordBatch], parse, kinds: dict[str, pa.DataType], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows that ``parse`` makes of each file, in batches of about ``most`` payload bytes."""
    columns: dict[str, list] = {n: [] for n in kinds}
    held = 0
    for batch in files:
        for raw in batch.column("content"):
            for row, size in parse(raw.as_py()):
                for n in kinds:
                    columns[n].append(row[n])
                held += size
                if held >= most or len(columns[next(iter(kinds))]) >= 10_000:
                    yield _flush(columns, kinds)
                    held = 0
    yield _flush(columns, kinds)


def _captures(raw: bytes, payloads: bool):
    for fields, block in arc_records(raw):
        head, payload = split_http(block)
        page = http_field(head, "X-Page-Id")
        row = {"page_id": int(page) if page else None, "url": fields["URL"], "ip": fields["IP-address"], "date": fields["Archive-date"], "mime": fields["Content-type"]}
        row |= {"head": head, "payload": payload if payloads else b"", "payload_bytes": len(payload), "digest": hashlib.sha256(payload).hexdigest()}
        yield row, len(block) if payloads else 0


_KINDS = {"page_id": pa.int64(), "url": pa.string(), "ip": pa.string(), "date": pa.string(), "mime": pa.string(), "head": pa.binary(), "payload": pa.binary(), "payload_bytes": pa.int64(), "digest": pa.string()}


def read_arc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Captures of all archives of a folder; without ``payloads`` only what describes them."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(lambda it: _rows(it, lambda raw: _captures(raw, payloads), _KINDS), _CAPTURE)


def record_id(url: str, date: str, page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {page} {digest}')}>"


def iso_date(date: str) -> str:
    """The WARC form of an ARC date of 14 digits (fewer: the missing ones at their least)."""
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"WARC/1.1\r\nWARC-Type: {kind}\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}\r\n\r\n"]
    return "".join(lines).encode() + block


def _warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = True
    for batch in batches:
        out = []
        if first:
            info = {"WARC-Record-ID": record_id("warcinfo", "", None, ""), "WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}
            out.append(_record("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
            first = False
        for r in batch.to_pylist():
            fields = {
                "WARC-Record-ID": record_id(r["url"], r["date"], r["page_id"], r["digest"]), "WARC-Date": iso_date(r["date"]), "WARC-Target-URI": r["url"], "WARC-IP-Address": r["ip"],
                "WARC-Payload-Digest": f"sha256:{r['digest']}", "Content-Type": "application/http; msgtype=response",
            }
            of = r["original"]
            if of is None:
                block = r["head"] + r["payload"]
                fields["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(block).hexdigest()}"
                out.append(_record("response", fields, block))
            else:
                fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(of["url"], of["date"], of["page_id"], r["digest"]), "WARC-Refers-To-Target-URI": of["url"], "WARC-Refers-To-Date": iso_date(of["date"]), "X-Refers-To-Page-Id": str(of["page_id"])}
                out.append(_record("revisit", fields, r["head"]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, revisit_from: int = 100) -> None:
    """The archives of one folder as gzipped WARC archives in another.

    Without page id a capture is never what others refer to, but may be a revisit. Captures
    that repeat the smallest page id of their payload are responses, too.
    """
    light = read_arc(spark, arc_folder, payloads=False).where(F.col("payload_bytes") >= revisit_from)
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url", "date"))).alias("original")
    repeated = light.groupBy("digest").agg(F.count("*").alias("n"), first).where("n > 1 and original is not null").select(F.col("digest").alias("of"), "original")
    repeated = materialise(repeated)
    maybe, single = split_by_ids(read_arc(spark, arc_folder), repeated, "digest", "of")
    maybe = maybe.join(repeated, maybe["digest"] == repeated["of"], "left").drop("of")
    shape = "struct<page_id:bigint,url:string,date:string>"
    is_first = F.col("original").isNull() | F.col("page_id").eqNullSafe(F.col("original.page_id"))
    maybe = maybe.withColumn("original", F.when(is_first, F.lit(None).cast(shape)).otherwise(F.col("original")))
    records = single.withColumn("original", F.lit(None).cast(shape)).unionByName(maybe).mapInArrow(_warc, "value binary")
    records.select(F.col("value").cast("string")).write.options(**_GZIP).option("lineSep", "\r\n\r\n").text(warc_folder)


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a gzipped WARC file, by declared lengths."""
    source = Bytes(raw)
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:60]!r}")
        fields: dict[str, str] = {}
        while (line := source.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, source.take(int(fields["content-length"]))


def _described(raw: bytes):
    for fields, block in warc_records(raw):
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        head, payload = split_http(block)
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
        size = len(payload) if kind == "response" else int(http_field(head, "Content-Length") or 0)
        page, refers = http_field(head, "X-Page-Id"), fields.get("x-refers-to-page-id")
        yield {
            "page_id": int(page) if page else None, "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": int(refers) if refers else None,
            "record_id": fields["warc-record-id"], "target_uri": fields["warc-target-uri"], "warc_date": fields["warc-date"],
        }, 0


_READ = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "record_id": pa.string(), "target_uri": pa.string(), "warc_date": pa.string()}


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response and revisit of all archives of a folder; payload digests are verified."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(lambda it: _rows(it, _described, _READ), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, warc_date string")
