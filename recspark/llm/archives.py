"""Legacy ARC archives to WARC archives.

ARC: a version block (``filedesc://`` record whose body names the version and
the fields), then records of one header line and as many bytes as its last
field declares. Version 1 lines have five fields, version 2 lines ten; a line
is cut from the right, so blanks in an address survive. Each version block
changes the reader for what follows, so joined archives read well.

The converter synthesises for every record the identifier (a UUID of its
address, date, place and payload), the timestamp, the type and SHA-1 digests of
payload and block. Of records with equal payloads (SHA-256 and length) of at
least ``min_revisit_bytes`` the first, by page number, is the response and the
others become revisits that refer to it.

Archives are written through Spark's text writer: a row is a run of whole
records (a "segment") and the line separator is the separator of the archive
format, so task commits make the files safe against lost executors and any file
system will do. Files hold few segments, which bounds what one task reads. The
files are gzip streams; the reader takes one member per file or per record.

Defined results: a null payload is empty; a null or blank address is ``-`` in
the archive; control characters and blanks of an address are percent-encoded; a
null page number is left out and counts as largest; equal rows give one response
and revisits; a record longer than a segment is a segment of its own; a damaged
header line or a short body ends the reading of that segment's file with a row of type
``damaged``. Empty tables give no files and an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import map_batches, narrow, stored
from recspark.session import scratch_path

SEGMENT = 4 << 20
SEGMENTS_PER_FILE = 4
MIN_REVISIT_BYTES = 0

# Field lines of the two ARC versions (fixed values of the format).
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
         "Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
_INTEGER = re.compile(rb"[+-]?[0-9]+")


def sha1_base32(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_address(url: str | None) -> str:
    out = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    return out or "-"


def inflate(data: bytes) -> bytes:
    """All members of a gzip file; anything else is returned as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def arc_line(version: str, url: str, date: str, content_type: str, payload: bytes,
             offset: int, name: str, ip: str = "0.0.0.0", status: str = "200") -> bytes:
    if version == "1":
        fields = [url, ip, date, content_type, str(len(payload))]
    else:
        fields = [url, ip, date, content_type, status, hashlib.md5(payload).hexdigest(), "-",
                  str(offset), name, str(len(payload))]
    return (" ".join(fields) + "\n").encode()


def version_block(version: str, name: str, date: str, origin: str) -> bytes:
    body = f"{version} 0 {origin}\n{ARC_FIELDS[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode() + body


def _write_arc(date: str, origin: str):
    """Arrow task over (page, url, html): ARC segments, versions 1 and 2 in turn."""
    def run(batches):
        held, size, count = [], 0, 0

        def segment():
            version = "12"[count % 2]
            name = f"segment-{count:06d}.arc"
            out = [version_block(version, name, date, origin)]
            at = len(out[0])
            for url, block in held:
                record = arc_line(version, url, date, "text/html", block, at + 1, name) + block
                out.append(record)
                at += len(record) + 1
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join(out)], pa.binary())], ["value"])

        for batch in batches:
            for page, url, html in zip(*[batch.column(i) for i in range(3)]):
                payload = (html.as_py() or "").encode()
                ident = f"{PAGE_HEADER}: {page.as_py()}\r\n" if page.is_valid else ""
                block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{ident}"
                         f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
                held.append((safe_address(url.as_py()), block))
                size += len(block)
                if size >= SEGMENT:
                    yield segment()
                    held, size, count = [], 0, count + 1
        if held:
            yield segment()
    return run


def arc_records(data: bytes):
    """(offset, header dict, body) of each record, version blocks included; a
    record that can't be read ends the iteration with header None."""
    fields, at, n = ARC_FIELDS["1"].split(), 0, len(data)
    while at < n:
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else n].rstrip(b"\r").decode("utf-8", "replace")
        start = (end if end >= 0 else n) + 1
        names = ARC_FIELDS["1"].split() if line.startswith("filedesc://") else fields
        if line.startswith("filedesc://") and len(line.split(" ")) >= 10:
            names = ARC_FIELDS["2"].split()
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit() or start + int(values[-1]) > n:
            yield at, None, data[at:]
            return
        body = data[start:start + int(values[-1])]
        header = dict(zip(names, values))
        if line.startswith("filedesc://"):
            version = body.split(b" ", 1)[0].decode("utf-8", "replace")
            fields = ARC_FIELDS.get(version, ARC_FIELDS["1"]).split()
        yield at, header, body
        at = start + len(body)


def http_payload(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its blank line, entity); no head for other protocols."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    cut = block.find(b"\r\n\r\n")
    return (block, b"") if cut < 0 else (block[:cut + 4], block[cut + 4:])


def page_of(head: bytes) -> int | None:
    """The page id in a block's head: a signed 64-bit integer; anything else is none."""
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == PAGE_HEADER.lower().encode() and _INTEGER.fullmatch(value.strip()):
            page = int(value)
            return page if -(1 << 63) <= page < 1 << 63 else None
    return None


def record_id(header: dict, place: str, offset: int, digest: str) -> str:
    text = "|".join((header["URL"], header["Archive-date"], place, str(offset), digest))
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, text)}"


def _place(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def warc_date(arc_date: str) -> str:
    d = (arc_date + "00000101000000"[len(arc_date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_ENTRY = ("path string, offset bigint, page_id bigint, record_id string, url string, "
          "date string, size bigint, identity string, http boolean")


def _entries(batches):
    """Arrow task over (path, content): a narrow entry of every ARC record."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            cols = [[] for _ in range(9)]
            for offset, header, body in arc_records(inflate(content.as_py())):
                if header is None or header["URL"].startswith("filedesc://"):
                    continue
                head, payload = http_payload(body)
                row = (path, offset, page_of(head),
                       record_id(header, _place(path), offset, sha1_base32(payload)),
                       header["URL"], warc_date(header["Archive-date"]), len(payload),
                       hashlib.sha256(payload).hexdigest(), bool(head))
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=[f.split()[0] for f in _ENTRY.split(", ")])


def _warc(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def _convert(batches):
    """Arrow task over (path, content, revisits): WARC segments of an ARC file."""
    for batch in batches:
        for path, content, revisits in zip(batch.column(0).to_pylist(), batch.column(1),
                                           batch.column(2).to_pylist()):
            refers = {r["offset"]: r for r in revisits or ()}
            out, size = [], 0
            for offset, header, body in arc_records(inflate(content.as_py())):
                if header is None:
                    record = _warc([("WARC-Type", "x-damaged"), ("WARC-Record-ID",
                                    f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{_place(path)}|{offset}')}>"),
                                    ("WARC-Date", warc_date("")),
                                    ("Content-Type", "application/octet-stream")], body)
                elif header["URL"].startswith("filedesc://"):
                    info = (f"software: recspark\r\nformat: WARC File Format 1.1\r\n"
                            f"source: {header['URL']}\r\n").encode()
                    record = _warc([("WARC-Type", "warcinfo"), ("WARC-Record-ID",
                                    f"<{record_id(header, _place(path), offset, '')}>"),
                                    ("WARC-Date", warc_date(header["Archive-date"])),
                                    ("Content-Type", "application/warc-fields")], info)
                else:
                    head, payload = http_payload(body)
                    digest = sha1_base32(payload)
                    again = refers.get(offset)
                    block = head if again else body
                    fields = [("WARC-Type", "revisit" if again else
                               "response" if head else "resource"),
                              ("WARC-Record-ID",
                               f"<{record_id(header, _place(path), offset, digest)}>"),
                              ("WARC-Date", warc_date(header["Archive-date"])),
                              ("WARC-Target-URI", header["URL"]),
                              ("WARC-IP-Address", header["IP-address"]),
                              ("WARC-Payload-Digest", f"sha1:{digest}"),
                              ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
                    if again:
                        fields += [("WARC-Profile", REVISIT_PROFILE),
                                   ("WARC-Refers-To", f"<{again['record_id']}>"),
                                   ("WARC-Refers-To-Target-URI", again["url"]),
                                   ("WARC-Refers-To-Date", again["date"])]
                    fields.append(("Content-Type", "application/http; msgtype=response"
                                   if head else header["Content-type"]))
                    record = _warc(fields, block)
                out.append(record)
                size += len(record)
                if size >= SEGMENT:
                    yield _segment(out)
                    out, size = [], 0
            if out:
                yield _segment(out)


def _segment(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(records)], pa.binary())],
                                      ["value"])


def warc_records(data: bytes):
    """(fields, block) of each record; fields None if a record can't be read."""
    at, n = 0, len(data)
    while at < n:
        if data[at] in b"\r\n":
            at += 1
            continue
        cut = data.find(b"\r\n\r\n", at)
        if cut < 0 or not data.startswith(b"WARC/", at):
            yield None, data[at:]
            return
        lines = data[at:cut].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = fields.get("content-length", "")
        if not length.isdigit() or cut + 4 + int(length) > n:
            yield None, data[at:]
            return
        at = cut + 4 + int(length)
        yield fields, data[cut + 4:at]


_RECORD = ("record_type string, record_id string, refers_to_id string, date string, url string, "
           "page_id bigint, payload_bytes bigint, payload_digest string, digests_agree boolean")


def _read_warc(with_payload: bool):
    def run(batches):
        kinds = [pa.string()] * 5 + [pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        names = [f.split()[0] for f in _RECORD.split(", ")]
        if with_payload:
            kinds.append(pa.binary())
            names.append("payload")
        for batch in batches:
            for content in batch.column(0):
                cols = [[] for _ in names]
                for fields, block in warc_records(inflate(content.as_py())):
                    if fields is None:
                        row = ["damaged"] + [None] * 8
                        payload = block
                    else:
                        kind = fields.get("warc-type")
                        if kind in ("warcinfo", "x-damaged"):
                            row, payload = [kind] + [None] * 8, block
                        else:
                            head, payload = http_payload(block)
                            said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                            found = None if kind == "revisit" else sha1_base32(payload)
                            row = [kind, fields.get("warc-record-id", "").strip("<>"),
                                   fields.get("warc-refers-to", "").strip("<>") or None,
                                   fields.get("warc-date"), fields.get("warc-target-uri"),
                                   page_of(head), None if kind == "revisit" else len(payload),
                                   found or said, said == (found or said)]
                    for c, v in zip(cols, row + [payload] * with_payload):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
    return run


def _write_segments(segments: DataFrame, path: str, separator: str) -> None:
    (segments.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", separator).option("compression", "gzip")
     .option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .where("length > 0").select("path", "content"))


def write_arc(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id",
              url_col: str = "url", payload_col: str = "html", date: str = "20200101000000",
              origin: str = "recspark") -> None:
    """One ARC record per row, versions 1 and 2 in turn."""
    rows = narrow(pages, page=id_col, url=url_col, html=payload_col)
    rows = rows.withColumn("page", F.col("page").cast("bigint"))
    _write_segments(map_batches(rows, _write_arc(date, origin), "value binary"), path, "\n")


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str,
                min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Convert every ARC file below ``arc_path``."""
    files = _files(spark, arc_path)
    entries = stored(spark, map_batches(files, _entries, _ENTRY), "arc-entries")
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_page"), "page_id", "path", "offset",
                           "record_id", "url", "date")).alias("first")
    able = entries.where((F.col("size") >= min_revisit_bytes) & F.col("http"))
    firsts = stored(spark, able.groupBy("identity", "size").agg(first), "arc-firsts")
    again = (able.join(firsts, ["identity", "size"])
             .where("first.path <> path or first.offset <> offset")
             .groupBy("path").agg(F.collect_list(F.struct(
                 "offset", F.col("first.record_id").alias("record_id"),
                 F.col("first.url").alias("url"), F.col("first.date").alias("date")))
                 .alias("revisits")))  # bounded: the records of one file
    segments = map_batches(files.join(again, "path", "left"), _convert, "value binary")
    _write_segments(segments, warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per WARC record. Sizes and digests of responses are measured again."""
    files = _files(spark, path).select("content")
    return map_batches(files, _read_warc(with_payload),
                       _RECORD + ", payload binary" * with_payload)


def resolve_revisits(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Responses and revisits, a revisit with the payload size and page it refers to; both are
    null where the response is missing or damaged."""
    known = stored(spark, records.where("record_type in ('response', 'revisit')"), "warc-records")
    responses = known.where("record_type = 'response'")
    targets = responses.select(F.col("record_id").alias("refers_to_id"),
                               F.col("page_id").alias("refers_to"), "payload_bytes")
    cols = ["page_id", "url", "date", "record_id", "payload_bytes", "payload_digest",
            "record_type", "refers_to", "digests_agree"]
    again = (known.where("record_type = 'revisit'").drop("payload_bytes")
             .join(targets, "refers_to_id", "left").select(*cols))
    return responses.withColumn("refers_to", F.lit(None).cast("bigint")).select(*cols).unionByName(
        again)


def archive_round_trip(spark: SparkSession, pages: DataFrame,
                       min_revisit_bytes: int = MIN_REVISIT_BYTES, **columns) -> DataFrame:
    """Pages to ARC, ARC to WARC, WARC back to a row per page."""
    work = scratch_path(spark, "archives")
    write_arc(spark, pages, f"{work}/arc", **columns)
    arc_to_warc(spark, f"{work}/arc", f"{work}/warc", min_revisit_bytes)
    return resolve_revisits(spark, read_warc(spark, f"{work}/warc"))
