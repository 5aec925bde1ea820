"""WARC archives: a writer with one gzip member per record, and a reader that salvages damaged files.

Spark's text writer puts the members into files: every member ends in a zero byte (the high byte of its
length, which is below 16 MB; a longer record is followed by an empty member), and that byte is the line
separator of the writer. The reader checks every member (gzip checksum and length), every record (version
line, header, lengths) and every digest; after a failure it searches for the next place where all checks
pass, goes on from there, and reports the bytes between as a gap.
"""

import base64
import hashlib
import re
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow

MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/1."
LARGE = 1 << 24
CHUNK = 1 << 14
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FOUND = [("file", "string"), ("start", "bigint"), ("end", "bigint"), ("kind", "string"), ("reason", "string"),
         ("record_type", "string"), ("record_id", "string"), ("url", "string"), ("page_id", "bigint"),
         ("refers_to", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("payload", "binary")]


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, url):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def header_text(value):
    """A header value on one line; what can't stand in one is percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url, payload, digest, first_id, is_revisit):
    """The bytes of one WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_id(page_id, url)),
              ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
              ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", header_text(url)))
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if is_revisit:
        fields += [("WARC-Profile", PROFILE), ("Refers-To-Page-Id", str(first_id))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(content, level=6):
    """One gzip member (two for a large record) whose last byte is zero."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(content) + packer.flush()
    return packed + member(b"") if len(content) >= LARGE else packed


def members_of(batches, schema):
    for batch in batches:
        rows = zip(*[batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "first_id", "is_revisit")])
        lines = []
        for (page_id, url, digest, first_id, is_revisit), payload in zip(rows, batch.column("payload")):
            digest = base64.b32encode(digest).decode()
            lines.append(member(record(page_id, url, payload.as_py(), digest, first_id, is_revisit))[:-1])
        yield batch_of(schema, {"value": lines}, len(lines))


def write_archives(pages: DataFrame, path, least_revisit=0):
    """One record per row of ``pages`` (page_id, url, html) into gzip files under ``path``.

    Of rows with equal payloads of at least ``least_revisit`` bytes those of the smallest page_id are
    responses, the others revisits of it. Null html is an empty payload; a null url gives no target; rows of
    no page_id come last. The rows of an empty table give no records.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.unhex(F.sha1(payload)).alias("digest"))
    # one row per payload; the partial aggregate leaves one row per task of a hot payload
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    shared = firsts.where("copies > 1").select("digest", "first_id")
    marked = rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", "first_id",
        (F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
         & (F.octet_length("payload") >= least_revisit)).alias("is_revisit"))
    lines = in_arrow(marked, members_of, [("value", "binary")])
    (lines.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", "\0").option("compression", "none").text(path))


def unpack_member(data, at):
    """(content, end) of the gzip member at ``at``; raises where any check fails."""
    opened, parts = zlib.decompressobj(31), []
    while not opened.eof:
        if at >= len(data):
            raise ValueError("member is cut off")
        piece = data[at:at + CHUNK]
        parts.append(opened.decompress(piece))
        at += len(piece)
    return b"".join(parts), at - len(opened.unused_data)


def parse(content, at=0):
    """(fields, end) of the record at ``at``; raises where any check fails."""
    head_end = content.find(b"\r\n\r\n", at)
    if head_end < 0 or not content.startswith(VERSION, at):
        raise ValueError("no version line and header")
    head = content[at:head_end].decode().split("\r\n")[1:]
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in head)}
    length = int(fields["content-length"])
    block, end = content[head_end + 4:head_end + 4 + length], head_end + 4 + length
    if len(block) < length or content[end:end + 4] != b"\r\n\r\n":
        raise ValueError("block is cut off")
    if (said := fields.get("warc-block-digest")) and said != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest differs")
    http, split, payload = block.partition(b"\r\n\r\n")
    if not split:
        http, payload = b"", block
    told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and digest != base32_sha1(payload):
        raise ValueError("payload digest differs")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"kind": "record", "record_type": kind, "record_id": fields.get("warc-record-id"),
            "url": fields.get("warc-target-uri"), "page_id": number("page-id"), "refers_to": number("refers-to-page-id"),
            "payload_bytes": int(told[1]) if told else len(payload), "payload_digest": digest or None,
            "payload": None if kind == "revisit" else payload}, end + 4


def next_record(data, at):
    """([fields], end) of the gzip member or plain record at ``at``."""
    if data.startswith(MEMBER, at):
        content, end = unpack_member(data, at)
        rows, inner = [], 0
        while inner < len(content):
            fields, inner = parse(content, inner)
            rows.append(fields)
        return rows, end
    fields, end = parse(data, at)
    return [fields], end


def salvage(data):
    """(start, end, fields) of every record, and of every gap with its reason, in order."""
    marks = re.compile(re.escape(MEMBER) + b"|" + re.escape(VERSION))
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            rows, end = next_record(data, at)
        except (ValueError, KeyError, zlib.error) as error:
            if gap is None:
                gap, reason = at, str(error)[:200]
            found = marks.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield gap, at, {"kind": "gap", "reason": reason}
            gap = None
        for fields in rows:
            yield at, end, fields
        at = end
    if gap is not None:
        yield gap, len(data), {"kind": "gap", "reason": reason}


def found_in(batches, schema, with_payload):
    def found(rows):
        return batch_of(schema, {name: [r.get(name) for r in rows] for name in schema.names}, len(rows))

    for batch in batches:
        for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, held = [], 0
            for start, end, fields in salvage(data.as_py()):
                held += len(fields.get("payload") or b"")
                if not with_payload:
                    fields["payload"] = None
                rows.append(fields | {"file": name, "start": start, "end": end})
                if held > 16 << 20:
                    yield found(rows)
                    rows, held = [], 0
            if rows:
                yield found(rows)


def read_archives(spark, path, with_payload=True) -> DataFrame:
    """Records and gaps (``kind``) of the archives under ``path``, gzip members and plain records alike.

    An archive is read whole by one task; the writer bounds it by the size of a scan split.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return in_arrow(files, found_in, FOUND, with_payload)
