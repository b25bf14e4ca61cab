"""WARC archives: records as gzip members, written with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, spread_join, table, written

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
GZIP = b"\x1f\x8b\x08"
#: Bytes that one gzip member may inflate to; of a larger one the records before the bound are kept, the rest is a gap.
MAX_MEMBER = 1 << 30


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def make_record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: named fields, a block (an HTTP answer, whose body a revisit leaves out) and the closing blank lines."""
    body = b"" if kind == "revisit" else payload
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + body
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if page_id is not None:
        fields.append(("Page-Id", str(page_id)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("Refers-To-Page-Id", str(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n"
    return head + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(fields, block, where the record ends) of the record at `at`; ValueError says which check it fails."""
    if not data.startswith(b"WARC/1.", at):
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise ValueError("no end of the header")
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("broken header line")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not size.isdigit():
        raise ValueError("no length")
    start = stop + 4
    end = start + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("length does not meet the closing blank lines")
    block = data[start:end]
    if (d := fields.get("warc-block-digest", "")).startswith("sha256:") and hashlib.sha256(block).hexdigest() != d[7:]:
        raise ValueError("block digest differs")
    return fields, block, end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """(content, where the member ends) of the gzip member at `at`."""
    z = zlib.decompressobj(31)
    out, view, pos, size = [], memoryview(data), at, 0
    while not z.eof:
        part = bytes(view[pos : pos + (1 << 16)])
        if not part:
            raise ValueError("member breaks off")
        try:
            out.append(z.decompress(part))
        except zlib.error as e:
            raise ValueError(f"member is damaged: {e}") from None
        pos += len(part)
        size += len(out[-1])
        if size > MAX_MEMBER:
            raise ValueError("member inflates beyond its bound")
    return b"".join(out), pos - len(z.unused_data)


def inflated(data: bytes, at: int) -> tuple[bytes, list[tuple[int, int]], str]:
    """(content up to the error, marks, error) of a damaged or cut member; a mark is (bytes of it that were read to, content by then)."""
    z, out, size, marks, why = zlib.decompressobj(31), [], 0, [], "member breaks off"
    pos, step = at, 64
    while pos < len(data):
        before = z.copy() if step > 1 else None
        try:
            out.append(z.decompress(data[pos : pos + step]))
        except zlib.error as e:
            why = f"member is damaged: {e}"
            if before is None:
                break
            z, step = before, 1  # once more up to the byte that fails
            continue
        size += len(out[-1])
        pos = min(pos + step, len(data))
        marks.append((pos, size))
        if size > MAX_MEMBER:
            why = "member inflates beyond its bound"
            break
    return b"".join(out), marks, why


def inside(inner: bytes):
    """Yields (fields, block, end, "") of the records of a member's content and ({}, b"", end, reason) of what lies between."""
    p, why = 0, ""
    while p < len(inner):
        try:
            fields, block, end = parse_record(inner, p)
        except ValueError as e:
            why = why or str(e)
            p = inner.find(b"WARC/1.", p + 1)
            if p < 0:
                break
            continue
        if why:
            yield {}, b"", p, why
            why = ""
        yield fields, block, end, ""
        p = end
    if why:
        yield {}, b"", len(inner), why


def salvage(data: bytes):
    """Yields ("record", start, stop, fields, block) and ("gap", start, stop, reason, b"") in file order.

    The file may hold gzip members, bare records, or both. Where a check fails, the search goes on at the next member or
    version line that passes all checks; the bytes before it are one quarantined gap with the first reason. In a member
    of several records the search goes on inside: records and gaps then bear the member's offsets. Of a member that is
    damaged or breaks off the records that still inflate are kept, and the gap begins behind the last of them.
    """
    at, gap, why = 0, None, ""
    while at < len(data):
        error, found = "", []
        if data.startswith(GZIP, at):
            try:
                inner, end = inflate(data, at)
                found = list(inside(inner))
            except ValueError:
                inner, marks, error = inflated(data, at)
                found = list(inside(inner))
                while found and found[-1][3]:  # the gap behind the last record
                    found.pop()
                if found:
                    end = min(next(pos for pos, size in marks if size >= found[-1][2]), len(data) - 1)
            if not any(not f[3] for f in found):
                error, found = error or (found[0][3] if found else ""), []
        else:
            try:
                fields, block, end = parse_record(data, at)
                found = [(fields, block, end, "")]
            except ValueError as e:
                error = str(e)
        if found or not error:
            if gap is not None:
                yield "gap", gap, at, why, b""
                gap = None
            for fields, block, _, reason in found:
                yield ("gap", at, end, reason, b"") if reason else ("record", at, end, fields, block)
            at = end
            if error:
                gap, why = at, error
        elif gap is None:
            gap, why = at, error
        if error:
            nexts = [p for p in (data.find(GZIP, at + (not found)), data.find(b"WARC/1.", at + (not found))) if p >= 0]
            at = min(nexts, default=len(data))
    if gap is not None:
        yield "gap", gap, len(data), why, b""


def write_archives(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> (archive, body): WARC files of about ARCHIVE_BYTES, each row one whole file.

    Payloads are the html in UTF-8, null as empty. Among equal payloads of at least MIN_REVISIT_BYTES the least page_id is
    a response and the others revisit it; smaller ones are all responses. Rows that repeat a page_id and payload are all
    that response; a row with a null page_id is a response only if no equal payload has an id. A null url is empty.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    keyed = src.withColumn("digest", F.sha2("payload", 256))
    long = keyed.filter(F.length("payload") >= MIN_REVISIT_BYTES)
    shared = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first")
    shared = bounded(written(shared, "shared-payloads"), 96)
    rows = keyed.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", "first")

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        held, size, n = [], 0, 0
        name = lambda: f"part-{task.partitionId():06d}-{n:06d}.warc.gz"
        out = lambda: pa.RecordBatch.from_arrays([pa.array([name()]), pa.array([b"".join(held)], pa.binary())], ["archive", "body"])
        for b in batches:
            for page_id, url, payload, digest, first in zip(*(b.column(i) for i in range(5))):
                page_id, first = page_id.as_py(), first.as_py()
                again = first is not None and page_id != first
                held.append(gzip_member(make_record("revisit" if again else "response", page_id, url.as_py(), payload.as_py(), digest.as_py(), first if again else None)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield out()
                    held, size, n = [], 0, n + 1
        if held:
            yield out()

    return rows.mapInArrow(run, "archive string, body binary")


RECORD = "archive string, start long, stop long, gap string, record_type string, page_id long, url string, refers_to long, payload_digest string, payload binary"


def read_archives(archives: DataFrame, name: str = "archive", body: str = "body") -> DataFrame:
    """(archive, body) files, as written here or read by the binaryFile source, to one row per record or gap.

    start and stop are byte offsets in the file; gap is null for records and the failed check for quarantined bytes.
    A response's payload is checked against its digest; a revisit has no payload of its own. Null or empty files give no rows.
    """

    def run(batches):
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        number = lambda x: int(x) if x and re.fullmatch(r"-?\d+", x) else None
        for b in batches:
            for archive, data in zip(b.column(0), b.column(1)):
                rows, size = [], 0
                for kind, start, stop, about, block in salvage(data.as_py() or b""):
                    if kind == "gap":
                        rows.append((archive.as_py(), start, stop, about, *[None] * 6))
                        continue
                    head, blank, payload = block.partition(b"\r\n\r\n")
                    digest = about.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    revisit = about.get("warc-type") == "revisit"
                    wrong = not revisit and digest and hashlib.sha256(payload).hexdigest() != digest
                    rows.append((archive.as_py(), start, stop, "payload digest differs" if wrong else None, about.get("warc-type"), number(about.get("page-id")), about.get("warc-target-uri"), number(about.get("refers-to-page-id")), digest, None if revisit else payload))
                    size += len(payload)
                    if size > 8 << 20:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    return archives.select(F.col(name).cast("string").alias("archive"), F.col(body).alias("body")).mapInArrow(run, RECORD)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """The contract query: pages written as archives, and what the reader finds in them. A gap in these fresh archives is an error."""
    archives = written(write_archives(table(spark, sf_dir, "pages")), "warc", compression="none")
    found = read_archives(archives).select(
        "archive", "start", "stop", "gap", "page_id", F.length("payload").cast("long").alias("own_bytes"), "payload_digest", F.sha2("payload", 256).alias("read_digest"), "record_type", "refers_to"
    )
    found = written(found, "records")
    gap = found.filter("gap is not null").select("archive", "start", "stop", "gap").first()
    if gap:
        raise ValueError(f"quarantined bytes in a new archive: {gap}")
    first = found.filter("record_type = 'response'").groupBy(F.col("read_digest").alias("payload_digest")).agg(F.max("own_bytes").alias("payload_bytes"))
    here = found.filter("refers_to is null").select("page_id", F.col("own_bytes").alias("payload_bytes"), F.col("read_digest").alias("payload_digest"), "record_type", "refers_to")
    again = spread_join(found.filter("refers_to is not null").select("page_id", "payload_digest", "record_type", "refers_to"), first, "payload_digest", ["page_id"], "left")
    return here.unionByName(again)


ORACLE = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to FROM f
"""
