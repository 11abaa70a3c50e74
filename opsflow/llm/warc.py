"""WARC archives: a writer with revisit records, and a salvage reader.

``write_archives`` makes one record per row.  Of rows with equal payloads of at
least ``least`` bytes, those with the largest id are ``response`` records and
the others ``revisit`` records that refer to it; only digests and ids are
grouped.  Records are gzip members; an archive is a row (``archive``,
``content``) of about ``ARCHIVE_BYTES``, the same shape as the ``binaryFile``
source gives for files.

``read_archives`` takes such rows (members or plain records).  A record is
taken if its member inflates with a right checksum, its version line, headers
and length parse, and its block digest agrees (MD5 or SHA, hex or base 32; one
with another label is not checked).  After a failed check the reader looks for
the next member or version line that passes them all, goes on there, and logs
the bytes between as a quarantined gap.  A member may hold many records, which
are salvaged alike inside it; of a member that is cut or fails its checksum the
records with an agreeing block digest are recovered.  Header lines may be folded.
Each search for a mark is kept until it is passed, so false marks cost no second
reading.

Defined results: a null or empty payload is an empty payload; a null url gives
no target; control characters, blanks and non-ASCII in a url are
percent-encoded in the header; a null id stays null; rows that repeat one id
and payload are all responses; an empty table gives an empty archive table; an
archive with null or empty content has no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import need

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 8 << 20
GZIP_LEVEL = 6
MEMBER = b"\x1f\x8b\x08"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
#: Digest labels that are checked; a record with any other label is taken by its other checks.
ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
#: What a record's date says where the row has none: archives of equal rows are equal.
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = ("archive string, start bigint, end bigint, kind string, inner_start bigint, inner_end bigint, id string, record_type string, url string, "
                 "refers_to string, payload binary, payload_bytes bigint, payload_digest string, reason string")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _bare(digest: str | None) -> str | None:
    """Lower-case hex of a labelled hex or base-32 digest; null for labels that are not known and values of another form."""
    label, _, value = (digest or "").partition(":")
    label = label.strip().lower().replace("-", "")
    if label not in ALGORITHMS:
        return None
    size, value = hashlib.new(label).digest_size, value.strip().rstrip("=")
    if len(value) == 2 * size:
        return value.lower()
    try:
        return base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()
    except ValueError:
        return None


def agrees(digest: str | None, block: bytes) -> bool | None:
    """Whether a block has a labelled digest; None if there is none or its label is not known."""
    label = (digest or "").partition(":")[0].strip().lower().replace("-", "")
    return _bare(digest) == hashlib.new(label, block).hexdigest() if label in ALGORITHMS else None


def _uri(url: str) -> str:
    return "".join(c if 0x20 < ord(c) < 0x7F else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(key: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One uncompressed record; a revisit has the HTTP header only as its block."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if key is None else key}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {_sha1(payload)}",
             f"WARC-Block-Digest: {_sha1(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least: int = LEAST_REVISIT) -> DataFrame:
    """``id``, ``url``, ``payload`` and, for revisits, ``refers_to``."""
    need(pages, id_col, url_col, payload_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    known = rows.filter(F.octet_length("payload") >= least).select("id", F.sha1("payload").alias("sha"))
    # payloads of more than one id: only these digests meet the payloads again
    shared = known.groupBy("sha").agg(F.max("id").alias("keeper"), F.min("id").alias("first"), F.count("id").alias("n"),
                                      F.count(F.lit(1)).alias("every"))
    shared = shared.filter("keeper <> first or n < every").select("sha", "keeper")
    sha = F.when(F.octet_length("payload") >= least, F.sha1("payload"))
    return (rows.withColumn("sha", sha).join(shared, "sha", "left")
            .select("id", "url", "payload", F.when(~F.col("keeper").eqNullSafe(F.col("id")), F.col("keeper")).alias("refers_to")))


def write_archives(rows: DataFrame, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES,
                   level: int = GZIP_LEVEL) -> DataFrame:
    """``archive`` (name) and ``content`` of archives with a record for each row of ``with_revisits``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            name = f"part-{part:05d}-{k:05d}.warc" + ".gz" * compress
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)], pa.binary())],
                                              names=["archive", "content"])

        for batch in batches:
            for key, url, payload, refers_to in zip(*[batch.column(c) for c in ("id", "url", "payload", "refers_to")],
                                                    strict=True):
                record = record_bytes(key.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                if compress:
                    packer = zlib.compressobj(level, wbits=31)
                    record = packer.compress(record) + packer.flush()
                held.append(record)
                size += len(record)
                if size >= archive_bytes:
                    yield archive()
                    k, held, size = k + 1, [], 0
        if held:
            yield archive()

    text = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))
    return text.mapInArrow(write, "archive string, content binary")


class Marks:
    """Next places of byte marks; each search is kept until it is passed, so all of them read the data once."""

    def __init__(self, data: bytes):
        self.data, self.places = data, {}

    def next(self, mark: bytes, at: int) -> int:
        """First place of the mark from ``at`` on (which never falls), the data's length if there is none."""
        place = self.places.get(mark, -1)
        if place < at:
            place = self.data.find(mark, at)
            place = self.places[mark] = len(self.data) if place < 0 else place
        return place


def parse_headers(data: bytes, at: int, stop: int) -> dict:
    """Named fields between two places; a line that starts with a blank goes on with the field before it."""
    headers, name = {}, None
    while at < stop:
        end = data.find(b"\r\n", at, stop)
        end = stop if end < 0 else end
        line, at = data[at:end], end + 2
        if line[:1] in (b" ", b"\t") and name is not None:
            headers[name] = f"{headers[name]} {line.strip().decode('utf-8', 'replace')}".strip()
            continue
        field, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        name = field.strip().lower().decode("latin-1")
        headers[name] = value.strip().decode("utf-8", "replace")
    return headers


def parse_record(data: bytes, at: int = 0, marks: Marks | None = None) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at a place; raises ValueError with the failed check."""
    version = VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    stop = (marks or Marks(data)).next(b"\r\n\r\n", at)
    if stop == len(data):
        raise ValueError("headers do not end")
    headers = parse_headers(data, version.end(), stop)
    if "warc-type" not in headers or not re.fullmatch("[0-9]{1,18}", headers.get("content-length", "")):
        raise ValueError("no type or length")
    end = stop + 4 + int(headers["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("block has another length")
    block = data[stop + 4:end]
    if agrees(headers.get("warc-block-digest"), block) is False:
        raise ValueError("block digest differs")
    return headers, block, end + 4


def inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """(content, end, failed check or None) of the gzip member at a place; of a bad or cut member what came before."""
    member = zlib.decompressobj(wbits=31)
    out, place, step, failed = [], at, 1 << 16, None
    while not member.eof:
        if place >= len(data):
            failed = "member is cut"
            break
        before = member.copy()
        try:
            out.append(member.decompress(data[place:place + step]))
            place += step
        except zlib.error as e:  # smaller steps bring out what stands before the bad byte
            failed, member = f"member: {e}", before
            if step == 1:
                break
            failed, step = None, step >> 4
    return b"".join(out), min(place, len(data)) - len(member.unused_data), failed


def salvage(data: bytes, members: bool = True) -> Iterator[tuple]:
    """("record", start, end, inner, headers, block) of each good record and ("gap", start, end, inner, reason) of the
    rest, in order.  ``inner`` is the place inside the inflated member for members that hold not just one record, else
    None.  Of a member that fails, those records are taken whose block digest agrees; the member itself is in a gap."""
    at, gap, reason, view, marks = 0, None, "", memoryview(data), Marks(data)
    while at < len(data):
        found, failed = [], None
        if members and data[at:at + 3] == MEMBER:
            content, end, failed = inflate(view, at)
            found = [(kind, at, end, (a, b), *rest) for kind, a, b, _, *rest in salvage(content, members=False)]
            if failed is not None:
                found = [f for f in found if f[0] == "record" and agrees(f[4].get("warc-block-digest"), f[5])]
            elif not any(f[0] == "record" for f in found):
                found, failed = [], found[0][4] if found else "empty member"
            elif len(found) == 1:
                found = [(*found[0][:3], None, *found[0][4:])]
        else:
            try:
                headers, block, end = parse_record(data, at, marks)
                found = [("record", at, end, None, headers, block)]
            except ValueError as e:
                failed = str(e)
        if failed is None and gap is not None:
            yield "gap", gap, at, None, reason
            gap = None
        yield from found
        if failed is None:
            at = end
            continue
        if gap is None:
            gap, reason = at, failed
        at = min(marks.next(mark, at + 1) for mark in VERSIONS + (MEMBER,) * members)
    if gap is not None:
        yield "gap", gap, len(data), None, reason


def _id(header: str | None) -> str | None:
    """Id in <urn:page:id>; null for an empty one."""
    found = re.fullmatch(r"<urn:page:(.*)>", header or "", re.S)
    return (found[1] if found else header) or None


def read_archives(archives: DataFrame, name_col: str = "archive", content_col: str = "content") -> DataFrame:
    """Records (``kind`` record) and quarantined gaps (``kind`` gap, with ``reason``) of every archive, with byte places
    (``inner_start`` and ``inner_end``: inside the inflated member, if it holds not just one record).

    ``payload`` is the block after its HTTP header (null for revisits); ``payload_bytes`` and ``payload_digest`` are
    those of the full payload, for revisits as the HTTP header and the record say."""
    need(archives, name_col, content_col)
    src = archives.select(F.col(name_col).cast("string").alias("archive"), F.col(content_col).cast("binary").alias("content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                           ("inner_start", pa.int64()), ("inner_end", pa.int64()), ("id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
                           ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("reason", pa.string())])
        out: list[dict] = []
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content"), strict=True):
                size = 0
                for kind, start, end, inner, *rest in salvage(content.as_py() or b""):
                    row = {"archive": name.as_py(), "start": start, "end": end, "kind": kind}
                    if inner is not None:
                        row["inner_start"], row["inner_end"] = inner
                    if kind == "gap":
                        row["reason"] = rest[0]
                    else:
                        row |= _fields(*rest)
                    out.append(row)
                    size += len(row.get("payload") or b"")
                    if size > 8 << 20 or len(out) >= 5000:
                        yield pa.RecordBatch.from_pylist(out, schema=types)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=types)
                    out = []

    return src.mapInArrow(read, RECORD_SCHEMA)


def _fields(headers: dict, block: bytes) -> dict:
    http, _, body = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
    revisit = headers["warc-type"] == "revisit"
    said = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)
    return {"id": _id(headers.get("warc-record-id")), "record_type": headers["warc-type"], "url": headers.get("warc-target-uri"),
            "refers_to": _id(headers.get("warc-refers-to")) if revisit else None, "payload": None if revisit else body,
            "payload_bytes": int(said[1]) if revisit and said else len(body),
            "payload_digest": _bare(headers.get("warc-payload-digest")) if revisit else hashlib.sha1(body).hexdigest()}
