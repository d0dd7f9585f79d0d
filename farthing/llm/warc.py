"""WARC archives: writing with revisits, and a reader that salvages damaged files.

The writer makes one gzip member per record, so every record can be found on its
own. The reader goes from record to record and checks each: gzip checksum, headers,
lengths, payload digest (SHA-1 or SHA-256, in hex or base32, over the body of an HTTP response;
other digests are passed on unchecked). A member may hold several records, which all have
its byte range. After a failed check it looks for the next gzip member
or, in plain files, the next version line that starts a valid record, goes on there, and logs the
bytes between as a quarantined gap.

Files are read in a stream: the reader holds one record or gzip member and one read step.

Defined results: a null payload is empty; of equal payloads of ``REVISIT_BYTES`` or more the
smallest id is the response, rows repeating that id are all responses, and a row without id
revisits it (a group with no id at all has only responses); no rows give no files; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farthing.llm.common import fan_out, in_batches, new_folder, stored
from farthing.llm.files import Writer, opened

REVISIT_BYTES = 100
FILE_BYTES = 32 << 20
LEVEL = 3
READ_STEP = 1 << 20
FIRST_STEP = 1 << 13
VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"
RECORD = "file string, start bigint, stop bigint, record_type string, page_id bigint, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary"
GAP = "file string, gap_start bigint, gap_stop bigint, reason string"


# --- writing -----------------------------------------------------------------


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit names its response and carries no payload."""
    body = b"" if revisit else payload
    heads = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Target-URI": "".join(c for c in url or "" if c not in "\r\n"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        heads |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    heads["Content-Length"] = str(len(body))
    lines = "".join(f"{k}: {v}\r\n" for k, v in heads.items())
    return VERSION + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def write(pages: DataFrame) -> DataFrame:
    """Archives of all pages in the shared folder: (name, n_records, n_bytes) of each."""
    spark = pages.sparkSession
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= REVISIT_BYTES
    firsts = rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    # A written table: its size is known, so it is broadcast if small, else a skewed digest is split.
    known = stored(firsts.select("digest", "first"), "firsts")
    linked = rows.join(known, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(long, F.col("first")).alias("first")
    )
    folder = new_folder(spark, "warc")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        part = TaskContext.get().partitionId()

        def done():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([n]), pa.array([out.bytes])], ["name", "n_records", "n_bytes"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, first = (c[i].as_py() for c in batch.columns)
                if out is None:
                    out, n = Writer(folder, f"part-{part:05d}.warc.gz"), 0
                revisit = first is not None and first != page
                press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(press.compress(record_bytes(page, url, payload, digest, first, revisit)) + press.flush())
                n += 1
                if out.bytes >= FILE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return stored(in_batches(linked, work, "name string, n_records bigint, n_bytes bigint"), "archives")


# --- reading -----------------------------------------------------------------


class Damaged(Exception):
    """A record that fails a check."""


class Source:
    """Bytes of known size, read at any place; the last two blocks are held and nothing else."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        """``read(offset, n)`` gives the ``n`` bytes there."""
        self.read, self.size = read, size
        self.blocks: dict[int, bytes] = {}

    @classmethod
    def of(cls, data: bytes) -> Source:
        return cls(lambda at, n: data[at : at + n], len(data))

    def _block(self, k: int) -> bytes:
        if k not in self.blocks:
            if len(self.blocks) > 1:
                del self.blocks[min(self.blocks)]
            self.blocks[k] = self.read(k * READ_STEP, min(READ_STEP, self.size - k * READ_STEP))
        return self.blocks[k]

    def view(self, start: int, stop: int) -> bytes:
        """The bytes from ``start`` up to ``stop`` or the end."""
        stop = min(stop, self.size)
        if start >= stop:
            return b""
        first, last = start // READ_STEP, (stop - 1) // READ_STEP
        if last > first + 1:
            return self.read(start, stop - start)
        return b"".join(self._block(k)[max(0, start - k * READ_STEP) : stop - k * READ_STEP] for k in range(first, last + 1))


def _steps(source: Source, at: int, overlap: int = 0) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) from ``at`` on, in pieces that grow from few bytes to ``READ_STEP``."""
    size = FIRST_STEP
    while view := source.view(at, at + size):
        yield at, view
        if at + len(view) >= source.size:
            return
        at += len(view) - overlap
        size = min(2 * size, READ_STEP)


def _member(source: Source, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at``, and its end."""
    press, out = zlib.decompressobj(31), []
    for at, step in _steps(source, at):
        try:
            out.append(press.decompress(step))
        except zlib.error as e:
            raise Damaged(f"gzip: {e}") from None
        if press.eof:
            return b"".join(out), at + len(step) - len(press.unused_data)
    raise Damaged("truncated member")


def _heads(data: bytes, at: int = 0) -> tuple[dict[str, str], int]:
    """The header fields at ``at`` in ``data``, and where the block begins."""
    end = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/1.", at) or end < 0:
        raise Damaged("no record header")
    try:
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
    except UnicodeDecodeError:
        raise Damaged("header is not UTF-8") from None
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no content length")
    return fields, end + 4


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _known_digest(field: str) -> tuple[str, bytes] | None:
    """Algorithm and value of a digest whose algorithm and encoding are known; without a name it is SHA-256."""
    name, colon, value = field.rpartition(":")
    name = name.strip().lower().replace("-", "") if colon else "sha256"
    if name not in ("sha1", "sha256"):
        return None
    size, value = hashlib.new(name).digest_size, value.strip().rstrip("=")
    try:
        if len(value) == 2 * size:
            return name, bytes.fromhex(value)
        if len(value) == -(-size * 8 // 5):
            return name, base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        raise Damaged("payload digest is not readable") from None
    return None


def _unchunked(body: bytes) -> bytes | None:
    """An HTTP body without its transfer coding; None if it is not so coded."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        if size <= 0:
            return b"".join(out) if size == 0 else None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return None


def _payloads(fields: dict[str, str], body: bytes) -> Iterator[bytes]:
    """What a payload digest may be over: the block, or of an HTTP response its body, as sent or with its chunks joined."""
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, body = body.partition(b"\r\n\r\n")
        yield body
        if b"chunked" in head.lower() and (joined := _unchunked(body)) is not None:
            yield joined
    else:
        yield body


def _checked(fields: dict[str, str], body: bytes, start: int, stop: int) -> dict:
    """The record, if its payload is what the header says."""
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        known = _known_digest(digest) if digest else None
        if known and all(hashlib.new(known[0], p).digest() != known[1] for p in _payloads(fields, body)):
            raise Damaged("payload digest differs")
        digest = digest or hashlib.sha256(next(_payloads(fields, body))).hexdigest()
    length = fields.get("x-payload-length", str(len(body)))
    return {
        "start": start, "stop": stop, "record_type": kind, "page_id": _page(fields.get("warc-record-id")), "refers_to": _page(fields.get("warc-refers-to")),
        "url": fields.get("warc-target-uri"), "payload_bytes": int(length) if length.isdigit() else len(body), "payload_digest": digest, "payload": body,
    }


def _in_member(data: bytes, start: int, stop: int) -> tuple[list[dict], str]:
    """The valid records of a member's content, and the first check that failed between them, if any."""
    found, at, why = [], 0, ""
    while at < len(data):
        try:
            fields, head = _heads(data, at)
            end = head + int(fields["content-length"])
            if data[end : end + 4] != b"\r\n\r\n":
                raise Damaged("record length differs")
            found.append(_checked(fields, data[head:end], start, stop))
            at = end + 4
        except Damaged as e:
            why = why or str(e)
            at = data.find(b"WARC/1.", at + 1)
            if at < 0:
                break
    return found, why


def _records(source: Source, at: int) -> tuple[list[dict], int, str]:
    """The records at ``at``, zipped or plain, their end, and why others of a member are lost; raises ``Damaged``."""
    if source.view(at, at + 3) == _GZIP:
        data, stop = _member(source, at)
        found, why = _in_member(data, at, stop)
        if not found:
            raise Damaged(why or "empty member")
        return found, stop, why
    head_bytes, want = source.view(at, at + 8192), 8192
    while b"\r\n\r\n" not in head_bytes and len(head_bytes) == want and head_bytes.startswith(b"WARC/1.") and want < 1 << 20:
        want *= 2
        head_bytes = source.view(at, at + want)
    fields, head = _heads(head_bytes)
    size = int(fields["content-length"])
    stop = at + head + size + 4
    if stop > source.size or source.view(stop - 4, stop) != b"\r\n\r\n":  # before the block is read
        raise Damaged("record length differs")
    return [_checked(fields, source.view(at + head, stop - 4), at, stop)], stop, ""


def _next_start(source: Source, at: int) -> int | None:
    """The next place at or after ``at`` that looks like a member or a version line."""
    for at, view in _steps(source, at, overlap=8):  # a mark may lie across two steps
        found = [p for p in (view.find(_GZIP), view.find(b"WARC/1.")) if p >= 0]
        if found:
            return at + min(found)
    return None


def salvage(parts: Source | Iterable[bytes]) -> Iterator[tuple[str, dict]]:
    """("record", fields) and ("gap", fields) of one archive, in order.

    Every byte belongs to one of them, but for a member of which some records are lost: it is
    that of the others, and a gap. A start inside a damaged stretch counts only if the
    whole record there passes its checks. A length is checked against the bytes at its end before
    the block is read, so a false one costs nothing; held are one record and two blocks of ``READ_STEP``.
    """
    source = parts if isinstance(parts, Source) else Source.of(b"".join(parts))
    at, bad, why = 0, None, ""
    while source.view(at, at + 1):
        try:
            records, stop, lost = _records(source, at)
        except Damaged as e:
            if bad is None:
                bad, why = at, str(e)
            nxt = _next_start(source, at + 1)
            if nxt is None:
                at = source.size
                break
            at = nxt
            continue
        if bad is not None:
            yield "gap", {"gap_start": bad, "gap_stop": at, "reason": why}
            bad = None
        for record in records:
            yield "record", record
        if lost:
            yield "gap", {"gap_start": at, "gap_stop": stop, "reason": lost}
        at = stop
    if bad is not None:
        yield "gap", {"gap_start": bad, "gap_stop": at, "reason": why}


def _read(archives: DataFrame, wanted: str, schema: str, payload: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (f.split() for f in schema.split(", "))])
        for batch in batches:
            for name in batch.column("name").to_pylist():
                held, size = [], 0
                for kind, fields in salvage(Source(*opened(name))):
                    if kind == wanted:
                        if not payload:
                            fields.pop("payload", None)
                        held.append({"file": name} | fields)
                        size += len(fields.get("payload") or b"") + 200
                        if size > READ_STEP:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    return in_batches(fan_out(archives.select("name"), archives.count()), work, schema)


def read_records(archives: DataFrame, payload: bool = True) -> DataFrame:
    """All valid records of the archives (``name`` is their place)."""
    return _read(archives, "record", RECORD if payload else RECORD.removesuffix(", payload binary"), payload)


def read_gaps(archives: DataFrame) -> DataFrame:
    """The quarantined byte ranges, with the check that failed first."""
    return _read(archives, "gap", GAP, payload=False)
