"""WARC archives: one gzip member per record, written and read in parallel.

Writing. A page is a ``response`` record: an HTTP head and the html as payload.
Of the records with equal payloads (SHA-1 and length) of at least ``min_bytes``,
the one with the largest page id is the response and the others are ``revisit``
records, which carry the head only and refer to it. Payloads' digests are
reduced by key before anything is shuffled. The payloads that hold a
``HOT_SHARE``-th of all rows or more (there can be no more than ``HOT_SHARE`` of
those) are joined by broadcast, the others by their digest. Each task appends
its records to files of its own, a new one past ``FILE_BYTES``; every record is
compressed as an independent gzip member. The manifest, a Parquet table, names
stretches of about ``SEGMENT_BYTES`` of the files that successful attempts wrote,
so files of lost attempts are never read.

Reading (:class:`RecordReader`). A stretch of a file is read front to back in
small blocks. An incremental zlib decompressor takes one member after the other;
the head of a record ends at the first empty line, and its Content-Length frames
the block, which is hashed as it comes, so no payload needs to be held unless it
is asked for. Block and payload digests are compared with the record's; framing
errors, wrong digests and cut-off members raise ``ValueError`` with the record's place,
or end up in the column ``error`` with ``strict=False`` (a member that cannot be
decompressed ends its stretch).

Records' ids are ``urn:page:<page_id>:<digest>``, so a revisit names its response
without a look at it, and the payload's length is the one in the HTTP head.

Edge cases: a null html is an empty payload; a null page id counts as smaller than
all others and is written as an empty id; rows repeated under the largest id of
their payload are all responses; a null url has no target line; control characters
and blanks of a url are percent-encoded, since lines end a header field; other columns are ignored,
whatever their names; an empty table gives an empty manifest and no records. A
payload is held once as text and twice as bytes while it is written.
"""

from __future__ import annotations

import base64
import datetime
import re
import uuid
import zlib
from hashlib import sha1

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.llm.common import Shelf
from indicast.llm.token_files import open_folder

MIN_BYTES = 0
HOT_SHARE = 1000
FILE_BYTES = 256 << 20
SEGMENT_BYTES = 4 << 20
READ_BYTES = 1 << 16
HEAD_LIMIT = 1 << 20
LEVEL = 6
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http;msgtype=response"
_END = b"\r\n\r\n"
_UNSAFE = re.compile("[\x00-\x20\x7f]")
_ID = re.compile(r"<urn:page:(-?[0-9]*):([A-Z2-7]{32})>")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def page_of(uri: str) -> int | None:
    found = _ID.fullmatch(uri)
    if not found:
        raise ValueError(f"not the id of a page record: {uri}")
    return int(found[1]) if found[1] else None


def http_head(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def record(page_id, url, payload: bytes, digest: bytes, refers_to=None, revisit: bool = False, date: str = "") -> bytes:
    """One record as a gzip member; a revisit has ``payload`` described but not included."""
    name, head = base32_sha1(digest), http_head(len(payload))
    block = sha1(head)
    if not revisit:
        block.update(payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, name)),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, name))]
    fields += [("WARC-Payload-Digest", f"sha1:{name}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block.digest())}"),
               ("Content-Type", RESPONSE_TYPE), ("Content-Length", str(len(head) + (0 if revisit else len(payload))))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    parts = [press.compress(VERSION + b"\r\n" + lines + b"\r\n" + head)]
    if not revisit:
        parts.append(press.compress(payload))
    parts += [press.compress(b"\r\n\r\n"), press.flush()]
    return b"".join(parts)


class Member:
    """The content of one gzip member, decompressed as far as it is asked for."""

    def __init__(self, take):
        self.take, self.inflate, self.ready = take, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Decompress another stretch; False at the member's end."""
        while not self.inflate.eof:
            raw = self.inflate.unconsumed_tail or self.take()
            try:
                got = self.inflate.decompress(raw, READ_BYTES)
            except zlib.error as wrong:
                raise ValueError(f"not a gzip member: {wrong}") from None
            if got:
                self.ready += got
                return True
            if not raw and not self.inflate.eof:
                raise ValueError("the file ends within a record")
        return False

    def until(self, mark: bytes) -> bytes:
        """Everything up to and with ``mark``."""
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if seen > HEAD_LIMIT or not self.more():
                raise ValueError("a head without an end")
        found, self.ready = self.ready[:at + len(mark)], self.ready[at + len(mark):]
        return found

    def exactly(self, n: int):
        """The next ``n`` bytes, in parts."""
        while n:
            if not self.ready and not self.more():
                raise ValueError("the record is shorter than its Content-Length")
            part, self.ready = self.ready[:n], self.ready[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        """What is left of the member; raises if its checksum is wrong."""
        while self.more():
            if len(self.ready) > len(_END):
                raise ValueError("the record is longer than its Content-Length")
        return self.ready


class RecordReader:
    """Iterates over the records in a stretch of a file."""

    def __init__(self, source, length: int | None = None, with_payload: bool = False, strict: bool = True):
        self.source, self.left = source, length
        self.with_payload, self.strict = with_payload, strict
        self.spare = b""

    def _take(self) -> bytes:
        if self.spare:
            raw, self.spare = self.spare, b""
            return raw
        raw = self.source.read(READ_BYTES if self.left is None else min(READ_BYTES, self.left))
        if self.left is not None:
            self.left -= len(raw)
        return raw

    def __iter__(self):
        place = 0
        while True:
            first = self._take()
            if not first:
                return
            self.spare = first
            member, found = Member(self._take), {"error": None}
            try:
                self._parse(member, found)
            except ValueError as wrong:
                if self.strict:
                    raise ValueError(f"record {place} of the stretch: {wrong}") from None
                found["error"] = str(wrong)
                try:
                    while member.more():
                        member.ready = b""
                except ValueError:
                    yield found
                    return
            yield found
            # Bytes past the member's end are the next one's.
            self.spare = member.inflate.unused_data
            place += 1

    def _parse(self, member: Member, found: dict) -> None:
        lines = member.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record without a version line")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
        found.update(fields=fields, record_type=fields.get("warc-type"), url=fields.get("warc-target-uri"))
        if not fields.get("content-length", "").isdigit():
            raise ValueError("a record without Content-Length")
        size, block, payload, n_bytes = int(fields["content-length"]), sha1(), sha1(), 0
        kept, head, inside = [], b"", not fields.get("content-type", "").startswith("application/http")
        for part in member.exactly(size):
            block.update(part)
            if not inside:
                head += part
                at = head.find(b"\r\n\r\n")
                if at < 0:
                    if len(head) > HEAD_LIMIT:
                        raise ValueError("an HTTP head without an end")
                    continue
                head, part, inside = head[:at + 4], head[at + 4:], True
            payload.update(part)
            n_bytes += len(part)
            if self.with_payload:
                kept.append(part)
        if member.rest() != _END:
            raise ValueError("no two empty lines after the record's block")
        self._verify(fields, "warc-block-digest", block.digest())
        found["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or base32_sha1(payload.digest())
        if found["record_type"] == "revisit":
            described = re.search(rb"(?im)^content-length: *([0-9]+)", head)
            found.update(payload_bytes=int(described[1]) if described else None, payload=None)
        else:
            self._verify(fields, "warc-payload-digest", payload.digest())
            found.update(payload_bytes=n_bytes, payload=b"".join(kept) if self.with_payload else None)

    @staticmethod
    def _verify(fields: dict, name: str, digest: bytes) -> None:
        told = fields.get(name)
        if told and told.startswith("sha1:") and told != f"sha1:{base32_sha1(digest)}":
            raise ValueError(f"wrong {name}")


def roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to`` of every row of ``pages(page_id, url, html)``."""
    shelf = Shelf(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"))
            .withColumns({"digest": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")}))
    equal = (rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
             .agg(F.count("*").alias("n"), F.max("page_id").alias("last")))
    total = pages.count()
    groups = shelf.keep(equal.filter("n > 1"), "groups").withColumnRenamed("size", "bytes").withColumnRenamed("digest", "sha")
    common = F.col("n") * HOT_SHARE >= max(total, 1)
    same = (F.col("digest") == F.col("sha")) & (F.col("size") == F.col("bytes"))
    hot, cold = F.broadcast(groups.filter(common)), groups.filter(~common)
    joined = rows.join(hot, same).unionByName(rows.join(hot, same, "left_anti").join(cold, same, "left"),
                                              allowMissingColumns=True)
    first = F.col("sha").isNull() | F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", (~first).alias("revisit"),
                         F.when(~first, F.col("last")).alias("refers_to"))


def _write(folder: str, date: str):
    def run(batches):
        files, path = open_folder(folder)
        part, out, rows = TaskContext.get().partitionId(), None, []
        name, at, begin, n = "", 0, 0, 0

        def segment():
            nonlocal begin, n
            if n:
                rows.append((name, begin, at - begin, n))
            begin, n = at, 0
        for batch in batches:
            for page_id, url, payload, digest, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    files.create_dir(path, recursive=True)
                    name, at, begin, n = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz", 0, 0, 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                packed = record(page_id, url, payload, digest, refers_to, revisit, date)
                out.write(packed)
                at, n = at + len(packed), n + 1
                if at - begin >= SEGMENT_BYTES:
                    segment()
                if at >= FILE_BYTES:
                    segment()
                    out.close()
                    out = None
        if out is not None:
            segment()
            out.close()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                ["file", "begin", "length", "n_records"])
    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES,
                   date: str | None = None) -> tuple[DataFrame, str]:
    """Write a record per row of ``pages`` to archives in ``folder`` (by default
    one of its own in the shared folder); returns the manifest and the folder."""
    shelf = Shelf(pages.sparkSession, "archives")
    folder = folder or f"{shelf.path}/files"
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    manifest = roles(pages, min_bytes).mapInArrow(_write(folder, date), "file string, begin long, length long, n_records long")
    return shelf.keep(manifest, "manifest"), folder


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
           ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]


def _row(found: dict) -> dict:
    fields = found.get("fields", {})
    refers = fields.get("warc-refers-to")
    return {"page_id": page_of(fields["warc-record-id"]) if "warc-record-id" in fields else None,
            "refers_to": page_of(refers) if refers else None,
            **{k: found.get(k) for k in ("url", "payload_bytes", "payload_digest", "record_type", "payload", "error")}}


def _read(folder: str, with_payload: bool, strict: bool):
    def run(batches):
        files, path = open_folder(folder)
        for batch in batches:
            for name, begin, length in zip(*(batch.column(c).to_pylist() for c in ("file", "begin", "length"))):
                rows, held = [], 0
                with files.open_input_file(f"{path}/{name}") as source:
                    source.seek(begin)
                    for found in RecordReader(source, length, with_payload, strict):
                        rows.append(_row(found))
                        held += 1000 + len(rows[-1]["payload"] or b"")
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(_FIELDS))
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(_FIELDS))
    return run


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, with_payload: bool = False,
                  strict: bool = True) -> DataFrame:
    """The records of the archives, a row each: ``page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload, error``."""
    # As many tasks as stretches: their rows are a few bytes each, so their size says nothing of the work.
    n = manifest.count()
    return manifest.repartition(max(1, n), "file", "begin").mapInArrow(
        _read(folder, with_payload, strict),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "payload binary, error string")


ORACLE = """
WITH digests AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
base32 AS (
  SELECT page_id, html, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS digest
  FROM digests)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM base32)
"""
