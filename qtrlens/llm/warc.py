"""WARC archives: writing records and a splittable reader.

Writing. Every page becomes one WARC record in a gzip member of its own, and
Spark's text writer puts the members one after another (its committer makes
retried tasks safe on any file system). That writer ends each value with a
separator; the last byte of a gzip member is the top byte of its length, which
is zero below 16 MiB, so the separator is a zero byte and takes that byte's
place. A larger record is followed by an empty member, which ends in zero too.
The files are plain concatenations of gzip members.

Reading. The archive is read by byte ranges: Spark cuts the files anywhere, a
task scans its range for the gzip magic and owns the candidates that start
inside. A candidate is a record if it inflates to a WARC header and ends in a
valid gzip trailer. The magic can also occur inside compressed data: such a
false start fails to decode and belongs to the member before it. If that
member began in another range, both tasks hand over what they hold - the open
tail and the leading false starts - and a small second step joins them.

Of records with equal payloads (of at least ``min_revisit`` bytes) the one
with the largest id is a response, the others are revisits that refer to it.

Defined results: a null payload is empty; a null url has no target line;
records with a null id are responses. Rows that repeat id and payload are
records of their own (all responses if theirs is the largest id). An empty
table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrlens.llm.common import small_batches, stored
from qtrlens.session import scratch_path

MIN_REVISIT = 1000
LEVEL = 6
MAGIC = b"\x1f\x8b\x08"
# ---- fixed values: an empty gzip member, the revisit profile, a fixed date
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ID = "urn:x-page:"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{ID}{'null' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member whose last byte is zero (see the module's text)."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = c.compress(data) + c.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def _members(level):
    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                out = [gzip_member(record_bytes(i, u, (p or "").encode("utf-8", "surrogatepass"), r), level)[:-1]
                       for i, u, p, r in zip(*(part.column(k).to_pylist() for k in range(4)))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
    return run


def revisits(pages: DataFrame, id_col: str, payload_col: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, digest, refers_to`` of the records that repeat a payload."""
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
                        F.octet_length(payload).alias("size")).where(F.col("size") >= min_revisit)
    first = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").drop("n")
    return rows.select("page_id", "digest").join(first, "digest").where("page_id < refers_to") \
        .select("page_id", "digest", "refers_to").distinct()


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit: int = MIN_REVISIT, level: int = LEVEL) -> None:
    """Write one record per row as gzip members into files under ``path``."""
    small_batches(pages.sparkSession)
    again = stored(revisits(pages, id_col, payload_col, min_revisit), "op5-revisits")
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"))
    rows = rows.join(again, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")
    members = rows.mapInArrow(_members(level), "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.mode("overwrite") \
        .option("lineSep", "\x00").text(path)


# ------------------------------------------------------------------- reading
class _Open:
    """A gzip member being inflated as its bytes come in."""

    def __init__(self):
        self.inflate = zlib.decompressobj(31)
        self.raw: list[bytes] = []
        self.out: list[bytes] = []
        self.seen = b""                     # the first five bytes inflated

    def feed(self, data: bytes) -> bool:
        """False if the bytes cannot belong to a record's member."""
        try:
            got = self.inflate.decompress(data)
        except zlib.error:
            return False
        self.raw.append(data)
        self.out.append(got)
        self.seen = (self.seen + got[:5])[:5]
        return not self.inflate.unused_data and b"WARC/".startswith(self.seen)

    @property
    def ended(self) -> bool:
        return self.inflate.eof

    @property
    def sure(self) -> bool:
        """It has inflated to a record's start, or is a whole empty member."""
        return self.seen == b"WARC/" or self.ended and not self.seen


def parse_record(data: bytes) -> dict | None:
    """Fields of an inflated WARC record, None for an empty member."""
    if not data:
        return None
    head, sep, rest = data.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower()] = v.strip()
    block = rest[:int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields[b"warc-type"].decode()
    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    ident = lambda v: int(v) if (v := v.strip(b"<>").decode().removeprefix(ID)) != "null" else None
    if kind == "revisit":
        declared = fields[b"warc-payload-digest"].decode().split(":")[1]
        digest, n, payload = base64.b32decode(declared).hex(), int(size[1]), None
    else:
        digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
    return {"page_id": ident(fields[b"warc-record-id"]), "record_type": kind, "payload_bytes": n,
            "payload_digest": digest, "refers_to": ident(fields[b"warc-refers-to"]) if b"warc-refers-to" in fields else None,
            "url": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace") or None,
            "payload": payload}


_NAMES = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "url", "payload",
          "path", "block", "seq", "part", "raw"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(),
          pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
_SCHEMA = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, "
           "payload binary, path string, block long, seq long, part string, raw binary")
_ORPHAN = dict.fromkeys(_NAMES[:7])


class _Range:
    """Members found in one byte range of one file, in order.

    Where a member begins is known from the range's first sure start on (in a
    file's first range, from its first byte). Before that every candidate is
    followed until it fails or is sure; what precedes the first sure one goes
    on from the range before."""

    def __init__(self, path, block, with_payload, known=False):
        self.path, self.block, self.with_payload = path, block, with_payload
        self.open: _Open | None = None
        self.known = known
        self.waiting: list[bytes] = []
        self.maybe: list[tuple[_Open, int]] = []
        self.seq = 0

    def _orphan(self, part, raw):
        self.seq += 1
        return {**_ORPHAN, "path": self.path, "block": self.block, "seq": self.seq, "part": part, "raw": raw}

    def candidate(self, data: bytes):
        """Rows that the candidate ``data`` (from one magic to the next)
        completes."""
        if self.known:
            member = self.open or _Open()
            if not member.feed(data):
                raise ValueError(f"damaged gzip member in {self.path}")
            self.open = member
        else:
            self.waiting.append(data)
            self.maybe.append((_Open(), len(self.waiting) - 1))
            self.maybe = [(o, i) for o, i in self.maybe if o.feed(data)]
            first = next(((o, i) for o, i in self.maybe if o.sure), None)
            if first is None:
                return
            self.open, at = first
            for raw in self.waiting[:at]:
                yield self._orphan("head", raw)
            self.known, self.waiting, self.maybe = True, [], []
        if self.open.ended:
            done, self.open = self.open, None
            yield from self.finish(b"".join(done.out))

    def finish(self, data: bytes):
        row = parse_record(data)
        if row is not None:
            if not self.with_payload:
                row["payload"] = None
            yield {**dict.fromkeys(_NAMES), **row}

    def end(self):
        """What is left when the range ends."""
        for raw in self.waiting:
            yield self._orphan("head", raw)
        if self.open is not None:
            yield self._orphan("tail", b"".join(self.open.raw))
        self.waiting, self.open = [], None


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, _TYPES)], names=_NAMES)


def _scan(with_payload):
    def run(batches):
        at, rows, size = None, [], 0
        for batch in batches:
            for value, path, block in zip(*(batch.column(k) for k in range(3))):
                value, path, block = value.as_py(), path.as_py(), block.as_py()
                if at is None or (at.path, at.block) != (path, block):
                    if at is not None:
                        rows += at.end()
                    at = _Range(path, block, with_payload, known=block == 0)
                    if block == 0:                       # what precedes the file's first magic
                        if value:
                            raise ValueError(f"{path} does not start with a gzip member")
                        continue
                new = list(at.candidate(MAGIC + value))
                rows += new
                size += len(value) + sum(len(r["payload"] or b"") for r in new)
                if size > 1 << 22:
                    yield _batch(rows)
                    rows, size = [], 0
        if at is not None:
            rows += at.end()
        if rows:
            yield _batch(rows)
    return run


def _stitch(with_payload):
    """Join open tails with the false starts of the ranges after them."""
    def run(batches):
        path, at, rows = None, None, []
        for batch in batches:
            for p, part, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if p != path:
                    if at is not None and at.open is not None:
                        raise ValueError(f"truncated gzip member in {path}")
                    path, at = p, _Range(p, -1, with_payload, known=True)
                rows += at.candidate(raw)
            if rows:
                yield _batch(rows)
                rows = []
        if at is not None and at.open is not None:
            raise ValueError(f"truncated gzip member in {path}")
    return run


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record: ``page_id, record_type, payload_bytes,
    payload_digest, refers_to, url, payload`` (no payload for revisits, whose
    size and digest are those declared for the response they refer to)."""
    small_batches(spark)
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    ranges = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
                          F.col("_metadata.file_block_start").alias("block"))
    found = stored(ranges.mapInArrow(_scan(with_payload), _SCHEMA), "op5-records")
    loose = (found.where("part is not null").select("path", "part", "raw", "block", "seq")
             .repartition("path").sortWithinPartitions("path", "block", "seq").select("path", "part", "raw"))
    joined = loose.mapInArrow(_stitch(with_payload), _SCHEMA)
    return found.where("part is null").unionByName(joined).select(*_NAMES[:7])


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back
    (without payloads)."""
    spark = pages.sparkSession
    path = scratch_path(spark, "op5-warc")
    write_archive(pages, path, **options)
    return read_archive(spark, path, with_payload=False)
