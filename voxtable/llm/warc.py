"""WARC archives: a writer with revisit records and a splittable reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_broadcast, shared_dir, stage, table

MAGIC = b"\x1f\x8b\x08"
#: Payloads from this size on are written once.
LEAST_REVISIT = 1000
#: Bytes of an archive that one task looks for record starts in.
SPLIT = 8 << 20
#: Tasks at most that read archives; a task may have many ranges.
MOST_TASKS = 20_000
#: Bytes that are looked at, or decoded, at once.
BLOCK = 64 << 10
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """id, url, html, digest (SHA-1 of the UTF-8 payload) and refers_to (null for a response).

    Only groups of equal payloads become rows of the join, with the largest id each, found by an
    aggregation that combines before it shuffles; pages that repeat no payload match nothing.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), (F.octet_length(html) >= least).alias("large"))
    groups = stage(rows.where("large").groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"))
    joined = rows.join(bounded_broadcast(groups), "digest", "left")
    return joined.select("id", "url", "html", "digest", F.when(F.col("large") & ~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"))


def _record_id(kind: str, digest: str, page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{kind}:{digest}:{page}')}>"


def record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object = None) -> bytes:
    """One WARC/1.1 record, uncompressed.  X-Page-Id and X-Payload-Length are extension fields."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(kind, digest, page)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id('response', digest, refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    block = http + (payload if refers_to is None else b"")
    return ("\r\n".join([*head, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write the rows of with_roles(), a gzip member each, an archive for each task; (path, bytes, records).

    An attempt writes a file of its own name and only files of attempts that succeed are listed, so a task
    that runs twice, or half, adds nothing.  folder must be one that all executors share.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        path, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
        with where.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None) as out:
            for batch in it:
                for row in zip(*batch.columns, strict=True):
                    page, url, html, digest, refers_to = (x.as_py() for x in row)
                    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = pack.compress(record(page, url, html.encode(), digest, refers_to)) + pack.flush()
                    out.write(member)
                    size, n = size + len(member), n + 1
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([n])], names=["path", "bytes", "records"])

    return stage(rows.mapInArrow(batches, "path string, bytes long, records long"))


class Broken(ValueError):
    """A member that starts as a record does but can't be decoded or read."""


class _File:
    """Bytes of a file from any place; what lies ahead is read in blocks."""

    def __init__(self, file, size: int, block: int = 1 << 20):
        self.file, self.size, self.block, self.buffer, self.base = file, size, block, b"", 0

    def at(self, place: int, n: int) -> bytes:
        n = min(n, self.size - place)
        if n <= 0:
            return b""
        if not self.base <= place <= place + n <= self.base + len(self.buffer):
            self.file.seek(place)
            self.buffer, self.base = self.file.read(max(n, self.block)), place
        return self.buffer[place - self.base : place - self.base + n]


def _decoded(file: _File, place: int) -> tuple[bytes, int] | None:
    """The record whose member starts at a place and where that member ends; None if the bytes there are chance."""
    unpack, at = zlib.decompressobj(31), place
    data = file.at(at, BLOCK)
    at += len(data)
    try:
        parts = [unpack.decompress(data, len(VERSION))]
    except zlib.error:
        return None
    if not parts[0].startswith(VERSION):
        return None
    data = unpack.unconsumed_tail
    while not unpack.eof:
        if not data:
            data = file.at(at, BLOCK)
            at += len(data)
            if not data:
                raise Broken("the archive ends within the record")
        try:
            parts.append(unpack.decompress(data))
        except zlib.error as e:
            raise Broken(str(e)) from e
        data = b""
    return b"".join(parts), at - len(unpack.unused_data)


def _members(file: _File, start: int, end: int) -> Iterator[tuple[int, bytes | Broken]]:
    """Place and decoded bytes of every record whose member starts in [start, end)."""
    at = start
    while at < end:
        found = file.at(at, BLOCK).find(MAGIC)
        if found < 0:
            at += BLOCK - len(MAGIC) + 1
            continue
        at += found
        if at >= end:
            return
        try:
            got = _decoded(file, at)
        except Broken as e:
            yield at, e
            got = None
        if got:
            yield at, got[0]
        at = got[1] if got else at + 1


def _sha1(value: str | None) -> str | None:
    """A labelled SHA-1 in bare lower-case hex, given in hex or, as most archives have it, in base32; None for any other digest."""
    kind, _, digest = (value or "").strip().partition(":")
    if kind.lower() != "sha1" or len(digest) not in (32, 40):
        return None
    try:
        return (bytes.fromhex(digest) if len(digest) == 40 else base64.b32decode(digest, casefold=True)).hex()
    except ValueError:
        return None


def parse_record(data: bytes) -> tuple:
    """(page id, url, type, payload or None, digest, payload bytes, refers_to) of a decoded record.

    The payload of an HTTP response is what follows its HTTP header, that of any other record its block; a revisit
    has none, and no size either if its writer didn't note it.  A record without a SHA-1 gets its payload's.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    if not gap or "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        raise Broken("the header lacks its end, WARC-Type or Content-Length")
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise Broken("the block is shorter than Content-Length")
    kind, digest = fields["warc-type"], _sha1(fields.get("warc-payload-digest"))
    if kind == "revisit":
        payload, size = None, int(fields["x-payload-length"]) if fields.get("x-payload-length", "").isdigit() else None
    else:
        http = kind == "response" and fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise Broken(f"a payload doesn't have the digest {digest}")
        digest, size = found, len(payload)
    return fields.get("x-page-id"), fields.get("warc-target-uri"), kind, payload, digest, size, fields.get("x-refers-to-page-id")


def read_archives(files: DataFrame, split: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """The records of archives, given as rows of path and bytes.

    Every archive is cut into ranges of `split` bytes, a task's work each.  A task looks for the gzip magic
    in its range, takes a place for a member only if a WARC header decodes there, and owns the records that
    start within the range, reading on behind it to end the last one.  So each record is read exactly once
    wherever the cuts fall, however long its header or block, also from archives that were written elsewhere
    with a member for each record (records of any type, digests in hex or base32).

    Result: page_id, url, record_type, payload (null for a revisit), payload_digest, payload_bytes, refers_to,
    problem.  A member that starts as a record but can't be read is a row with the reason and its place as
    problem and nulls otherwise; nothing is passed over in silence.  No files, or empty ones: no rows.
    """
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split}L)")).alias("start"))
    n = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split)), F.lit(0))).first()[0]
    names = ["page_id", "url", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to", "problem"]
    types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.string()]
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def row_of(path: str, at: int, data: bytes | Broken) -> tuple:
        try:
            if isinstance(data, Broken):
                raise data
            row = parse_record(data)
        except Broken as e:
            return *[None] * 7, f"{path} at {at}: {e}"
        return (*row, None) if with_payload else (*row[:3], None, *row[4:], None)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where, inner = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with where.open_input_file(inner) as file:
                    for at, data in _members(_File(file, size), start, min(start + split, size)):
                        rows.append(row_of(path, at, data))
                        held += 500 + len(rows[-1][3] or b"")
                        if held > 8 << 20:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)

    schema = "page_id string, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to string, problem string"
    # a given number of tasks: ranges are tiny rows, which adaptive execution would gather in one task
    return ranges.repartition(max(1, min(n, MOST_TASKS)), "path", "start").mapInArrow(batches, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None, with_payload: bool = True) -> DataFrame:
    """Write pages as archives below folder (by default in the shared folder) and read them back.

    Null html is an empty payload; a null id or url is left out of the record.  Of equal payloads of at least
    LEAST_REVISIT bytes the largest id is the response (rows that repeat that id are responses too; without
    any id all are).  An empty table gives no rows.  Ids come back in their own type.
    """
    files = write_archives(with_roles(pages, id_col, url_col, html_col), folder or shared_dir(pages.sparkSession))
    kind = pages.select(id_col).schema[0].dataType
    found = stage(read_archives(files, with_payload=with_payload))
    written, (read, problem) = files.agg(F.sum("records")).first()[0] or 0, found.agg(F.count("*"), F.min("problem")).first()
    if problem or read != written:
        raise ValueError(problem or f"{written} records were written, {read} read")
    return found.drop("problem").withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
