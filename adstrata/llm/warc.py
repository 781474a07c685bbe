"""WARC archives: a deduplicating writer and a splittable reader.

Every record is one gzip member, so archives can be read from any byte: a task scans its range for
gzip magic, believes a candidate once its first decoded bytes are a WARC header, and owns the
records that start inside the range, wherever they end. Ranges of one file therefore read in
parallel and each record is read once.

Writing is two narrow steps around one join. Payloads are hashed in the JVM to find the digests
that occur more than once; records are compressed before they are shuffled and revisits carry no
payload. Every attempt of a writing task has its own file name and only files named in the
committed manifest count, so a lost executor or a second attempt leaves no half archive behind.

Nulls: a null payload is empty, a null url is left out, a null id is kept and comes after all
others when the smallest is sought. Repeated ids are separate records; rows that repeat both the
smallest id and its payload are all responses. An empty table gives no archive and no record. Damaged
places of an archive raise an error or come as rows, see `read_archives`.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, sha256_text, stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
STEP = 1 << 18
_ID = re.compile(rb"<urn:page:(-?\d+)>")
MANIFEST = "path string, length long, records long"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary, path string, offset long"
)


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _record(kind: str, page_id, url, digest: str, length: int, block: bytes, refers_to=None) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}"]
    if url is not None:
        # Line ends and the like would end the header early.
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: {_urn(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {length}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return VERSION + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as compressed response records, with digest and join key."""
    for batch in batches:
        rows = {"page_id": [], "url": [], "digest": [], "length": [], "key": [], "member": []}
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            payload = (html or "").encode("utf-8", "surrogatepass")
            digest = hashlib.sha256(payload).hexdigest()
            rows["page_id"].append(page_id)
            rows["url"].append(url)
            rows["digest"].append(digest)
            rows["length"].append(len(payload))
            rows["key"].append(digest)
            rows["member"].append(_member(_record("response", page_id, url, digest, len(payload), HTTP + payload)))
        yield pa.RecordBatch.from_pydict(rows, schema=_PACKED)


_PACKED = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("length", pa.int64()),
     ("key", pa.string()), ("member", pa.binary())]
)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, length, records = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store, base = fs.FileSystem.from_uri(folder)
                    store.create_dir(base, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", store.open_output_stream(f"{base}/{name}", compression=None)
                member = row["member"]
                if row["refers_to"] is not None:
                    member = _member(
                        _record("revisit", row["page_id"], row["url"], row["digest"], row["length"], HTTP, row["refers_to"])
                    )
                out.write(member)
                length, records = length + len(member), records + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "length": [length], "records": [records]})

    return write


def write_archives(
    pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
    payload: str = "html", min_revisit_bytes: int = 100,
) -> DataFrame:
    """Write one record per page below `folder`; returns the committed manifest of files."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    pages = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(payload).alias("html")
    )
    # Only digests that occur more than once can make a revisit.
    first = stored(
        pages.where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy(sha256_text(F.col("html")).alias("first_key"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("_n"))
        .where("_n > 1 and first_id is not null")
        .select("first_key", "first_id"),
        "warc-first",
    )
    packed = pages.mapInArrow(_packed, "page_id long, url string, digest string, length long, key string, member binary")
    # Payloads too small for a revisit are often one and the same, such as empty: spread them.
    key = F.when(F.col("length") >= min_revisit_bytes, F.col("key")).otherwise(
        F.concat(F.lit("small:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    )
    typed = packed.withColumn("key", key).join(first, F.col("key") == F.col("first_key"), "left")
    refers = F.when((F.col("first_id") < F.col("page_id")) | F.col("page_id").isNull(), F.col("first_id"))
    written = typed.select("page_id", "url", "digest", "length", "member", refers.alias("refers_to"))
    return stored(written.mapInArrow(_writer(folder), MANIFEST), "warc-manifest")


def _fields(head: bytes) -> dict[bytes, bytes]:
    return dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)


def _page(value: bytes | None) -> int | None:
    found = _ID.fullmatch(value or b"")
    return int(found[1]) if found else None


class Damage(ValueError):
    """A place of an archive where a record has to start and none can be read."""


def _begins(file, at: int) -> bool:
    """Whether a member that holds a WARC record begins there."""
    file.seek(at)
    head, unpack, parts = file.read(4096), zlib.decompressobj(31), b""
    if not head.startswith(MAGIC):
        return False
    try:
        parts = unpack.decompress(head, 4096)
    except zlib.error:
        return False
    return parts.startswith(VERSION)


def _decode(file, start: int) -> tuple[bytes, int]:
    """The record that begins there and the offset behind its member."""
    unpack, file_at, parts = zlib.decompressobj(31), start, []
    file.seek(start)
    while not unpack.eof:
        data = file.read(STEP)
        if not data:
            raise Damage("the record ends early")
        file_at += len(data)
        try:
            parts.append(unpack.decompress(data))
        except zlib.error as broken:
            raise Damage(f"the record cannot be decoded: {broken}") from None
    return b"".join(parts), file_at - len(unpack.unused_data)


def _find(file, at: int, end: int) -> int | None:
    """The first record that begins in [at, end)."""
    base, block = at, b""
    while at < end:
        if not base <= at < base + len(block) - 2:
            file.seek(at)
            base, block = at, file.read(min(STEP, end - at) + 2)
        found = block.find(MAGIC, at - base)
        if found < 0:
            at = max(at + 1, base + len(block) - 2)
            continue
        at = base + found
        if at >= end:
            return None
        if _begins(file, at):
            return at
        at += 1
    return None


def records_of_range(file, start: int, end: int, size: int, report: bool = False) -> Iterator[tuple[int, bytes | None]]:
    """(offset, decoded record) of the records that start in [start, end) of a file of `size` bytes.

    Members follow each other without gaps, so whoever reads a record also sees to it that one begins
    behind it (or the file ends there), and the first range sees to the file's beginning. Where that fails, or a
    record that has begun cannot be decoded, Damage is raised, or with `report` (offset, None) is
    given and reading goes on with the next record that begins behind.
    """

    def damaged(at: int, what: str) -> tuple[int, None]:
        if not report:
            raise Damage(f"at {at}: {what}")
        return at, None

    if start == 0 < end and size and not _begins(file, 0):
        yield damaged(0, "no record begins there")
    at = _find(file, start, end)
    while at is not None and at < end:
        try:
            record, behind = _decode(file, at)
        except Damage as broken:
            yield damaged(at, str(broken))
            at = _find(file, at + 1, end)
            continue
        yield at, record
        if behind < size and not _begins(file, behind):
            yield damaged(behind, "no record begins there")
            behind = _find(file, behind + 1, end)
        at = behind


def _row(record: bytes, with_payload: bool, where: tuple) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields[b"Content-Length"])]
    kind, payload = fields[b"WARC-Type"].decode(), None
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
    length = int(fields[b"WARC-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise Damage("the payload does not match its digest")
    url = fields.get(b"WARC-Target-URI")
    if url is not None:
        url = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url.decode("utf-8", "surrogatepass"))
    return (
        _page(fields.get(b"WARC-Record-ID")), url, kind, length, digest, _page(fields.get(b"WARC-Refers-To")),
        payload if with_payload else None, *where,
    )


def _reader(with_payload: bool, report: bool, batch_bytes: int = 8 << 20):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ranges in batches:
            for path, start, end, length in zip(*(ranges[c] for c in ("path", "start", "end", "length")), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                lost = lambda at, path=path: (None, None, "damaged", None, None, None, None, path, at)
                with store.open_input_file(name) as file:
                    size = file.size()
                    if size != length and end == length:
                        if not report:
                            raise Damage(f"{path} has {size} bytes, not {length}")
                        rows.append(lost(min(size, length)))
                    try:
                        for offset, record in records_of_range(file, int(start), int(min(end, size)), size, report):
                            try:
                                rows.append(lost(offset) if record is None else _row(record, with_payload, (path, offset)))
                            except (Damage, KeyError, ValueError) as broken:
                                if not report:
                                    raise Damage(f"at {offset}: {broken}") from None
                                rows.append(lost(offset))
                            held += len(record or b"") if with_payload else 300
                            if held >= batch_bytes:
                                yield _frame(rows)
                                rows, held = [], 0
                    except Damage as broken:
                        raise Damage(f"{path} {broken}") from None
                yield _frame(rows)

    return read


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    frame = pd.DataFrame(rows, columns=[n.strip() for n in names])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64", "offset": "Int64"})


def read_archives(
    manifest: DataFrame, split_bytes: int = 8 << 20, with_payload: bool = True, damage: str = "raise"
) -> DataFrame:
    """All records of the files (path, length), read by byte ranges of `split_bytes`.

    A place where a record should be and cannot be read, and a file whose length is not the manifest's, raise an
    error; with `damage="report"` each is a row of record_type `damaged` with its path and offset.
    """
    if damage not in ("raise", "report"):
        raise ValueError(f"damage must be raise or report, not {damage!r}")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = manifest.where("length > 0").select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("length"), F.col("start") + split_bytes).alias("end"), "length")
    return ranges.repartition("path", "start").mapInPandas(_reader(with_payload, damage == "report"), RECORDS)
