"""WARC: a file compressed as one gzip stream, rewritten with a member a record and an offset index.

One stream can only be read from its beginning. The normaliser inflates it once, a block at a time,
cuts it into records by their Content-Length, writes each as a gzip member of its own and lists
offset and length of each member in a sidecar (a line a record). Afterwards any record is one seek
and one small inflate away, and the file still reads as an ordinary .warc.gz from its beginning.

Files are written under another name until whole, so a retried task does no harm. Memory is that of
the largest record.

Defined results: a null url is '-', a null body is empty, a null page_id is listed as null; repeated
pages are records of their own; an empty table has no file. A stream that ends early or isn't gzip
gives the records before the damage and one row with ``error``; so does a record without a length.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path

BLOCK = 1 << 20
LEVEL = 6
FILES = "file string, n_records bigint"
INDEX = "file string, place bigint, member_offset bigint, member_length bigint, error string"
RECORDS = "page_id bigint, url string, shard string, place bigint, member_offset bigint, member_length bigint, body_bytes bigint, body_md5 string, error string"


def new_folder(spark: SparkSession) -> str:
    folder = os.path.join(shared_path(spark), f"warc-{uuid.uuid4().hex}")
    os.makedirs(folder)
    return folder


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    body = (html or "").encode("utf-8", "surrogatepass")
    uri = " ".join((url or "-").split()) or "-"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}:{uri}")
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: {uri}\r\nWARC-Page-ID: {'' if page_id is None else page_id}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """One file a partition, all its records in a single gzip stream; a row a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = os.path.join(folder, f"part-{TaskContext.get().partitionId():05d}.warc.gz")
        other, n = f"{whole}.{uuid.uuid4().hex}", 0
        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        with open(other, "wb") as f:
            for b in batches:
                for page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    f.write(pack.compress(record(*page)))
                    n += 1
            f.write(pack.flush())
        if not n:
            os.remove(other)
            return
        os.replace(other, whole)
        yield pa.RecordBatch.from_pydict({"file": [whole], "n_records": [n]})

    return pages.select("page_id", "url", "html").mapInArrow(run, FILES)


def blocks(path: str) -> Iterator[bytes]:
    """The inflated file, block by block; also one of several members."""
    with open(path, "rb") as f:
        d, fresh = zlib.decompressobj(31), True
        while raw := f.read(BLOCK):
            while raw:
                if got := d.decompress(raw, BLOCK):
                    yield got
                fresh = False
                raw = d.unconsumed_tail
                if d.eof:
                    raw, d, fresh = d.unused_data, zlib.decompressobj(31), True
        while not fresh:
            got = d.decompress(d.unconsumed_tail, BLOCK)
            if got:
                yield got
            elif not d.eof:
                raise EOFError("the stream ends early")
            else:
                fresh = True


def header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a stream of bytes."""
    held = bytearray()
    need = -1  # bytes of the record at the front, once its header is known
    for part in parts:
        held += part
        at = 0
        while True:
            if need < 0:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                size = header(bytes(held[at:end])).get("content-length", "")
                if not held.startswith(b"WARC/", at) or not size.isdigit():
                    raise ValueError("a record without a header or length")
                need = end - at + 4 + int(size) + 4
            if len(held) - at < need:
                break
            yield bytes(held[at : at + need])
            at, need = at + need, -1
        del held[:at]
    if held.strip():
        raise EOFError("the last record is cut")


def normalise_file(path: str) -> tuple[str, list[tuple[int, int]], str | None]:
    """Writes ``X.members.warc.gz`` and its ``.idx``; the file, offset and length of each member, and what was wrong."""
    to = path.removesuffix(".gz").removesuffix(".warc") + ".members.warc.gz"
    other, index, at, error = f"{to}.{uuid.uuid4().hex}", [], 0, None
    with open(other, "wb") as f:
        try:
            for r in records(blocks(path)):
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = pack.compress(r) + pack.flush()
                f.write(member)
                index.append((at, len(member)))
                at += len(member)
        except (EOFError, ValueError, zlib.error, OSError) as e:
            error = f"{type(e).__name__}: {e}"
    side = f"{to}.idx.{uuid.uuid4().hex}"
    with open(side, "w") as f:
        f.writelines(f"{a}\t{n}\n" for a, n in index)
    os.replace(other, to)
    os.replace(side, f"{to}.idx")
    return to, index, error


def normalised(files: DataFrame) -> DataFrame:
    """Normalises the files named in column ``file``; a row a record and one for each damaged file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                if path is None:
                    continue
                to, index, error = normalise_file(path)
                n = len(index)
                rows = {"file": [to] * n, "place": list(range(n)), "member_offset": [a for a, _ in index], "member_length": [x for _, x in index], "error": [None] * n}
                if error:
                    for k, v in (("file", to), ("place", n), ("member_offset", None), ("member_length", None), ("error", error)):
                        rows[k].append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("file", pa.string()), ("place", pa.int64()), ("member_offset", pa.int64()), ("member_length", pa.int64()), ("error", pa.string())]))

    return files.select("file").mapInArrow(run, INDEX)


def read_member(f, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header and body of one record."""
    f.seek(offset)
    whole = zlib.decompress(f.read(length), 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    return header(head), rest[:-4]


def read_back(index: DataFrame) -> DataFrame:
    """Every record through its offset: page_id, url, size and MD5 of the body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f = None, None
        for b in batches:
            rows = []
            for path, place, offset, length, error in zip(*(c.to_pylist() for c in b.columns), strict=True):
                shard = os.path.basename(path).split(".")[0]
                if error is not None:
                    rows.append((None, None, shard, place, None, None, None, None, error))
                    continue
                if opened != path:
                    if f:
                        f.close()
                    opened, f = path, open(path, "rb")  # noqa: SIM115
                head, body = read_member(f, offset, length)
                page = head.get("warc-page-id") or None
                rows.append((int(page) if page else None, head.get("warc-target-uri"), shard, place, offset, length, len(body), hashlib.md5(body).hexdigest(), None))
            names = [x.split()[0] for x in RECORDS.split(", ")]
            kinds = [pa.int64() if x.endswith("bigint") else pa.string() for x in RECORDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        if f:
            f.close()

    return index.mapInArrow(run, RECORDS)


def rewritten(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """The pages as monolithic files, normalised, and every record read again by its offset."""
    folder = folder or new_folder(pages.sparkSession)
    return read_back(normalised(write_monolithic(pages, folder)))
