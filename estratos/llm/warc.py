"""Operator 7: WARC archives, with a normaliser for files that are one gzip stream.

`write_archives` writes a record per row, each file one gzip stream over all its records. `normalise` inflates such a
file once, from front to back, writes every record as a gzip member of its own, and next to it a sidecar index with
the place of each member. `read_records` goes through the index and inflates single members.

Files go to a folder all executors share, through Arrow's file systems, so a local path, HDFS or an object store will
do. Every attempt of a task writes under a name of its own and only files that a finished task reports are read on, so
retries, lost executors and speculation leave no double records. Memory is bounded by the largest record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estratos.llm.common import read, written
from estratos.session import scratch_path

#: Bytes of records after which a new file is begun, and bytes read from a stream at a time.
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
LEVEL = 3
_GZIP = 16 + zlib.MAX_WBITS
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, at: datetime
) -> bytes:
    """One WARC record of the time `at`. A revisit names the record it repeats and has no payload of its own, only its digest and size."""
    block = b"" if revisit else _HTTP + payload
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {at.astimezone(timezone.utc):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    else:
        head += ["Content-Type: application/http; msgtype=response"]
    head += [f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header(raw: bytes) -> dict[str, str]:
    """The fields of a record's header."""
    lines = raw[: raw.index(b"\r\n\r\n")].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def records(stream) -> Iterator[bytes]:
    """The records of a gzipped stream (one member or many), each whole, holding one at a time.

    A stream that ends within a record, or within a member (such as before its trailer), raises an error.
    """
    buffer, inflate, begun = bytearray(), zlib.decompressobj(_GZIP), False

    def more() -> bool:
        nonlocal inflate, begun
        data = stream.read(READ_BYTES)
        if not data:
            return False
        begun = True
        while data:
            buffer.extend(inflate.decompress(data))
            data = inflate.unused_data
            if data:
                inflate = zlib.decompressobj(_GZIP)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if buffer.strip():
                raise ValueError("the stream ends within a header")
            if begun and not inflate.eof:
                raise ValueError("the stream ends within a member")
            return
        size = end + 4 + int(header(bytes(buffer[: end + 4]))["content-length"]) + 4
        while len(buffer) < size:
            if not more():
                raise ValueError("the stream ends within a record")
        yield bytes(buffer[:size])
        del buffer[:size]


def _open(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str, at: datetime | None = None) -> DataFrame:
    """Write `page_id`, `url`, `payload`, `refers_to`, `revisit` as archives of one gzip stream each; gives their paths.

    All records have the time `at`, by default that of the call.
    """
    at = at or datetime.now(timezone.utc)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        paths, out, deflate, size = [], None, None, 0
        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    paths.append(f"{root}/{uuid.uuid4().hex}.warc.gz")
                    out, deflate, size = system.open_output_stream(paths[-1], compression=None), zlib.compressobj(LEVEL, wbits=_GZIP), 0
                raw = record(page_id, url, payload or b"", refers_to, revisit, at)
                out.write(deflate.compress(raw))
                size += len(raw)
                if size >= FILE_BYTES:
                    out.write(deflate.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(deflate.flush())
            out.close()
        names = [path.rpartition("/")[2] for path in paths]
        yield pa.record_batch([pa.array(names, pa.string())], names=["name"])

    chosen = pages.select("page_id", "url", "payload", "refers_to", "revisit")
    return written(chosen.mapInArrow(write, "name string"), "archives")


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the named archives of `source` record by record into `target`; gives `name` and `index` of each.

    The index is a text file with one line per record: offset and length of its member, and its WARC-Record-ID.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, root), (_, into) = _open(source), _open(target)
        system.create_dir(into, recursive=True)
        for batch in batches:
            done = []
            for name in batch.column(0).to_pylist():
                new, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                with (
                    system.open_input_stream(f"{root}/{name}", compression=None) as stream,
                    system.open_output_stream(f"{into}/{new}", compression=None) as out,
                    system.open_output_stream(f"{into}/{new}.idx", compression=None) as index,
                ):
                    for raw in records(stream):
                        deflate = zlib.compressobj(LEVEL, wbits=_GZIP)
                        member = deflate.compress(raw) + deflate.flush()
                        out.write(member)
                        index.write(f"{offset}\t{len(member)}\t{header(raw)['warc-record-id']}\n".encode())
                        offset += len(member)
                done.append(new)
            yield pa.record_batch([pa.array(done, pa.string())], names=["name"])

    # One file is one task's work: files are dealt to as many partitions as there are files.
    files = max(1, archives.count())
    return written(archives.repartition(files, "name").mapInArrow(rewrite, "name string"), "normalised")


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """The records of normalised archives, member by member through their indexes.

    Gives `page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`. The digest of a stored payload is
    computed from what was read and has to agree with the header.
    """

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}.idx", compression=None) as index:
                    lines = index.read().decode().splitlines()
                with system.open_input_file(f"{root}/{name}") as file:
                    for begin in range(0, len(lines), 1000):
                        rows = []
                        for line in lines[begin : begin + 1000]:
                            offset, length, _ = line.split("\t")
                            raw = zlib.decompress(file.read_at(int(length), int(offset)), wbits=_GZIP)
                            rows.append(_facts(raw))
                        yield pa.RecordBatch.from_pylist(rows, schema=_FACTS)

    files = max(1, archives.count())
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return archives.repartition(files, "name").mapInArrow(lookup, schema)


_FACTS = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _facts(raw: bytes) -> dict:
    head = header(raw)
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response":
        block = raw[raw.index(b"\r\n\r\n") + 4 : -4]
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if payload_digest(payload) != digest or len(payload) != int(head["x-payload-length"]):
            raise ValueError(f"record {head['warc-record-id']} is damaged")
    return {
        "page_id": _page(head["warc-record-id"]),
        "payload_bytes": int(head["x-payload-length"]),
        "payload_digest": digest,
        "record_type": head["warc-type"],
        "refers_to": _page(head.get("warc-refers-to")),
    }


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`page_id`, `url`, `payload`, `refers_to`, `revisit` of `page_id`, `url`, `html`.

    Of rows with equal payloads of `least_bytes` or more, those with the smallest page_id are responses and the others
    revisit it; all smaller payloads are responses. A null html is an empty payload; a null page_id is larger than any.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    # Only payloads that occur twice are looked up. Written, so that the join is one of two exchanges of their own and a
    # payload that very many pages have can be split.
    often = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = written(often.select("digest", "first"), "digests")
    later = (F.length("payload") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return keyed.join(first, "digest", "left").select(
        "page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to"), later.alias("revisit")
    )


def archive_and_read(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages as monolithic archives, normalise them, and read all records back; empty tables give no rows."""
    whole, single = scratch_path(spark, "warc"), scratch_path(spark, "warc-members")
    archives = write_archives(with_revisits(pages, least_bytes), whole)
    return read_records(normalise(archives, whole, single), single)


def op7_warc_members(spark, sf_dir: str) -> DataFrame:
    """All pages, written as archives of one gzip stream each, normalised, and read back."""
    return archive_and_read(spark, read(spark, sf_dir, "pages").select("page_id", "url", "html"))
