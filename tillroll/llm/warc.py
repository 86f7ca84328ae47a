"""WARC archives written and read as streams, with a chunked record table.

Writing: payload digests decide which records are stored (response) and which refer to another one
with the same payload (revisit); every task then writes gzip members to its own archive file in a
shared folder, a piece at a time. The files that count are those named in the manifest that Spark
commits, so a retried or speculative task leaves at most an unlisted file.

Reading: a task streams an archive and emits each payload as rows (record_id, chunk): fixed-size
chunks with their offset and the digest of everything up to their end. The last chunk's row holds
the whole payload's length and digest; no record is ever held as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written
from tillroll.session import scratch_path

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Tasks that read archives; beyond, a task reads several, one after the other.
MAX_READ_TASKS = 50_000
_DATE = b"1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class WarcParams:
    """``chunk``: payload bytes of a row of the record table and of a write; ``least``: payloads
    of fewer bytes are always stored; ``archive_records``: rows after which a new file begins."""

    chunk: int = 1 << 20
    least: int = 0
    archive_records: int = 20_000


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_uri(record_id: int | None) -> bytes:
    return b"<urn:record:" + (b"none" if record_id is None else str(record_id).encode()) + b">"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI or plain path (the shared folder may be either)."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")


class ArchiveWriter:
    """Gzip members, one per record, written piece by piece."""

    def __init__(self, path: str):
        system, place = _place(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(place)

    def write(self, head: list[tuple[bytes, bytes]], block_head: bytes, payload: memoryview, chunk: int) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        lines = [VERSION, *[k + b": " + v for k, v in head],
                 b"Content-Length: " + str(len(block_head) + len(payload)).encode()]
        self.out.write(packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block_head))
        for at in range(0, len(payload), chunk):
            self.out.write(packer.compress(payload[at:at + chunk]))
        self.out.write(packer.compress(b"\r\n\r\n"))
        self.out.write(packer.flush())

    def close(self) -> None:
        self.out.close()


def decide_records(pages: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses.

    Of the rows with one digest (of at least ``least`` bytes) that with the largest id is stored.
    Digests are grouped with partial sums; the join back is a plain equi-join whose hot keys
    adaptive execution can split.
    """
    columns = pages.select(F.col(id_col).cast("long").alias("page_id"),
                           (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("payload"))
    keyed = columns.withColumn("digest", F.sha1("payload"))
    largest = (keyed.filter((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
               .groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").select("digest", "kept"))
    return keyed.join(largest, "digest", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") < F.col("kept"), F.col("kept")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", text_col: str = "html",
                   params: WarcParams = WarcParams()) -> DataFrame:
    """Writes one record per row to ``*.warc.gz`` files in ``folder`` (shared by all executors);
    returns the committed manifest (path, records).

    Null payloads count as empty. Rows that repeat a page_id are each written; those with the
    largest id of equal payloads are all responses; a null id never stands for others and is
    written as a response. Null urls are left out of the record.
    """
    decided = decide_records(pages, id_col, text_col, params.least)
    chunk, per_file = params.chunk, params.archive_records

    def run(batches):
        writer, path, n = None, "", 0
        for batch in batches:
            for page_id, url, payload, refers in zip(*batch.columns):
                if writer is None:
                    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                    writer, n = ArchiveWriter(path), 0
                page_id, refers = page_id.as_py(), refers.as_py()
                body = memoryview(payload.as_buffer() or b"")
                digest = base32_sha1(hashlib.sha1(body).digest()).encode()
                head = [(b"WARC-Type", b"response" if refers is None else b"revisit"), (b"WARC-Record-ID", record_uri(page_id)),
                        (b"WARC-Date", _DATE), (b"Content-Type", b"application/http; msgtype=response"),
                        (b"WARC-Payload-Digest", b"sha1:" + digest)]
                if url.is_valid:
                    head.append((b"WARC-Target-URI", url.as_py().encode("utf-8", "replace").replace(b"\r", b"%0D").replace(b"\n", b"%0A")))
                if refers is not None:
                    head += [(b"WARC-Refers-To", record_uri(refers)), (b"WARC-Profile", REVISIT_PROFILE),
                             (b"X-Payload-Length", str(len(body)).encode())]
                    body = memoryview(b"")
                writer.write(head, _HTTP, body, chunk)
                n += 1
                if n >= per_file:
                    writer.close()
                    yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])
                    writer = None
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

    return written(decided.mapInArrow(run, "path string, records long"), "manifest")


class _Members:
    """The bytes of a gzip file's members, read a piece at a time."""

    def __init__(self, path: str, piece: int):
        system, place = _place(path)
        self.file, self.piece, self.rest, self.text = system.open_input_stream(place), piece, b"", bytearray()
        self.unpack = zlib.decompressobj(31)

    def fill(self) -> bool:
        """More bytes into ``text``; False at the end of the file."""
        while True:
            if self.unpack.eof:
                self.rest = self.unpack.unused_data or self.rest
                self.unpack = zlib.decompressobj(31)
            raw = self.rest or self.file.read(self.piece)
            self.rest = b""
            if not raw:
                return False
            got = self.unpack.decompress(raw, self.piece)
            self.rest = self.unpack.unconsumed_tail
            if got:
                self.text += got
                return True

    def head(self) -> bytes | None:
        """Up to and with the next blank line; None at the end."""
        while (at := self.text.find(b"\r\n\r\n")) < 0:
            if not self.fill():
                if self.text.strip():
                    raise ValueError("archive ends inside a record header")
                return None
        out = bytes(self.text[:at])
        del self.text[:at + 4]
        return out

    def take(self, n: int) -> bytes:
        """Up to n bytes, at least one."""
        if not self.text and not self.fill():
            raise ValueError("archive ends inside a record")
        out = bytes(self.text[:n])
        del self.text[:n]
        return out


def read_records(path: str, chunk: int):
    """(headers, chunk number, offset, bytes, running SHA-1, last) of every chunk of every record."""
    source = _Members(path, min(chunk, 1 << 18))
    while (head := source.head()) is not None:
        fields = dict(line.split(b": ", 1) for line in head.strip().split(b"\r\n")[1:])
        left = int(fields[b"Content-Length"])
        if fields.get(b"Content-Type", b"").startswith(b"application/http"):
            left -= len(source.head()) + 4  # the payload follows the HTTP header
        digest, number, offset, held = hashlib.sha1(), 0, 0, bytearray()
        while True:
            while len(held) < chunk and left:
                got = source.take(min(left, chunk - len(held)))
                held += got
                left -= len(got)
            digest.update(held)
            yield fields, number, offset, bytes(held), digest.digest(), not left
            number, offset, held = number + 1, offset + len(held), bytearray()
            if not left:
                break
        tail = 4
        while tail:
            tail -= len(source.take(tail))


CHUNK_SCHEMA = ("record_id string, record_type string, url string, refers_to string, payload_digest string, payload_length long, "
                "chunk int, offset long, length long, running_sha1 binary, last boolean")


def read_archives(manifest: DataFrame, params: WarcParams = WarcParams(), with_bytes: bool = True) -> DataFrame:
    """The chunked record table of the manifest's archives: one row per record and chunk.

    ``payload_digest`` and ``payload_length`` are what the record's header states (a revisit has
    no payload of its own); ``running_sha1`` is of the bytes read so far. ``with_bytes`` adds the
    chunk's ``data``. An empty payload has one empty chunk. Memory: one chunk and one batch of
    at most 8 chunks.
    """
    chunk = params.chunk

    def batch_of(rows):
        kinds = [pa.string()] * 5 + [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()] + [pa.binary()] * with_bytes
        names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")] + ["data"] * with_bytes
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for f, number, offset, data, digest, last in read_records(path, chunk):
                    text = lambda k: f[k].decode("utf-8", "replace") if k in f else None
                    stated = text(b"X-Payload-Length")
                    rows.append((text(b"WARC-Record-ID"), text(b"WARC-Type"), text(b"WARC-Target-URI"), text(b"WARC-Refers-To"),
                                 text(b"WARC-Payload-Digest"), None if stated is None else int(stated), number, offset, len(data), digest, last)
                                + ((data,) if with_bytes else ()))
                    size += len(data) * with_bytes + 400
                    if size >= 8 * chunk or len(rows) >= 4096:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    files = manifest.select("path")
    # A number of its own, so that adaptive execution doesn't merge these few short rows into one task.
    return files.repartition(max(1, min(files.count(), MAX_READ_TASKS))).mapInArrow(run, CHUNK_SCHEMA + (", data binary" if with_bytes else ""))


def archive_folder(spark) -> str:
    """A fresh folder for archives under the cluster's shared folder."""
    return scratch_path(spark, "llm-warc")
