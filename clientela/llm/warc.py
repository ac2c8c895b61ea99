"""Web archives written and read back as a table of chunks."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.skew import share_count
from clientela.llm.common import Batches, arrow_batch
from clientela.session import materialise, new_folder

CHUNK = 1 << 20
# Payloads below this many bytes are always written out.
REVISIT_FROM = 100
# A new archive file starts beyond this many bytes of payload.
FILE_BYTES = 1 << 30
# Rows handed on at a time hold about so many payload bytes.
BATCH_BYTES = 8 << 20
MOST_HEADER = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def open_fs(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a URI such as the shared folder's (file, hdfs, s3, gs)."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def with_types(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """``page, url, payload, size, digest, first``: ``first`` is the page a revisit refers to, else null.

    Digests are counted on the map side; the table of repeated payloads is dealt anew before it meets the pages, so a
    payload that a third of all pages share is split by adaptive execution.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.col("size") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first is not null")
        .select("digest", "first")
        .repartition("first")
    )
    met = rows.join(repeated, "digest", "left")
    return met.withColumn("first", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")))


def head_of(page: int | None, url: str | None, size: int, digest: str, first: int | None, date: str) -> bytes:
    """WARC and HTTP header blocks of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{page}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if first is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{first}>", f"WARC-Profile: {PROFILE}"]
    block = len(http) + (size if first is None else 0)
    lines.append(f"Content-Length: {block}")
    return "\r\n".join(lines).encode() + END + http


class ArchiveWriter:
    """One file of gzip members, one member for each record, fed chunk by chunk."""

    def __init__(self, folder: str):
        files, path = open_fs(folder)
        files.create_dir(path, recursive=True)
        # Attempts never share a name; only files of a finished task are in the list of archives.
        name = f"{uuid.uuid4().hex}.warc.gz"
        self.uri = f"{folder}/{name}"
        self.stream = files.open_output_stream(f"{path}/{name}", compression=None)
        self.written = 0
        self.member = None

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.add(head)

    def add(self, data: bytes) -> None:
        self.written += len(data)
        self.stream.write(self.member.compress(data))

    def end(self) -> None:
        self.add(END)
        self.stream.write(self.member.flush())

    def close(self) -> None:
        self.stream.close()


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK, date: str = DATE
) -> DataFrame:
    """Write a record per row into archives below ``folder``; returns the list of archives, ``path, records``.

    Payloads are cut into chunk rows by Spark and streamed into the file, so no Python process holds a whole one. Of
    rows with equal payloads of at least 100 bytes those with the smallest page id are responses and the others
    revisits of it; all smaller ones are responses. Null html is an empty payload, a null url leaves its header out, a
    row with a null id is a response unless an equal payload has an id. Repeated rows are written each. Other columns
    are ignored.
    """
    rows = with_types(pages, key, url, html)
    kept = F.when(F.col("first").isNull(), F.col("size")).otherwise(F.lit(0).cast("long"))
    last = F.greatest(F.lit(0).cast("long"), F.floor((kept - 1) / chunk))
    rows = rows.withColumn("last", last).withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    part = F.when(F.col("first").isNull(), F.substring("payload", (F.col("number") * chunk + 1).cast("int"), F.lit(chunk)))
    chunks = rows.select("page", "url", "size", "digest", "first", "number", "last", part.alias("data"))

    def write(batches: Batches):
        writer, records = None, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            data = batch.column(7)
            for i in range(batch.num_rows):
                page, link, size, digest, first, number, final = [c[i].as_py() for c in columns]
                if number == 0:
                    if writer is not None and writer.written > FILE_BYTES:
                        writer.close()
                        yield arrow_batch(["path", "records"], [[writer.uri], pa.array([records], pa.int64())])
                        writer, records = None, 0
                    writer = writer or ArchiveWriter(folder)
                    writer.begin(head_of(page, link, size, digest, first, date))
                    records += 1
                writer.add(data[i].as_py() or b"")
                if number == final:
                    writer.end()
        if writer is not None:
            writer.close()
            yield arrow_batch(["path", "records"], [[writer.uri], pa.array([records], pa.int64())])

    return materialise(chunks.mapInArrow(write, "path string, records long"), "archives")


class MemberReader:
    """Bytes of a gzip file of many members, unpacked piece by piece."""

    def __init__(self, stream):
        self.stream, self.buffer, self.rest = stream, b"", b""
        self.member = zlib.decompressobj(31)

    def fill(self) -> bool:
        """Unpack a little more; false at the end of the file."""
        data = self.member.unconsumed_tail or self.rest or self.stream.read(1 << 18)
        self.rest = b""
        if not data:
            return False
        self.buffer += self.member.decompress(data, 1 << 18)
        if self.member.eof:
            self.rest = self.member.unused_data
            self.member = zlib.decompressobj(31)
        return True

    def head(self) -> bytes:
        """Up to and with the next empty line; empty at the end of the file."""
        while END not in self.buffer:
            if len(self.buffer) > MOST_HEADER:
                raise ValueError("archive header without end")
            if not self.fill():
                if self.buffer:
                    raise ValueError("archive ends within a header")
                return b""
        head, _, self.buffer = self.buffer.partition(END)
        return head + END

    def take(self, size: int) -> bytes:
        parts = []
        while size:
            if not self.buffer and not self.fill():
                raise ValueError("archive ends within a record")
            part, self.buffer = self.buffer[:size], self.buffer[size:]
            parts.append(part)
            size -= len(part)
        return b"".join(parts)


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if name}


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def records_of(reader: MemberReader, chunk: int) -> Iterator[tuple]:
    """Chunk rows of an archive: each carries the digest and the bytes of its record so far."""
    while head := reader.head():
        if not head.startswith(b"WARC/"):
            raise ValueError("no archive record where one should start")
        fields = fields_of(head)
        left = int(fields["content-length"])
        http = reader.head()
        left -= len(http)
        promised = int(fields_of(http)["content-length"])
        kind = fields["warc-type"]
        told = fields["warc-payload-digest"].removeprefix("sha256:")
        page, refers = page_of(fields["warc-record-id"]), page_of(fields.get("warc-refers-to"))
        digest, seen, number = hashlib.sha256(), 0, 0
        while True:
            data = reader.take(min(chunk, left))
            left -= len(data)
            seen += len(data)
            digest.update(data)
            final = not left
            if final and kind == "response" and (digest.hexdigest() != told or seen != promised):
                raise ValueError(f"payload of page {page} differs from its header")
            yield page, fields.get("warc-target-uri"), kind, refers, number, data, digest.hexdigest(), seen, final, told, promised
            number += 1
            if final:
                break
        if reader.take(len(END)) != END:
            raise ValueError("archive record without end")


RECORDS = (
    "page long, url string, type string, refers_to long, number int, data binary, digest_so_far string, "
    "bytes_so_far long, last boolean, payload_digest string, payload_bytes long"
)


def read_archives(spark: SparkSession, archives: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the archives listed in column ``path``.

    One row per record and chunk, with the SHA-256 and the byte count of the payload up to its end. A response whose
    payload differs from the digest in its header fails the job. ``payload_digest`` and ``payload_bytes`` are the
    header's, which for a revisit describe the payload it refers to. A record without payload has one empty chunk.
    """
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[part.split()[1]] for part in RECORDS.split(", ")]

    def read(batches: Batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = open_fs(path)
                held, rows = 0, []
                with files.open_input_stream(name, compression=None) as stream:
                    for row in records_of(MemberReader(stream), chunk):
                        rows.append(row)
                        held += len(row[5]) + 500
                        if held >= BATCH_BYTES:
                            yield arrow_batch(names, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)])
                            held, rows = 0, []
                if rows:
                    yield arrow_batch(names, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)])

    # Files are the unit of work, dealt by ranges of their names: as many reading tasks as archives or partitions,
    # whichever is fewer. A hash by path would meet that of ``distinct``, and adaptive execution join all in one task.
    paths = archives.select("path").distinct().repartitionByRange(share_count(archives), "path")
    return paths.mapInArrow(read, RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as archives in a new folder of the shared space, read them back as chunks."""
    return read_archives(spark, write_archives(pages, folder or new_folder(spark, "warc"), **columns))


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: ``page, payload_bytes, payload_digest, record_type, refers_to``.

    The last chunk of a response carries digest and size of all that was read.
    """
    read = F.col("type") == "response"
    return chunks.where("last").select(
        "page",
        F.when(read, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(read, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )
