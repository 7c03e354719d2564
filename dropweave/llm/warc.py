"""WARC files: a writer that stores equal payloads once, and a reader that splits files anywhere.

Writing.  Every row becomes a gzip member.  Of equal payloads of at least ``min_revisit`` bytes the row with the largest id is
stored as a response; the others are revisits that name it.  Rows that share that largest id are all responses.  A task
writes a file of its own name per attempt; the table of files holds those of the attempts that Spark committed,
and only these are read.

Reading.  A file is cut into byte ranges.  The task of a range looks for the magic of a gzip member, decodes the candidate's
first bytes and takes it only if they are the head of a WARC record and the whole member decodes with a right checksum
and is followed by another member or the end of the file.  From there it goes from member to member and owns the
records that start inside its range; the last may end beyond.  Compressed bytes that look like a magic fail these tests.

A null payload is written as an empty one; a null url as none.  A null id is not allowed, as records name each other by it.
"""

from __future__ import annotations

import base64
import hashlib
import os
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.session import stage, staging_path
from dropweave.sources.archives import open_uri

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 * 1024 * 1024
BLOCK_BYTES = 1024 * 1024
MIN_REVISIT = 1000
HEAD_BYTES = 64
FILES = "path string, records long, bytes long"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
           "payload binary, path string, offset long")


def plan(pages: DataFrame, id_column: str, payload: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` with ``_digest`` and ``_first``, the id of the row that stores an equal payload (null: this row does).

    Ids are counted per digest before the shuffle, and only digests of several rows take part in the join, so a payload that
    fills a third of the table is one row on one side and splits on the other.
    """
    content = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"_digest": F.sha1(content), "_long": F.octet_length(content) >= min_revisit})
    stored = (rows.filter("_long").groupBy("_digest").agg(F.max(id_column).alias("_last"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").select("_digest", "_last", F.lit(True).alias("_long")))
    return rows.join(stored, ["_digest", "_long"], "left").withColumn(
        "_first", F.when(F.col("_last") != F.col(id_column), F.col("_last")))


def _create(uri: str):
    from pyarrow import fs
    if uri.startswith("file:") or uri.startswith("/"):
        path = "/" + uri.removeprefix("file:").lstrip("/")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return fs.LocalFileSystem().open_output_stream(path, compression=None)
    store, path = fs.FileSystem.from_uri("s3:" + uri[4:] if uri.startswith("s3a:") else uri)
    return store.open_output_stream(path, compression=None)


def _sha1(digest_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record(page_id: int, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: {_sha1(digest)}"]
    if url is not None:
        # Control characters and blanks would break the line; the escape itself is escaped, so reading gives the url back.
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~", errors="surrogatepass"))
    if first is not None:
        head += [f"WARC-Refers-To: <urn:page:{first}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if first is not None else http + payload
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode()
    return packer.compress(text + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", payload: str = "html",
          min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archives under ``folder`` and return the staged table of their files."""
    rows = plan(pages, id_column, payload, min_revisit).select(
        F.col(id_column).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "utf-8").alias("payload"), F.col("_digest").alias("digest"),
        F.col("_first").cast("long").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                out = out or _create(path)
                member = record(*row)
                out.write(member)
                records, size = records + 1, size + len(member)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    return stage(rows.mapInArrow(run, FILES), "warc-files")


class Window:
    """Bytes of a file from any place, read in blocks and let go once passed."""

    def __init__(self, file, start: int) -> None:
        self.file, self.start, self.data, self.done = file, start, bytearray(), False
        file.seek(start)

    def more(self) -> bool:
        block = b"" if self.done else self.file.read(BLOCK_BYTES)
        self.done = not block
        self.data += block
        return not self.done

    def drop(self, until: int) -> None:
        if until - self.start >= BLOCK_BYTES:
            del self.data[:until - self.start]
            self.start = until


def _member(window: Window, at: int) -> tuple[bytes, int] | None:
    """Content and end of the member that begins at ``at``; None if there is no whole valid WARC record."""
    unpack, parts, place, checked = zlib.decompressobj(31), [], at - window.start, False
    got = 0
    while not unpack.eof:
        if place >= len(window.data) and not window.more():
            return None
        fed = window.data[place:place + (65536 if checked else 512)]
        try:
            parts.append(unpack.decompress(fed))
        except zlib.error:
            return None
        place += len(fed)
        got += len(parts[-1])
        if not checked and got >= HEAD_BYTES:
            checked = True
            if not b"".join(parts).startswith(b"WARC/1."):
                return None
    content = b"".join(parts)
    if not content.startswith(b"WARC/1."):
        return None
    return content, window.start + place - len(unpack.unused_data)


def _follows(window: Window, at: int) -> bool:
    """Whether the file ends at ``at`` or another member begins there."""
    while len(window.data) - (at - window.start) < len(MAGIC) and window.more():
        pass
    rest = window.data[at - window.start:at - window.start + len(MAGIC)]
    return rest in (b"", MAGIC)


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the records that start in ``[start, end)``."""
    window, at, chained = Window(file, start), start, False
    while at < end:
        if not chained:
            found = window.data.find(MAGIC, at - window.start)
            if found < 0:
                at = max(at, window.start + len(window.data) - len(MAGIC) + 1)
                window.drop(at)
                if not window.more():
                    return
                continue
            at = window.start + found
            if at >= end:
                return
        member = _member(window, at)
        if member is None or not _follows(window, member[1]):
            at, chained = at + 1, False
            continue
        yield at, member[0]
        at, chained = member[1], True
        window.drop(at)


def parse(content: bytes) -> dict:
    """Fields of a record.  The payload of a revisit is null; its size is that of the response it stands for."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    number = [name.removeprefix("<urn:page:").removesuffix(">") for name in (fields["WARC-Record-ID"], fields.get("WARC-Refers-To", ""))]
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != stated:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    length = next(int(line[16:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    uri = fields.get("WARC-Target-URI")
    return {"page_id": int(number[0]), "url": None if uri is None else urllib.parse.unquote(uri, errors="surrogatepass"),
            "record_type": kind, "refers_to": int(number[1]) if number[1] else None, "payload_digest": stated,
            "payload_bytes": length, "payload": payload if kind == "response" else None}


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """The records of the files in a table with ``path`` and ``bytes``; without ``payload`` that column is null."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    splits = files.select("path", F.explode(starts).alias("start"))
    number = splits.count()
    splits = splits.repartition(max(1, min(number, 100_000)), F.xxhash64("path", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "offset": pa.int64(), "payload": pa.binary()}
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with open_uri(path) as file:
                    rows, held = [], 0
                    for offset, content in members(file, start, start + split_bytes):
                        row = {**parse(content), "path": path, "offset": offset}
                        if not payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > BLOCK_BYTES * 4:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, types)

    return splits.mapInArrow(run, RECORDS)


def _batch(rows: list[dict], names: list[str], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names})


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` and read the records back, without payloads; staged.  A file that gives back fewer records than went in is an error."""
    files = write(pages, folder or staging_path(spark, "warc"))
    return complete(files, stage(read(spark, files, payload=False), "records"))


def complete(files: DataFrame, found: DataFrame) -> DataFrame:
    """``found``, if it has as many records of each file as its writer counted.

    The reader passes over what is no whole valid record, as it has to between members; so a damaged or cut member shows in the counts only.
    """
    lost = files.join(found.groupBy("path").agg(F.count(F.lit(1)).alias("_read")), "path", "left").filter(
        F.coalesce("_read", F.lit(0)) != F.col("records")).first()
    if lost:
        raise ValueError(f"{lost.path} holds {lost.records} records, of which {lost._read or 0} can be read")
    return found
