"""Zip drops: one task per member, read as a stream."""

from __future__ import annotations

import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass
from functools import reduce
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.session import MAX_PARTITIONS, stage
from dropweave.sources.lines import LINE_SCHEMA, relative_name, root_path

BATCH_BYTES = 4 * 1024 * 1024
PACKED_BYTES = 1024 * 1024
DROP_SUFFIXES = (".csv",)
# Signature, version, flags, method, time, date, checksum, both sizes, lengths of name and extra field.
LOCAL_HEADER, HEADER_BYTES = "<4sHHHHHIIIHH", 30

# Functions sent to tasks carry their code along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_uri(uri: str) -> BinaryIO:
    """Open a file of any store pyarrow knows, seekable, from inside a task."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[len("file:"):].lstrip("/"))
    if uri.startswith("s3a:"):
        uri = "s3:" + uri[len("s3a:"):]
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def _line_blocks(stream: BinaryIO, keep_cr: bool) -> Iterator[list[str]]:
    """The lines of a stream, a block at a time.  A newline byte is never part of another character."""
    held: list[bytes] = []
    while block := stream.read(BATCH_BYTES):
        whole, newline, rest = block.rpartition(b"\n")
        if newline:
            yield _split(b"".join((*held, whole)), keep_cr)
            held = []
        held.append(rest)
    if tail := b"".join(held):
        yield _split(tail, keep_cr)


def _split(data: bytes, keep_cr: bool) -> list[str]:
    text = data.decode("utf-8", "replace")
    lines = text.split("\n")
    return lines if keep_cr or "\r" not in text else [line.removesuffix("\r") for line in lines]


@dataclass(frozen=True)
class Member:
    """Where a member lies in its archive, as its directory says."""

    name: str
    size: int
    header: int  # offset of its local header
    packed: int  # bytes it takes there
    method: int
    flags: int
    crc: int


def directory(handle: BinaryIO) -> list[Member]:
    """The members of an open archive, without folders; encrypted ones cannot be read and are a ``ValueError`` when they are."""
    with zipfile.ZipFile(handle) as zipped:
        return [Member(m.filename, m.file_size, m.header_offset, m.compress_size, m.compress_type, m.flag_bits, m.CRC)
                for m in zipped.infolist() if not m.is_dir()]


class MemberStream:
    """The content of one member, read from its own place: nothing else of the archive is touched.  Damage is an error."""

    def __init__(self, handle: BinaryIO, header: int, packed: int, method: int, flags: int, crc: int) -> None:
        handle.seek(header)
        fixed = handle.read(HEADER_BYTES)
        if len(fixed) < HEADER_BYTES or fixed[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile(f"no member begins at byte {header}")
        if flags & 1:
            raise ValueError("the member is encrypted")
        name, extra = struct.unpack(LOCAL_HEADER, fixed)[-2:]
        handle.seek(header + HEADER_BYTES + name + extra)
        self.handle, self.left, self.wanted, self.crc = handle, packed, crc, 0
        if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise NotImplementedError(f"packing method {method}")
        self.unpack = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None

    def _packed(self, size: int) -> bytes:
        data = self.handle.read(min(size, self.left))
        if self.left and not data:
            raise zipfile.BadZipFile("the archive ends inside a member")
        self.left -= len(data)
        return data

    def _unpacked(self, size: int) -> bytes:
        if self.unpack is None:
            return self._packed(size)
        while not self.unpack.eof:
            held = self.unpack.unconsumed_tail or self._packed(PACKED_BYTES)
            data = self.unpack.decompress(held, size)
            if data:
                return data
            if not held and not self.left:
                raise zipfile.BadZipFile("a member ends before its data does")
        return b""

    def read(self, size: int) -> bytes:
        """Up to ``size`` bytes, none at the end only."""
        data = self._unpacked(size)
        self.crc = zlib.crc32(data, self.crc)
        if not data and self.crc != self.wanted:
            raise zipfile.BadZipFile("the checksum of a member is wrong")
        return data


def all_members(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_uri) -> DataFrame:
    """``(archive, member, size, header, packed, method, flags, crc)`` of every file in every archive; reads the directories only."""
    archives = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.zip").load(path).select("path"))

    columns = ["archive", "member", "size", "header", "packed", "method", "flags", "crc"]

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                with opener(archive) as handle:
                    yield pd.DataFrame([(archive, *astuple(m)) for m in directory(handle)], columns=columns)

    return archives.mapInPandas(members, "archive STRING, member STRING, size BIGINT, header BIGINT, packed BIGINT, method INT, flags INT, crc BIGINT")


def _is_drop(suffixes: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (F.lower("member").endswith(s) for s in suffixes))


def list_members(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_uri,
                 suffixes: tuple[str, ...] = DROP_SUFFIXES) -> DataFrame:
    """The members that are drops, as in ``all_members`` with ``source_file``: ``archive!member`` under the root."""
    name = F.concat(relative_name(F.col("archive"), root_path(spark, path)), F.lit("!"), "member")
    return all_members(spark, path, opener).filter(_is_drop(suffixes)).withColumn("source_file", name)


def other_members(spark: SparkSession, path: str, opener: Callable[[str], BinaryIO] = open_uri,
                  suffixes: tuple[str, ...] = DROP_SUFFIXES) -> DataFrame:
    """The members no job reads, such as notes beside the data, as in ``all_members``."""
    return all_members(spark, path, opener).filter(~_is_drop(suffixes))


def member_files(members: DataFrame) -> DataFrame:
    """Members in the columns of ``list_files``."""
    return members.select("source_file", F.concat("archive", F.lit("!"), "member").alias("part"))


def read_zip(spark: SparkSession, path: str, keep_cr: bool = False, only: DataFrame | None = None,
             opener: Callable[[str], BinaryIO] = open_uri) -> DataFrame:
    """Lines of all members, in the same columns as ``read_lines``.

    A member with a drop's suffix counts as a source file, as if it had been unpacked beside its archive.  Members are spread over
    tasks of their own, found by the offsets of the listing (so the directory of an archive is read once, not once for each member), and
    streamed, so neither the size of an archive nor that of a member is bounded by memory.  ``only`` restricts the scan to the source files it names.
    """
    listed = list_members(spark, path, opener)
    if only is not None:
        listed = listed.join(only.select("source_file").distinct(), "source_file", "left_semi").select(*listed.columns)
    members = stage(listed, "members")
    tasks = max(1, min(members.count(), MAX_PARTITIONS))
    schema = pa.schema([("source_file", pa.string()), ("part", pa.string()), ("block", pa.int64()),
                        ("pos", pa.int64()), ("value", pa.string())])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, member, name, *place in zip(*(batch[c].to_pylist() for c in (
                    "archive", "member", "source_file", "header", "packed", "method", "flags", "crc"))):
                part = f"{archive}!{member}"
                with opener(archive) as handle:
                    stream = MemberStream(handle, *place)
                    first = 0
                    for values in _line_blocks(stream, keep_cr):
                        n = len(values)
                        yield pa.record_batch(
                            [pa.repeat(name, n), pa.repeat(part, n), pa.repeat(pa.scalar(0, pa.int64()), n),
                             pa.array(np.arange(first, first + n, dtype="int64")), pa.array(values, pa.string())],
                            schema=schema)
                        first += n

    # Dealt out in turn: hashing a short list of names would leave many tasks empty.
    return members.repartition(tasks).mapInArrow(lines, LINE_SCHEMA)
