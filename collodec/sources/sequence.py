"""Sequence files as a data source: byte ranges that start at sync marks, Arrow batches.

A sequence file is a header, then records (length of record and key, key, value) with a sync
mark, 16 bytes that the header names, every few kilobytes. A partition is a byte range of a
file. It owns the records behind every mark that begins in the range, up to the next mark; the
first range also owns those in front of the first mark. So a range may be cut anywhere, also
in a record or a mark.

Records between two marks form a chain, each telling where the next one starts. The chains of
a stretch of the file are followed side by side: one step moves on to the next record of all
of them. Texts are cut out of the bytes at once; no row passes through Python alone.

Values have to be Text, files uncompressed. Others are refused by name; the Hadoop reader of
``read_ngrams(..., "sequence-hadoop")`` takes any codec that the cluster has, row by row.
Files are listed by Spark and read through pyarrow's file systems, so the store has to be one
that these know (file, hdfs, s3, gs); for others there is the Hadoop reader as well.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
#: Bytes of a range parsed at once; more where no mark is among them.
STRETCH_BYTES = 4 << 20
_ESCAPE = b"\xff\xff\xff\xff"
_SYNC_BYTES = 16
_TEXT = "org.apache.hadoop.io.Text"


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


def _number(data: bytes, at: int) -> tuple[int, int]:
    """(a variable-length number, where it ends)."""
    first = int.from_bytes(data[at : at + 1], "big", signed=True)
    if first >= -112:
        return first, at + 1
    size = -112 - first if first >= -120 else -120 - first
    value = int.from_bytes(data[at + 1 : at + 1 + size], "big")
    return (value if first >= -120 else ~value), at + 1 + size


def _string(data: bytes, at: int) -> tuple[str, int]:
    size, at = _number(data, at)
    return data[at : at + size].decode(), at + size


def read_header(data: bytes, path: str) -> tuple[bytes, int]:
    """(sync mark, where the records start) of a file that starts with ``data``."""
    if data[:3] != b"SEQ" or data[3] != 6:
        raise ValueError(f"{path}: no sequence file of version 6")
    _, at = _string(data, 4)
    value, at = _string(data, at)
    if value != _TEXT:
        raise ValueError(f"{path}: values are {value}, not {_TEXT}")
    if data[at] or data[at + 1]:
        raise ValueError(f"{path}: compressed; read it as 'sequence-hadoop'")
    pairs, at = int.from_bytes(data[at + 2 : at + 6], "big"), at + 6
    for _ in range(2 * pairs):  # names and values that describe the file
        _, at = _string(data, at)
    return data[at : at + _SYNC_BYTES], at + _SYNC_BYTES


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - first, counts)


def _marks(data: bytes, mark: bytes) -> np.ndarray:
    """Where the marks of ``data`` begin; records end there and start behind."""
    found, at = [], data.find(mark)
    while at >= 0:
        found.append(at)
        at = data.find(mark, at + len(mark))
    return np.array(found, np.int64)


def values_of(data: bytes, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of the records in [begin, end), for each of some chains of records."""
    raw = np.frombuffer(data, np.uint8)
    four = np.arange(4)

    def length(at: np.ndarray) -> np.ndarray:
        return raw[at[:, None] + four].copy().view(">i4").reshape(-1).astype(np.int64)

    at, chain = begins.astype(np.int64), np.arange(len(begins))
    chains, starts, sizes = [], [], []
    live = at < ends
    at, chain, stop = at[live], chain[live], ends[live]
    while len(at):
        whole, key = length(at), length(at + 4)
        if (whole < key).any() or (key < 0).any() or (at + 8 + whole > stop).any():
            raise ValueError("a record does not end where the next one starts")
        value = at + 8 + key
        first = raw[value].astype(np.int8).astype(np.int64)
        skip = np.where(first >= -112, 1, np.where(first >= -120, -111 - first, -119 - first))
        chains.append(chain)
        starts.append(value + skip)
        sizes.append(whole - key - skip)
        at = at + 8 + whole
        live = at < stop
        at, chain, stop = at[live], chain[live], stop[live]
    if not chains:
        return pa.array([], pa.string())
    order = np.argsort(np.concatenate(chains), kind="stable")
    start, size = np.concatenate(starts)[order], np.concatenate(sizes)[order]
    offsets = np.concatenate(([0], np.cumsum(size)))
    text = raw[_spread(start, size)]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)]
    return pa.Array.from_buffers(pa.large_string(), len(size), buffers).cast(pa.string())


def read_range(stream, path: str, start: int, end: int, size: int, stretch: int = STRETCH_BYTES) -> Iterator[pa.Array]:
    """The values of the records that a byte range of a file owns."""
    header = stream.read(min(size, 1 << 16))
    sync, first = read_header(header, path)
    mark = _ESCAPE + sync
    at = first if start == 0 else max(start, first - len(mark))
    # In front of the first mark in the range, records are another's, but for the first range.
    open_ = start == 0
    stream.seek(at)
    held = b""
    while True:
        more = stream.read(stretch)
        held += more
        marks = _marks(held, mark)
        beyond = marks[at + marks >= end]
        last = not more or len(beyond) > 0
        marks = marks[at + marks < end]
        cut = int(beyond[0]) if len(beyond) else len(held) if not more else int(marks[-1]) if len(marks) else 0
        inner = marks[marks < cut]
        begins = np.concatenate(([0] if open_ else [], inner + len(mark))).astype(np.int64)
        ends = np.concatenate((inner, [cut]) if open_ else (inner[1:], [cut] if len(inner) else [])).astype(np.int64)
        if len(begins):
            yield values_of(held, begins, ends)
        if last:
            return
        # What is kept starts with a mark, or with records of which no mark has come yet.
        if cut:
            held, at, open_ = held[cut:], at + cut, False
        elif not open_ and not len(marks) and len(held) >= len(mark):
            drop = len(held) - len(mark) + 1
            held, at = held[drop:], at + drop
            if at >= end:
                return


class SequenceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = json.loads(options["files"])
        self.range = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        return [
            Range(path, start, min(start + self.range, size), size)
            for path, size in self.files
            for start in range(0, size, self.range)
        ]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(partition.path)
        with files.open_input_file(path) as stream:
            for values in read_range(stream, path, partition.start, partition.end, partition.size):
                yield pa.RecordBatch.from_arrays([values], ["value"])


class SequenceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "collodec-sequence"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> SequenceReader:
        return SequenceReader(self.options)


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(URI, size) of the data files that a path, a folder or a pattern names, as Spark sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for match in system.globStatus(where) or []:
        inside = system.listStatus(match.getPath()) if match.isDirectory() else [match]
        for status in inside:
            name = status.getPath().getName()
            if status.isFile() and status.getLen() and name[0] not in "._":
                found.append((status.getPath().toString(), status.getLen()))
    if not found:
        raise ValueError(f"{path}: no files")
    return sorted(found)


def read_sequence(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The values of sequence files, one column ``value``."""
    spark.dataSource.register(SequenceSource)
    files = json.dumps(_files(spark, path))
    return spark.read.format(SequenceSource.name()).option("files", files).option("rangebytes", range_bytes).load()
