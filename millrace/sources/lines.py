"""Lines of files with their byte offsets: a Python data source.

A line is known by (file, offset of its first byte), whatever the split size, the
cores or the order of the tasks. Files are cut by bytes: a split holds the lines
that start in it and reads on to the end of the last one, so each byte is read once
and no line is counted first. Compressed files are one split, their offsets
count unpacked bytes. Files are opened by pyarrow (local paths, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a split, and what opening one more file counts for when small files share a split.
SPLIT_BYTES = 128 << 20
OPEN_BYTES = 4 << 20
#: Text of one Arrow batch; a longer line is a batch of its own.
BATCH_BYTES = 1 << 20

_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
_BOM = b"\xef\xbb\xbf"
_SCHEMA = "source_path string, source_mtime timestamp, offset long, line binary"
_ARROW = pa.schema([("source_path", pa.string()), ("source_mtime", pa.timestamp("us", "UTC")), ("offset", pa.int64()),
                    ("line", pa.binary())])


@dataclass
class Range:
    """The lines of a file that start at ``start`` or later and before ``end`` (None: to the end)."""
    path: str
    mtime: int
    start: int
    end: int | None


@dataclass
class Split(InputPartition):
    ranges: list[Range]


def splits(files: list[tuple[str, int, int]], split_bytes: int) -> list[Split]:
    """Files (path, size, modification time in microseconds) as splits of about ``split_bytes``."""
    ranges = []
    for path, size, mtime in sorted(files):
        if path.endswith(_COMPRESSED):
            ranges.append((size, Range(path, mtime, 0, None)))
            continue
        ranges += [(min(split_bytes, size - s), Range(path, mtime, s, min(size, s + split_bytes)))
                   for s in range(0, size, split_bytes)]
    out: list[Split] = []
    room = 0
    for size, part in ranges:
        cost = size + OPEN_BYTES
        if out and cost <= room:
            out[-1].ranges.append(part)
            room -= cost
        else:
            out.append(Split([part]))
            room = split_bytes - cost
    return out


def _open(path: str):
    """A buffered reader of a file as Spark names it (an encoded URI), or of a local path."""
    if path.startswith("/"):
        system, name = pafs.LocalFileSystem(), path
    elif path.startswith("file:"):
        system, name = pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", unquote(path))
    else:
        system, name = pafs.FileSystem.from_uri(path)
    if name.endswith(_COMPRESSED):
        return io.BufferedReader(system.open_input_stream(name, compression="detect"), BATCH_BYTES)
    return io.BufferedReader(system.open_input_file(name), BATCH_BYTES)


def _lines(part: Range) -> Iterator[tuple[int, bytes]]:
    """(offset, line without its end) of the lines that start in the range."""
    with _open(part.path) as stream:
        at = part.start
        if at:
            # the line that the byte before belongs to is the range before's
            stream.seek(at - 1)
            at += len(stream.readline()) - 1
        while part.end is None or at < part.end:
            line = stream.readline()
            if not line:
                return
            yield at, (line[len(_BOM):] if at == 0 and line.startswith(_BOM) else line).rstrip(b"\r\n")
            at += len(line)


class _Reader(DataSourceReader):
    def __init__(self, files: list, split_bytes: int):
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> list[Split]:
        # Spark asks for one partition at least
        return splits([tuple(f) for f in self.files], self.split_bytes) or [Split([])]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges:
            at, lines, held = [], [], 0
            for offset, line in _lines(part):
                if not line.strip():
                    continue
                if lines and held + len(line) > BATCH_BYTES:
                    yield self._batch(part, at, lines)
                    at, lines, held = [], [], 0
                at.append(offset)
                lines.append(line)
                held += len(line)
            if lines:
                yield self._batch(part, at, lines)

    @staticmethod
    def _batch(part: Range, at: list, lines: list) -> pa.RecordBatch:
        n = len(at)
        return pa.record_batch([pa.array([part.path] * n, pa.string()),
                                pa.array([part.mtime] * n, pa.timestamp("us", "UTC")),
                                pa.array(at, pa.int64()), pa.array(lines, pa.binary())], schema=_ARROW)


class LineSource(DataSource):
    """``spark.read.format('line_offsets')``; options ``files`` (JSON of path, size, time) and ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "line_offsets"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ARG002 - the schema is fixed
        return _Reader(json.loads(self.options["files"]), int(self.options["split_bytes"]))


def read_lines(spark: SparkSession, paths, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``source_path``, ``source_mtime``, ``offset`` and ``line`` of every line that is not blank.

    ``paths`` are files, folders or patterns; Spark lists them (only names, sizes and
    times reach the driver). A line ends with a line feed, a carriage return
    before it goes; the mark of UTF-8 at the start of a file goes too. A file named twice is
    read once; files without a line give no rows.
    """
    found = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"), "length", F.unix_micros("modificationTime").alias("mtime"))
    files = [(r["path"], r["length"], r["mtime"]) for r in found.distinct().collect()]
    spark.dataSource.register(LineSource)
    return (spark.read.format("line_offsets").option("files", json.dumps(files))
            .option("split_bytes", str(split_bytes)).load().withColumn("line", F.col("line").cast("string")))
