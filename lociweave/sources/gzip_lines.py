"""Lines of gzip files, read in parallel byte ranges where the file is block-gzipped.

A block-gzipped file is a row of small gzip members whose headers tell their
size, so a reader can start at any byte, look for the next header and go on
from there. A line belongs to the range in whose blocks the line break before
it stands; a range reads on into the next one to finish its last line. Plain
gzip and plain text are read by the first range alone.

Each range closes with one row without a value: how many lines it gave, the
seconds it worked and, where errors are reported rather than raised, what was
wrong. So one corrupt file neither stops the others nor goes unnoticed.
"""

from __future__ import annotations

import json
import re
import sys
import time
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Ship this module inside the task, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "path string, value string, n_lines long, seconds double, error string"
RANGE_BYTES = 32 << 20
#: Fixed values of the format: a block is 64 KB at most; its header names its size under ``BC``.
MOST_BLOCK = 1 << 16
MAGIC = b"\x1f\x8b\x08\x04"
CHUNK = 1 << 20
BATCH_LINES = 20_000


class File(NamedTuple):
    path: str
    length: int


def _opened(path: str):
    """Random-access input file on whatever filesystem the path names."""
    from pyarrow import fs

    plain = re.sub(r"^file:/+", "/", path)
    if plain.startswith("/"):
        return fs.LocalFileSystem().open_input_file(plain)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def block_size(head: bytes) -> int | None:
    """Size of the block whose first bytes are ``head``; None where no block starts."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    extra = head[12:12 + int.from_bytes(head[10:12], "little")]
    while len(extra) >= 4:
        size = int.from_bytes(extra[2:4], "little")
        if extra[:2] == b"BC" and size == 2 and len(extra) >= 6:
            return int.from_bytes(extra[4:6], "little") + 1
        extra = extra[4 + size:]
    return None


def first_block(file, low: int, size: int) -> int | None:
    """Offset of the first block at or after ``low``; a header counts where another or the end follows its block."""
    if low >= size:
        return None
    data = file.read_at(min(size - low, 3 * MOST_BLOCK), low)
    at = data.find(MAGIC)
    while 0 <= at < MOST_BLOCK:
        own = block_size(data[at:at + MOST_BLOCK])
        if own is not None and (low + at + own == size or block_size(data[at + own:at + own + MOST_BLOCK]) is not None):
            return low + at
        at = data.find(MAGIC, at + 1)
    if low + MOST_BLOCK < size:
        raise ValueError(f"no block header after byte {low}")
    return None


def blocks(file, low: int, size: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, text)`` of every block from the first at or after ``low`` to the end of the file."""
    at = first_block(file, low, size)
    held, start = b"", at
    while at is not None and at < size:
        if at + MOST_BLOCK > start + len(held) and start + len(held) < size:
            held, start = file.read_at(min(size - at, CHUNK), at), at
        own = block_size(held[at - start:at - start + MOST_BLOCK])
        if own is None:
            raise ValueError(f"no block header at byte {at}")
        block = held[at - start:at - start + own]
        if len(block) < own:
            raise EOFError(f"the block at byte {at} is cut off")
        yield at, zlib.decompress(block, wbits=31)
        at += own


def members(file, size: int) -> Iterator[bytes]:
    """Text of a plain gzip file, one member after the other, or the bytes of a file that is no gzip."""
    at, unzip, plain = 0, None, None
    while at < size:
        data = file.read_at(min(CHUNK, size - at), at)
        at += len(data)
        if plain is None:
            plain = not data.startswith(b"\x1f\x8b")
        if plain:
            yield data
            continue
        while data:
            if unzip is None:
                data = data.lstrip(b"\0")
                if not data:
                    break
                unzip = zlib.decompressobj(wbits=31)
            yield unzip.decompress(data)
            data = unzip.unused_data
            if unzip.eof:
                unzip = None
    if unzip is not None:
        raise EOFError("the last gzip member is cut off")


def lines_of(file, low: int, high: int, size: int) -> Iterator[list[bytes]]:
    """The lines that belong to a byte range, some at a time."""
    in_blocks = size > 0 and block_size(file.read_at(min(size, MOST_BLOCK), 0)) is not None
    if not in_blocks and low > 0:
        return
    parts = blocks(file, low, size) if in_blocks else ((0, text) for text in members(file, size))
    skipping, rest = low > 0, []
    for start, text in parts:
        if in_blocks and start >= high:
            end = text.find(b"\n")
            if skipping:
                return
            rest.append(text if end < 0 else text[:end])
            if end >= 0:
                yield [b"".join(rest)]
                return
            continue
        if skipping:
            end = text.find(b"\n")
            if end < 0:
                continue
            text, skipping = text[end + 1:], False
        first, *more = text.split(b"\n")
        rest.append(first)
        if more:
            yield [b"".join(rest), *more[:-1]]
            rest = [more[-1]]
    if any(rest):
        yield [b"".join(rest)]


class _Range(InputPartition):
    def __init__(self, file: File, low: int, high: int):
        super().__init__(None)
        self.path, self.length, self.low, self.high = file.path, file.length, low, high


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files = [File(*f) for f in json.loads(options["files"])]
        self.range_bytes = int(options["rangeBytes"])
        self.report = options["errors"] == "report"

    def partitions(self) -> list[InputPartition]:
        return [
            _Range(f, low, min(f.length, low + self.range_bytes))
            for f in self.files for low in range(0, max(1, f.length), self.range_bytes)
        ]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        names = ["path", "value", "n_lines", "seconds", "error"]
        types = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string()]

        def batch(values: list, *closing) -> pa.RecordBatch:
            n = len(values)
            columns = [[part.path] * n, values, *([c] * n for c in closing or (None, None, None))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        n, worked, started, error, held = 0, 0.0, time.perf_counter(), None, []
        try:
            with _opened(part.path) as file:
                for lines in lines_of(file, part.low, part.high, part.length):
                    held += b"\n".join(lines).decode("utf-8", "replace").split("\n")
                    if len(held) >= BATCH_LINES:
                        n += len(held)
                        worked += time.perf_counter() - started
                        yield batch([v.removesuffix("\r") for v in held])
                        started, held = time.perf_counter(), []
        except (zlib.error, EOFError, OSError, ValueError) as wrong:
            error = f"bytes {part.low} to {part.high}: {wrong}"
            if not self.report:
                raise RuntimeError(f"{part.path}, {error}") from wrong
        n += len(held)
        if held:
            yield batch([v.removesuffix("\r") for v in held])
        worked += time.perf_counter() - started
        yield batch([None], n, worked, error)


class GzipLines(DataSource):
    """Batch source over a given list of files."""

    @classmethod
    def name(cls) -> str:
        return "lociweave_gzip_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def listed_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, name, length, modified`` of the files of a folder or of one file; their content is not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).selectExpr(
        "path", "element_at(split(path, '/'), -1) as name", "length", "modificationTime as modified"
    )


def gzip_lines(spark: SparkSession, files: list[File], errors: str = "raise", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, value`` of every line, and the closing row of each range (see ``SCHEMA``).

    ``errors`` is ``raise``, or ``report`` to have what is wrong with a file in
    its closing rows. A range is one task; ranges of an empty list give no row.
    """
    spark.dataSource.register(GzipLines)
    if not files:
        return spark.createDataFrame([], SCHEMA)
    given = json.dumps([[f.path, f.length] for f in files])
    return spark.read.format(GzipLines.name()).options(files=given, rangeBytes=range_bytes, errors=errors).load()
