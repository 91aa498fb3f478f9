"""Telling absent and damaged files from reads that failed in passing.

A tolerant read may leave out a file only for what is wrong with the file itself. Whether a
compressed file can be decoded to its end is found out for all files in one job, from their
bytes; lost executors, lost connections, full memory and missing rights are never taken for that.
"""

from __future__ import annotations

import bz2
import gzip
import io
import re
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKED_BYTES = 64 * 1024 * 1024
"""Larger compressed files are not decoded in one row but read alone, one job each."""
CHUNK = 1 << 20

# Spark's error conditions for a path that is not there and a file not read to its end.
ABSENT = ("PATH_NOT_FOUND", "FAILED_READ_FILE.FILE_NOT_EXIST")
UNREAD = "FAILED_READ_FILE"
# Fixed value: Java's exceptions of decoders that meet damaged data, by class or message.
DECODER = re.compile(
    r"java\.io\.EOFException|java\.util\.zip\.|CRC failure|unexpected end of|not a gzip"
    r"|incorrect header|bad block header|crc error"
)


def fault(error: Exception) -> str | None:
    """``absent``, ``unread`` (some file, for whatever reason), or None for any other failure."""
    if not isinstance(error, (PySparkException, Py4JJavaError)):
        return None
    found = re.search(r"\[([A-Z_]+(?:\.[A-Z_]+)?)\]", str(error))
    condition = found.group(1) if found else ""
    if condition in ABSENT:
        return "absent"
    return "unread" if condition.split(".")[0] == UNREAD else None


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str = "*") -> DataFrame:
    """The files below some folders as a catalogue: (dataset, position, name, path, length).

    A folder is a dataset and its files come in the order of their names. Only the listing is
    read, not the files, and it is a table like any other: it is filtered and ranked by tasks.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(paths if isinstance(paths, str) else list(paths))
    )
    steps = F.split("path", "/")
    name = F.element_at(steps, -1)
    return files.select(
        F.try_element_at(steps, F.lit(-2)).alias("dataset"),
        name.alias("position"),
        name.alias("name"),
        "path",
        "length",
    )


def sort_files(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """The files below ``paths`` (which exist): those sound and those damaged.

    Text without compression has no damage that a reader could see. Compressed files are decoded
    in one job, a task holding the bytes of a few at a time. Files that are larger than
    CHECKED_BYTES or of another codec are read alone; only a decoder's error makes them damaged.
    """
    listed = [(r["path"], r["length"]) for r in list_files(spark, paths).collect()]
    packed = [(p, n) for p, n in listed if re.search(r"\.(gz|bz2|deflate|zst|snappy|lz4)$", p)]
    small = [p for p, n in packed if n <= CHECKED_BYTES and p.endswith(tuple(READERS))]
    damaged = set()
    if small:
        files = spark.read.format("binaryFile").load(small).select("path", "content")
        damaged |= {r["path"] for r in files.mapInArrow(_damaged, "path string").collect()}
    for path in sorted({p for p, _ in packed} - set(small)):
        try:
            spark.read.option("ignoreCorruptFiles", False).text(path).agg(
                F.max(F.length("value"))
            ).collect()
        except (PySparkException, Py4JJavaError) as error:
            if fault(error) != "unread" or not DECODER.search(str(error)):
                raise
            damaged.add(path)
    return [p for p, _ in listed if p not in damaged], sorted(damaged)


class _Deflated(io.RawIOBase):
    """Reads a zlib stream."""

    def __init__(self, raw: io.BytesIO) -> None:
        self.raw, self.state = raw, zlib.decompressobj()

    def read(self, size: int = -1) -> bytes:
        while not self.state.eof:
            data = self.state.unconsumed_tail or self.raw.read(CHUNK)
            if not data:
                raise EOFError("the stream ends too early")
            if out := self.state.decompress(data, CHUNK):
                return out
        return b""


READERS = {".gz": gzip.GzipFile, ".bz2": bz2.BZ2File, ".deflate": _Deflated}


def can_be_decoded(path: str, content: bytes | memoryview) -> bool:
    """Is a compressed file whole? Only a piece of what it decodes to is held at a time."""
    make = next(make for ending, make in READERS.items() if path.endswith(ending))
    raw = io.BytesIO(content)
    if not len(content):
        return False
    try:
        stream = make(fileobj=raw) if make is gzip.GzipFile else make(raw)
        while stream.read(CHUNK):
            pass
    except (EOFError, OSError, zlib.error):
        return False
    return True


def _damaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            path = batch.column("path")[row].as_py()
            if not can_be_decoded(path, batch.column("content")[row].as_buffer()):
                yield pa.RecordBatch.from_pydict({"path": [path]})


def same_names(files: Sequence[str], given: Sequence[str]) -> list[str]:
    """The names under which files were given, where they were; else their full names."""

    def plain(path: str) -> str:
        return re.sub(r"^\w+:/*(?=/)", "", unquote(path))

    names = {plain(p): p for p in given}
    return [names.get(plain(f), f) for f in files]
