"""Gzip files of text lines that many tasks read and write.

The writer closes a gzip member every few MB, at the end of a line, and marks each with an extra
field in its header.  Any gzip reader takes such a file; here a task owns the marked members that
start in its byte range.  A member without the mark belongs with the one before it, so files that were
put together by concatenation stay whole, and a file that does not begin with a mark (what other
programs write) is read by one task.

Files are opened in the tasks by pyarrow, so they must be in a store that it knows: a folder that all
executors share, HDFS or an object store.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from linkrank.sources.crawl import named_paths

FORMAT = "split_gzip"
LINES = "value string, file string"

# The magic number and the header of a marked member: deflate, an extra field, no time,
# an unknown system, and the field "LM" without content.
MAGIC = b"\x1f\x8b"
MARK = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x04\x00LM\x00\x00"

# ASCII signs that a URI does not hold.
ILLEGAL = ' "%<>[]\\^`{|}#?'

#: Bytes of text after which a member is closed.
MEMBER_BYTES = 4 << 20
#: Compressed bytes of a task.
RANGE_BYTES = 64 << 20
#: Text of a file that a task writes before it begins another.
FILE_BYTES = 4 << 30

_READ = 1 << 20
_ROWS = 4096


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds a path (a URI or a plain path), and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


def spark_name(path: str) -> str:
    """A path as Spark's file sources name it in ``_metadata.file_path``."""
    return "".join(quote(c) if c in ILLEGAL else c for c in path)


def member(text: bytes) -> bytes:
    """A marked gzip member."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(text) + pack.flush()
    return MARK + body + zlib.crc32(text).to_bytes(4, "little") + (len(text) & 0xFFFFFFFF).to_bytes(4, "little")


class Segments:
    """The text of one file's segments that start in [start, stop).

    A segment is a marked member and the unmarked ones after it, or a whole file without a mark at its
    head.  ``file`` can seek and read.
    """

    def __init__(self, file, name: str, start: int, stop: int):
        self.file, self.name, self.stop = file, name, stop
        self.at: int | None = self._first(start)

    def _first(self, start: int) -> int | None:
        self.file.seek(0)
        self.marked = self.file.read(len(MARK)) == MARK
        if start == 0 or not self.marked:
            return 0 if start == 0 else None
        held, at = b"", start
        while at < self.stop:
            self.file.seek(at)
            held = self.file.read(min(_READ, self.stop - at) + len(MARK) - 1)
            found = held.find(MARK)
            if found >= 0:
                return at + found
            at += max(len(held) - len(MARK) + 1, 1)
        return None

    def __iter__(self) -> Iterator[Iterator[bytes]]:
        """Chunks of text for each segment; a segment must be read to its end before the next."""
        while self.at is not None and self.at < self.stop:
            yield self._chunks(self.at)

    def _chunks(self, at: int) -> Iterator[bytes]:
        self.file.seek(at)
        data = self.file.read(_READ)
        if not data:  # an empty file
            self.at = None
            return
        first = True
        while True:
            # ``data`` holds the head of a member, as far as the file has it.
            while len(data) < len(MARK) and (more := self.file.read(_READ)):
                data += more
            if not data or (self.marked and not first and data.startswith(MARK)):
                self.at = self.file.tell() - len(data) if data else None
                return
            if not data.startswith(MAGIC):
                raise ValueError(f"{self.name}: no gzip member at byte {self.file.tell() - len(data)}")
            first, unpack = False, zlib.decompressobj(31)
            while not unpack.eof:
                if not data and not (data := self.file.read(_READ)):
                    raise ValueError(f"{self.name}: the file ends within a gzip member")
                try:
                    yield unpack.decompress(data, _READ)
                except zlib.error as problem:
                    raise ValueError(f"{self.name}: {problem}") from problem
                data = unpack.unconsumed_tail
            data = unpack.unused_data


def lines(chunks: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lines without their ends (``\\n``, ``\\r\\n`` or ``\\r``), in lists of what each chunk completes."""
    held: list[bytes] = []
    for chunk in chunks:
        # A return at the end may be half of a line end.
        cut = max(chunk.rfind(b"\n"), chunk.rfind(b"\r", 0, max(len(chunk) - 1, 0))) + 1
        if cut:
            yield b"".join([*held, chunk[:cut]]).splitlines()
            held = []
        held.append(chunk[cut:])
    rest = b"".join(held).splitlines()
    if rest:
        yield rest


@dataclass
class _Ranges(InputPartition):
    #: (path, start, stop)
    parts: list[tuple[str, int, int]]


def listed(files: list[str], folders: list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of files, and of those in folders that are neither hidden nor logs."""
    found = []
    for path in files:
        store, inner = file_system(path)
        found.append((path, store.get_file_info(inner).size))
    for folder in folders:
        store, inner = file_system(folder)
        for info in store.get_file_info(fs.FileSelector(inner)):
            name = info.base_name
            if info.type == fs.FileType.File and not name.startswith(("_", ".")) and not name.endswith("txt"):
                found.append((f"{folder.rstrip('/')}/{name}", info.size))
    return sorted(found)


def dealt(found: list[tuple[str, int]], size: int) -> list[_Ranges]:
    """Byte ranges of at most ``size``, small files together."""
    parts = [(path, at, min(at + size, total)) for path, total in found for at in range(0, total, size)]
    tasks, held, room = [], [], 0
    for part in parts:
        own = part[2] - part[1]
        if held and own > room:
            tasks.append(_Ranges(held))
            held, room = [], 0
        if not held:
            room = size
        held.append(part)
        room -= own
    return tasks + ([_Ranges(held)] if held else [])


class _Reader(DataSourceReader):
    def __init__(self, options):
        named = json.loads(options["named"])
        self.files, self.folders = named["files"], named["folders"]
        self.suffix = options.get("suffix", "")
        self.size = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self):
        found = [f for f in listed(self.files, self.folders) if f[0].endswith(self.suffix)]
        return dealt(found, self.size) or [_Ranges([])]

    def read(self, partition):
        schema = pa.schema([("value", pa.string()), ("file", pa.string())])
        for path, start, stop in partition.parts:
            shown = spark_name(path)
            store, inner = file_system(path)
            with store.open_input_file(inner) as file:
                for segment in Segments(file, path, start, stop):
                    for found in lines(segment):
                        for i in range(0, len(found), _ROWS):
                            own = [x.decode("utf-8", "replace") for x in found[i : i + _ROWS]]
                            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([shown] * len(own))], schema=schema)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    """Tasks write below a hidden folder; files of the attempts that count are moved out of it by the driver,
    and ``_SUCCESS`` is written last."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.member_bytes = int(options.get("memberbytes", MEMBER_BYTES))
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.suffix = options.get("suffix", ".json.gz")
        self.hidden = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        store, root = file_system(f"{self.path}/{self.hidden}")
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out, written, held, size = None, 0, [], 0

        def close_member():
            nonlocal out, written, held, size
            if out is None:
                names.append(f"part-{uuid.uuid4().hex}{self.suffix}")
                out, written = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
            out.write(member(b"".join(held)))
            written += size
            held, size = [], 0
            if written >= self.file_bytes:
                out.close()
                out = None

        for batch in iterator:
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                if value is None:
                    continue
                held += [value, b"\n"]
                size += len(value) + 1
                if size >= self.member_bytes:
                    close_member()
        if held:
            close_member()
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages):
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                store.move(f"{root}/{self.hidden}/{name}", f"{root}/{name}")
        self._clear(store, root)
        with store.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages):
        self._clear(*file_system(self.path))

    def _clear(self, store, root):
        if store.get_file_info(f"{root}/{self.hidden}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.hidden}")


class SplitGzip(DataSource):
    """``spark.read.format("split_gzip")``, after :func:`register`."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return LINES

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("lines are added to a folder, or go to a new one; nothing is written over")
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SplitGzip)


def read_lines(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, suffix: str = ""
) -> DataFrame:
    """(value, file): lines of the gzip files that ``path`` names, a task for each ``range_bytes``.

    Files in folders count if they are neither hidden nor logs (``txt``) and end in ``suffix``.  Bytes that
    are no UTF-8 become replacement signs.  A damaged file ends the job.
    """
    register(spark)
    files, folders = named_paths(spark, path)
    named = json.dumps({"files": files, "folders": folders})
    return spark.read.format(FORMAT).options(named=named, rangeBytes=range_bytes, suffix=suffix).load()


def write_lines(
    rows: DataFrame, path: str, member_bytes: int = MEMBER_BYTES, file_bytes: int = FILE_BYTES, suffix: str = ".json.gz"
) -> None:
    """Add the text column ``value`` to a folder as gzip files that can be split; a null is no line.

    A value should hold no line end.  Files of tasks that were lost or run twice are not left behind.
    """
    register(rows.sparkSession)
    options = {"memberBytes": member_bytes, "fileBytes": file_bytes, "suffix": suffix}
    rows.select(F.col("value").cast("string")).write.format(FORMAT).options(**options).mode("append").save(path)
