"""WARC archives: a deduplicating writer and a splittable reader.

An archive is a row of gzip members with one record each.  The reader deals out byte ranges,
not files: a task scans its range for the gzip magic number, and accepts a place as the start
of a record if a member decodes there to a WARC version line and header block.  A record
belongs to the range that it starts in, however far it reaches beyond it, so each is read
exactly once and no index is needed.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.shared import file_system, ship
from linkrank.operators.staging import scratch_path, stage, write_and_read

#: Fixed values of the format: gzip magic with the only compression method, and the version.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 16
#: No timestamps: equal input gives equal archives.
DATE = "2000-01-01T00:00:00Z"

RECORDS = "record_id string, record_type string, target string, page_id long, payload_bytes long, payload_digest string, refers_to long, payload binary"


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, target, payload: bytes, refers_to) -> bytes:
    """One uncompressed record: a response, or a revisit without payload."""
    name = "null" if page_id is None else str(page_id)
    body = b"" if refers_to is not None else payload
    # Line ends and other controls in a URL would end the header early.
    target = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in target or "")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name + ' ' + target)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + digest32(payload)),
        ("X-Page-ID", name),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    header = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return VERSION + b"\r\n" + header.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict | None:
    """The record in a decoded member, or None if it isn't one."""
    if not data.startswith(b"WARC/"):
        return None
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    if not blank or not fields.get("Content-Length", "").isdigit():
        return None
    number = lambda s: None if s in (None, "null") else int(s)
    return {
        "record_id": fields.get("WARC-Record-ID"),
        "record_type": fields.get("WARC-Type"),
        "target": fields.get("WARC-Target-URI"),
        "page_id": number(fields.get("X-Page-ID")),
        "payload_bytes": number(fields.get("X-Payload-Length")),
        "payload_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
        "refers_to": number(fields.get("X-Refers-To-Page-ID")),
        "payload": rest[: int(fields["Content-Length"])],
    }


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, sha, refers_to) of pages that repeat the payload of a larger page_id.

    Only ids and digests move.  A payload shared by a third of all pages is one row for each
    task before it is shuffled, and its join is one that Spark can split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    known = stage(
        pages.filter(F.octet_length(payload) >= least_bytes)
        .select("page_id", F.unhex(F.sha1(payload)).alias("sha")),
        "payload-digests",
    )
    keepers = (
        known.groupBy("sha")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    repeated = known.join(keepers, "sha").filter("page_id IS NULL OR page_id < refers_to")
    return repeated.groupBy("page_id", "sha").agg(F.first("refers_to").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of (page_id, url, html); returns (path, bytes) of the archives.

    A null html is the empty payload.  Of pages with equal payloads of at least
    ``least_bytes`` the largest page_id is the response, and the others revisit it; rows that
    share this largest id are all responses, and a null id is smaller than any.  File names
    carry the task attempt, and the manifest has those of committed attempts only.
    """
    spark = pages.sparkSession
    ship(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    sha = F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    earlier = revisits(pages, least_bytes).withColumnsRenamed({"page_id": "own_id", "sha": "own_sha"})
    marked = pages.withColumn("sha", sha).join(
        earlier, F.col("page_id").eqNullSafe(F.col("own_id")) & (F.col("sha") == F.col("own_sha")), "left"
    )

    def write(batches):
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        store, root = file_system(folder)
        out, written = None, 0
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers_to.as_py())
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(raw) + pack.flush()
                out.write(member)
                written += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([written])], names=["path", "bytes"])

    archives = marked.select("page_id", "url", "html", "refers_to").mapInArrow(write, "path string, bytes long")
    return write_and_read(archives, f"{folder}/manifest")


class _Range:
    """The records that start in [start, stop) of one archive."""

    def __init__(self, file, size: int, start: int, stop: int):
        self.file, self.size, self.start, self.stop = file, size, start, stop

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The decoded member at a place and where it ends; None if there is no record."""
        unpack, head, place = zlib.decompressobj(31), [], at
        kept, checked = 0, False
        try:
            while not unpack.eof and place < self.size:
                self.file.seek(place)
                data = self.file.read(HEADER_BYTES if place == at else READ_BYTES)
                place += len(data)
                head.append(unpack.decompress(data))
                kept += len(head[-1])
                if not checked and kept >= len(VERSION):
                    # Decode the header only, before the body of what may be chance bytes.
                    if not b"".join(head).startswith(b"WARC/"):
                        return None
                    checked = True
        except zlib.error:
            return None
        return (b"".join(head), place - len(unpack.unused_data)) if unpack.eof else None

    def records(self):
        at = self.start
        while at < self.stop:
            self.file.seek(at)
            window = self.file.read(min(READ_BYTES, self.stop - at) + len(MAGIC) - 1)
            found = window.find(MAGIC)
            if found < 0:
                at += max(len(window) - len(MAGIC) + 1, 1)
                continue
            at += found
            if at >= self.stop:
                return
            member = self.member(at)
            parsed = parse(member[0]) if member else None
            if parsed is None:
                at += 1
                continue
            yield parsed
            at = member[1]


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the archives listed as (path, bytes); see RECORDS for the columns.

    Ranges are dealt out evenly, whatever the sizes of the files: there are as many tasks as ranges.  Bytes that are no record,
    also those with the magic number in them, are passed over.
    """
    ship(spark)
    ranges = archives.filter("bytes > 0").select(
        "path",
        "bytes",
        F.explode(F.sequence(F.lit(0), F.expr(f"CAST((bytes - 1) DIV {range_bytes} AS INT)"))).alias("part"),
    )

    def read(batches):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in RECORDS.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                store, inner = file_system(row["path"])
                with store.open_input_file(inner) as f:
                    start = row["part"] * range_bytes
                    rows, held = [], 0
                    for found in _Range(f, row["bytes"], start, min(start + range_bytes, row["bytes"])).records():
                        rows.append(found)
                        held += len(found["payload"])
                        if held > 4 << 20 or len(rows) >= 4096:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, kinds)

    # A number that is asked for stays: rows of a few bytes would otherwise end up in one task.
    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, RECORDS)


def _batch(rows, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write (page_id, url, html) as archives in the shared folder and read them back.

    Returns page_id, payload_bytes and payload_digest (of the full payload, also for
    revisits), record_type and refers_to; payload_bytes is null for a response whose payload
    was cut short.
    """
    spark = pages.sparkSession
    archives = write_archives(pages, scratch_path(spark, "warc"))
    read = read_archives(spark, archives)
    sound = (F.col("record_type") == "revisit") | (F.length("payload") == F.col("payload_bytes"))
    return read.select(
        "page_id",
        F.when(sound, F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
