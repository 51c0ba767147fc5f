"""JSON stored as one very long line: nested maps, flat maps and arrays of names, in many tasks.

Spark's text source cuts a plain file at any byte range and, with another line separator, into
records of any kind.  Names are the only strings of these files, so ``":`` ends a key and ``",``
ends an array element, wherever the range ends fall, unless the quote is escaped or opens a name:
such a record goes on in the next one.  A task walks its records in order and knows everything but
three facts at the edges of each byte range: whether its first record continues a name, what follows
its last name, and the source that is open when it begins.  One small row for each byte range
settles these in file order.  No name, source or line has to fit in a task
as a whole with its neighbours; a gzip file is one byte range, read as a stream.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.staging import stage
from linkrank.sources.crawl import read_named

KEY_END = '":'
ELEMENT_END = '",'

_SCANNED = (
    "file string, block long, number long, src string, name string, after string,"
    " firsts array<string>, first_after string, last string, last_open boolean, texts long"
)
_SETTLED = "file string, block long, number long, src string, name string, after string, open_src string"


def _escaped(record: str) -> bool:
    """The record ends in an odd number of backslashes, so the quote after it belongs to a name."""
    return record.endswith("\\") and (len(record) - len(record.rstrip("\\"))) % 2 == 1


def _goes_on(record: str, continues: bool) -> bool:
    """Whether the name goes on in the next record.  A record that begins no name although it does not
    continue one was ended by an opening quote: the name starts with the separator's second sign."""
    return _escaped(record) or not continues and '"' not in record


def _merged(texts: list[str], records: list[str], is_open: bool, separator: str) -> bool:
    """Append the records to ``texts``, those that continue a name to the text before; whether the
    last one is open."""
    for record in records:
        if is_open:
            texts[-1] += separator + record
        else:
            texts.append(record)
        is_open = _goes_on(record, is_open)
    return is_open


def _is_map(after: str) -> bool:
    return after.lstrip().startswith("{")


class _Block:
    """The records of one byte range, taken in batches.

    The first records, up to one that has a quote and ends its name, are kept as they are: what they
    mean depends on the range before.  From there on this range can tell.
    """

    def __init__(self, file: str, block: int, pairs: bool):
        self.file, self.block, self.pairs = file, block, pairs
        self.separator = KEY_END if pairs else ELEMENT_END
        self.firsts: list[str] = []
        self.quoted = self.certain = self.held_open = False
        self.held: list[str] = []  # the last text, which may go on
        self.first_after = self.src = None
        self.number = 0

    def add(self, records: list[str]) -> pa.RecordBatch | None:
        """Rows of the names that are settled by these records."""
        at = 0
        while not self.certain and at < len(records):
            self.firsts.append(records[at])
            self.quoted = self.quoted or '"' in records[at]
            self.certain = self.quoted and not _escaped(records[at])
            at += 1
        self.held_open = _merged(self.held, records[at:], self.held_open, self.separator)
        texts, self.held = self.held, self.held[-1:]
        return self._named(texts) if self.pairs else self._elements(texts[:-1])

    def _elements(self, texts: list[str]) -> pa.RecordBatch | None:
        if not texts:
            return None
        numbers = range(self.number, self.number + len(texts))
        self.number += len(texts)
        return self._rows(len(texts), number=numbers, name=texts)

    def _named(self, texts: list[str]) -> pa.RecordBatch | None:
        parts = [t.partition('"') for t in texts]
        if parts and self.first_after is None:
            self.first_after = parts[0][0]
        names, after = [p[2] for p in parts[:-1]], [p[0] for p in parts[1:]]
        if not names:
            return None
        sources, src = [], self.src
        for name, text in zip(names, after, strict=True):
            if _is_map(text):
                src = name
            sources.append(src)
        self.src = src
        return self._rows(len(names), src=sources, name=names, after=after)

    def end(self) -> pa.RecordBatch:
        """The row that tells how the range begins and ends."""
        return self._rows(
            1, firsts=[self.firsts], first_after=[self.first_after], src=[self.src], texts=[self.number],
            last=self.held or [None], last_open=[self.held_open],
        )

    def _rows(self, n: int, **columns) -> pa.RecordBatch:
        kinds = {"block": pa.int64(), "number": pa.int64(), "last_open": pa.bool_(), "texts": pa.int64(), "firsts": pa.list_(pa.string())}
        names = [c.split()[0] for c in _SCANNED.split(",")]
        columns |= {"file": [self.file] * n, "block": [self.block] * n}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns.get(c, [None] * n), kinds.get(c, pa.string())) for c in names], names=names
        )


def _scan(pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Block | None = None
        for batch in batches:
            files, blocks, values = (batch.column(i).to_pylist() for i in range(3))
            keys = list(zip(files, blocks, strict=True))
            start = 0
            while start < len(keys):
                stop = start + 1
                if keys[-1] == keys[start]:
                    stop = len(keys)
                while stop < len(keys) and keys[stop] == keys[start]:
                    stop += 1
                if current is None or (current.file, current.block) != keys[start]:
                    if current is not None:
                        yield current.end()
                    current = _Block(*keys[start], pairs)
                rows = current.add(values[start:stop])
                if rows is not None:
                    yield rows
                start = stop
        if current is not None:
            yield current.end()

    return run


def _settle_pairs(rows: list[dict]) -> Iterator[tuple]:
    """(block, number, src, name, after, open source) of one file's byte ranges, in order."""
    text, is_open, src = "", False, None

    def ended(after: str) -> Iterator[tuple]:
        nonlocal src
        _, quote, name = text.partition('"')
        if quote:
            src = name if _is_map(after) else src
            yield row["block"], None, src, name, after, None

    for row in rows:
        for record in row["firsts"]:
            if is_open:
                text += KEY_END + record
            else:
                yield from ended(record.partition('"')[0])
                text = record
            is_open = _goes_on(record, is_open)
        if row["last"] is None:
            continue
        yield from ended(row["first_after"])
        yield row["block"], None, None, None, None, src
        src = row["src"] if row["src"] is not None else src
        text, is_open = row["last"], row["last_open"]
    if '"' in text:
        raise ValueError(f"the file ends within a name: {text[:80]!r}")


def _settle_elements(rows: list[dict]) -> Iterator[tuple]:
    """(block, number, None, text, None, None): texts at range edges with their numbers, and for each
    range a row without name whose number counts the texts before those that the range settled."""
    text, is_open, count = None, False, 0
    rows[0]["firsts"][0] = re.sub(r'^\s*\{\s*"(?:[^"\\]|\\.)*"\s*:', "", rows[0]["firsts"][0])
    for row in rows:
        for record in row["firsts"]:
            if is_open:
                text += ELEMENT_END + record
            else:
                if text is not None:
                    yield row["block"], count, None, text, None, None
                    count += 1
                text = record
            is_open = _goes_on(record, is_open)
        if row["last"] is None:
            continue
        yield row["block"], count, None, text, None, None
        yield row["block"], count + 1, None, None, None, None
        count += 1 + row["texts"]
        text, is_open = row["last"], row["last_open"]
    yield rows[-1]["block"], count, None, text, None, None


def _settled(scanned: DataFrame, settle) -> DataFrame:
    """The edge rows of every file settled in file order: one row for each byte range in a group."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        file = rows[0]["file"]
        out = [(file, *r) for r in settle(rows)]
        names = [c.split()[0] for c in _SETTLED.split(",")]
        kinds = [pa.int64() if c in ("block", "number") else pa.string() for c in names]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    edges = scanned.filter(F.col("firsts").isNotNull()).select("file", "block", "src", "firsts", "first_after", "last", "last_open", "texts")
    return stage(edges.groupBy("file").applyInArrow(run, _SETTLED), "settled")


@contextmanager
def _ranges(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Let scans cut files at every ``size`` bytes; Spark has this as settings of the session only."""
    wanted = {} if size is None else {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _scanned(spark: SparkSession, path: str | list[str], pairs: bool, range_bytes: int | None) -> DataFrame:
    with _ranges(spark, range_bytes):
        records = _records(spark, path, KEY_END if pairs else ELEMENT_END)
        return stage(records.mapInArrow(_scan(pairs), _SCANNED), "scanned")


def _records(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """(file, block, value): records in order within each byte range of a file."""

    def read(paths: list[str]) -> DataFrame:
        return spark.read.option("lineSep", separator).text(paths).select("value", "_metadata")

    return read_named(read, spark, path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def json_name(raw: Column) -> Column:
    """The name that stands between two quotes of a JSON text; bad escapes end the job."""
    parsed = F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>", {"mode": "FAILFAST"})
    return F.when(F.contains(raw, F.lit("\\")), F.element_at(parsed, 1)).otherwise(raw)


def _integer(after: Column, name: Column) -> Column:
    """The whole number that follows a name; anything else ends the job."""
    number = F.regexp_extract(after, r"^\s*(-?\d+)\s*[,}]", 1)
    wrong = F.raise_error(F.concat(F.lit("no whole number after the name "), name)).cast("bigint")
    return F.when(number != "", number.cast("bigint")).otherwise(wrong)


def read_names(spark: SparkSession, path: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """Every name of stored maps: (src, name, after), raw as in the file.  ``src`` is the last name
    that a map follows, up to this one; ``after`` is what stands between the name and the next."""
    scanned = _scanned(spark, path, True, range_bytes)
    settled = _settled(scanned, _settle_pairs)
    inner = scanned.filter(F.col("firsts").isNull())
    open_sources = settled.filter(F.col("name").isNull() & F.col("open_src").isNotNull()).select("file", "block", "open_src")
    known = inner.filter(F.col("src").isNotNull()).select("src", "name", "after")
    # Names before the first source of their range; a hub fills whole ranges.
    carried = inner.filter(F.col("src").isNull()).join(open_sources, ["file", "block"], "left").select(F.col("open_src").alias("src"), "name", "after")
    return known.unionByName(carried).unionByName(settled.filter(F.col("name").isNotNull()).select("src", "name", "after"))


def read_one_line_graph(
    spark: SparkSession, path: str | list[str], range_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Nested maps ``{"<src>": {"<dst>": weight, ...}, ...}`` -> (edges, parents), as
    :func:`linkrank.sources.graph.read_connectivity`, of files with lines of any length.

    A plain file is read by a task for each byte range of ``range_bytes`` (by default, what Spark's own
    settings give), and a source with very many links by several.  Text of another form ends the job.
    """
    names = stage(read_names(spark, path, range_bytes), "names")
    is_source = F.startswith(F.ltrim(F.translate("after", "\n\r\t", "   ")), F.lit("{"))
    links = names.filter(~is_source)
    source = F.when(F.col("src").isNull(), F.raise_error(F.concat(F.lit("a link outside any map: "), F.col("name"))).cast("string"))
    edges = links.select(
        source.otherwise(json_name(F.col("src"))).alias("src"), json_name(F.col("name")).alias("dst"),
        _integer(F.col("after"), F.col("name")).alias("weight"),
    )
    parents = names.filter(is_source).select(json_name(F.col("name")).alias("src")).distinct()
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), parents


def read_one_line_ids(spark: SparkSession, path: str | list[str], range_bytes: int | None = None) -> DataFrame:
    """A flat map ``{"<name>": id, ...}`` -> (id, name)."""
    names = read_names(spark, path, range_bytes)
    return names.select(_integer(F.col("after"), F.col("name")).alias("id"), json_name(F.col("name")).alias("name"))


def read_one_line_names(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """An array of names, ``["a", ...]`` or ``{"<key>": ["a", ...]}``, in one file -> (id, name), ids
    being places in the array from 0."""
    scanned = _scanned(spark, path, False, range_bytes)
    settled = _settled(scanned, _settle_elements)
    bases = settled.filter(F.col("name").isNull()).select("file", "block", F.col("number").alias("base"))
    inner = (
        scanned.filter(F.col("firsts").isNull())
        .join(bases, ["file", "block"])
        .select((F.col("number") + F.col("base")).alias("id"), F.col("name").alias("text"))
    )
    texts = inner.unionByName(settled.filter(F.col("name").isNotNull()).select(F.col("number").alias("id"), F.col("name").alias("text")))
    head = r'^\s*(?:\[\s*)?"'
    raw = F.regexp_extract("text", head + r'([^"\\]*+(?:\\.[^"\\]*+)*+)', 1)
    empty = F.rlike(F.col("text"), F.lit(r"\[\s*\]\s*\}?\s*$"))
    named = texts.filter(~(empty & (F.col("id") == 0))).select("id", "text", raw.alias("raw"))
    wrong = F.raise_error(F.concat(F.lit("no name at place "), F.col("id").cast("string"))).cast("string")
    name = F.when(F.rlike(F.col("text"), F.lit(head)), json_name(F.col("raw"))).otherwise(wrong)
    return named.select("id", name.alias("name"))


def import_index(
    spark: SparkSession, names: str, ids: str | None = None, range_bytes: int | None = None
) -> DataFrame:
    """The node index (id, name) from stored files: the array of names, and, if given, the map of ids,
    which must say the same; a name or id that differs, or that one file lacks, ends the job."""
    index = stage(read_one_line_names(spark, names, range_bytes), "index")
    if ids is None:
        return index
    other = read_one_line_ids(spark, ids, range_bytes).select(F.col("id").alias("other"), "name")
    both = index.join(other, "name", "full")
    wrong = F.raise_error(F.concat(F.lit("the index files disagree about "), F.col("name"))).cast("bigint")
    return both.select(F.when(F.col("id") == F.col("other"), F.col("id")).otherwise(wrong).alias("id"), "name")
