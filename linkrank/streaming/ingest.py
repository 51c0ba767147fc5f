"""Incremental runs over folders in which crawl files keep arriving.

The checkpoint of a query remembers the files it has read, so a second run takes only
new ones.  Triggers run through what is there and stop.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkrank.functions.urls import LINK_TYPES
from linkrank.operators.links import EDGE_KEYS, count_links, known_parents, link_rows, merge_edges, parse_pages
from linkrank.sinks.tables import writers_per_type
from linkrank.sources.crawl import (
    CORRUPT_COLUMN,
    FILE_COLUMN,
    extracted_schema,
    not_a_ledger,
    page_schema,
)
from linkrank.sources.graph import EDGES, PAGE_LINKS


def stream_pages(
    spark: SparkSession,
    path: str,
    *,
    url_col: str = "url",
    html_col: str = "raw_content",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """JSON-lines crawl files as a stream, with unreadable rows kept as text."""
    return _stream(spark, path, page_schema(url_col, html_col), max_files_per_trigger)


def stream_extracted(
    spark: SparkSession,
    path: str,
    *,
    url_col: str = "url",
    children_col: str = "children",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same for pages whose links are already extracted."""
    return _stream(spark, path, extracted_schema(url_col, children_col), max_files_per_trigger)


def _stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None) -> DataFrame:
    reader = (
        spark.readStream.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    named = reader.json(path).filter(not_a_ledger())
    return named.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))


def ingest_links(
    pages: DataFrame,
    out: str,
    checkpoint: str,
    *,
    url_col: str = "url",
    html_col: str = "raw_content",
    link_types: Iterable[str] = LINK_TYPES,
    corrupt_col: str | None = CORRUPT_COLUMN,
) -> StreamingQuery:
    """Stateless: pages to cleaned links, appended exactly once, one folder per type.

    Unreadable rows go to the ``corrupt`` folder in the same pass over the input.
    """
    rows = parse_pages(
        pages,
        url_col=url_col,
        html_col=html_col,
        link_types=link_types,
        corrupt_col=corrupt_col,
        keep=[FILE_COLUMN] if FILE_COLUMN in pages.columns else [],
    )
    return append_links(rows, out, checkpoint)


def append_links(page_links: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of page links exactly once, one folder per type."""
    sink = (
        page_links.writeStream.format("parquet")
        .partitionBy("link_type")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with writers_per_type(page_links.sparkSession):  # the query takes a copy of the settings
        return sink.start(out)


def stream_links(
    spark: SparkSession, path: str, link_types: Iterable[str] = LINK_TYPES
) -> DataFrame:
    """The links written by :func:`ingest_links`, as a stream of link rows."""
    rows = spark.readStream.schema(PAGE_LINKS).parquet(path)
    return link_rows(rows.filter(F.col("link_type").isin(*link_types)))


#: Hash buckets of a table of running counts, and how many triggers' rows are merged at once.
BUCKETS, FANOUT = 64, 4


def _span(batch: int, bucket: int, fanout: int) -> int:
    """How many batches, up to and with ``batch``, its folder has the rows of in a bucket.

    It is the largest power of ``fanout`` that divides their sum: a bucket's folders nest, each
    trigger merges far back in few buckets only, and which is a matter of numbers alone.
    """
    span = 1
    while batch + bucket > 0 and span <= batch and (batch + bucket) % (span * fanout) == 0:
        span *= fanout
    return span


def live_runs(whole: list[int], bucket: int, fanout: int, down_to: int = -1) -> list[int]:
    """The batches whose folders together hold each row of a bucket once, newest first, as far back
    as batches above ``down_to`` go.  ``whole``: ascending, numbers may be missing."""
    found, known = [], set(whole)
    at = whole[-1] if whole else -1
    while at > down_to and whole and at >= whole[0]:
        if at in known:
            found.append(at)
            at -= _span(at, bucket, fanout)
        else:
            at -= 1
    return found


def _layout(spark: SparkSession, out: str) -> tuple[int, int] | None:
    """(buckets, fanout) of the stored table, which its folder's name tells."""
    system, folder = _folder(spark, out)
    if not system.exists(folder):
        return None
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    named = [n.split("-")[1:] for n in names if n.startswith("runs-")]
    return (int(named[0][0]), int(named[0][1])) if named else None


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(*EDGE_KEYS), F.lit(buckets)).cast("int").alias("bucket")


def _runs(spark: SparkSession, folder: str, wanted: dict[int, list[int]]) -> DataFrame:
    """Rows of some buckets (values) of some batches (keys); only their files are read."""
    rows = spark.read.schema(f"{EDGES}, batch int, bucket int").parquet(folder)
    chosen = reduce(or_, [(F.col("batch") == k) & F.col("bucket").isin(v) for k, v in wanted.items()], F.lit(False))
    return rows.filter(chosen).select(*EDGE_KEYS, "weight", "bucket")


def _by_batch(runs: dict[int, list[int]]) -> dict[int, list[int]]:
    """{bucket: batches} the other way round."""
    found: dict[int, list[int]] = {}
    for bucket, batches in runs.items():
        for batch in batches:
            found.setdefault(batch, []).append(bucket)
    return found


def add_counts(counts: DataFrame, out: str, batch_id: int, buckets: int = BUCKETS, fanout: int = FANOUT) -> None:
    """Add a batch's counts (link_type, src, dst, weight) to a table of running counts.

    One folder is written: the batch's rows, in the buckets that are due together with rows of
    earlier batches.  Over time each trigger writes its own rows about once for each level of
    ``fanout``, whatever the table has grown to.  A batch that is done again replaces its folder.
    """
    spark = counts.sparkSession
    if (_layout(spark, out) or (buckets, fanout)) != (buckets, fanout):
        raise ValueError(f"{out} has another number of buckets or another fanout")
    folder = f"{out}/runs-{buckets}-{fanout}"
    earlier = [b for b in whole_versions(spark, folder, "batch") if b < batch_id]
    due = {}
    for bucket in range(buckets):
        first = batch_id - _span(batch_id, bucket, fanout)
        due[bucket] = live_runs(earlier, bucket, fanout, first)
    rows = counts.select(*EDGE_KEYS, "weight", _bucket(buckets))
    older = _by_batch(due)
    if older:
        rows = rows.unionByName(_runs(spark, folder, older))
    # The counts are small by now; a bucket's rows meet, and are one file.
    merged = rows.repartition("bucket").groupBy("bucket", *EDGE_KEYS).agg(F.sum("weight").alias("weight"))
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/batch={batch_id}")
    _drop_merged(spark, folder, earlier, batch_id, buckets, fanout)


def _drop_merged(spark: SparkSession, folder: str, earlier: list[int], batch_id: int, buckets: int, fanout: int) -> None:
    """Delete what neither this version of the table nor the one before needs."""
    needed: dict[int, set[int]] = {}
    for whole in (earlier, [*earlier, batch_id]):
        for bucket in range(buckets):
            for batch in live_runs(whole, bucket, fanout):
                needed.setdefault(batch, set()).add(bucket)
    for batch in earlier:
        if batch not in needed:
            delete_folders(spark, [f"{folder}/batch={batch}"])
            continue
        system, path = _folder(spark, f"{folder}/batch={batch}")
        names = [status.getPath().getName() for status in system.listStatus(path)]
        stored = [int(n.partition("=")[2]) for n in names if n.startswith("bucket=")]
        delete_folders(spark, [f"{folder}/batch={batch}/bucket={b}" for b in stored if b not in needed[batch]])


def keep_running_counts(
    links: DataFrame, out: str, checkpoint: str, buckets: int = BUCKETS, fanout: int = FANOUT
) -> StreamingQuery:
    """Counts so far as a table, brought up to date by every trigger; see :func:`add_counts`.

    No streaming state is held.  The table before a trigger stays readable until the next one, so a
    failure at any point leaves a whole one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        add_counts(count_links(batch), out, batch_id, buckets, fanout)

    return _each_batch(links, write, checkpoint)


def read_running_counts(spark: SparkSession, out: str) -> DataFrame:
    """The table of :func:`keep_running_counts` as its last whole trigger left it."""
    # A table from before there were buckets goes on as what its last version has.
    versions = whole_versions(spark, out, "version")
    parts = [_version(spark, out, "version", versions[-1]).select(*EDGE_KEYS, "weight")] if versions else []
    layout = _layout(spark, out)
    if layout:
        buckets, fanout = layout
        folder = f"{out}/runs-{buckets}-{fanout}"
        whole = whole_versions(spark, folder, "batch")
        live = _by_batch({b: live_runs(whole, b, fanout) for b in range(buckets)})
        if live:
            parts.append(_runs(spark, folder, live).drop("bucket"))
    return merge_edges(*parts) if parts else spark.createDataFrame([], EDGES).select(*EDGE_KEYS, "weight")


def keep_known_parents(
    spark: SparkSession, path: str, out: str, checkpoint: str, link_types: Iterable[str] = LINK_TYPES
) -> StreamingQuery:
    """The pages named so far in the links that :func:`ingest_links` wrote to ``path``, with or without links.

    Each trigger reads new links only.  The table is one of running counts, with a page as an edge to
    nowhere, so its writes follow the batch too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        pages = known_parents(batch).select("link_type", "src", F.lit("").alias("dst"), F.lit(1).cast("bigint").alias("weight"))
        add_counts(pages, out, batch_id)

    rows = spark.readStream.schema(PAGE_LINKS).parquet(path)
    return _each_batch(rows.filter(F.col("link_type").isin(*link_types)), write, checkpoint)


def read_known_parents(spark: SparkSession, out: str, link_type: str) -> DataFrame:
    """(src) of one type in the table of :func:`keep_known_parents`."""
    return read_running_counts(spark, out).filter(F.col("link_type") == link_type).select("src")


def _each_batch(links: DataFrame, write, checkpoint: str) -> StreamingQuery:
    return (
        links.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_edge_counts(links: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Counts of each micro-batch to a folder of its own; replaying a batch replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        count_links(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _each_batch(links, write, checkpoint)


def _folder(spark: SparkSession, path: str):
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), named


def whole_versions(spark: SparkSession, out: str, kind: str) -> list[int]:
    """The numbers of the folders ``<kind>=<number>`` that were written to the end, ascending."""
    system, folder = _folder(spark, out)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    whole = [n for n in names if n.startswith(f"{kind}=") and system.exists(_folder(spark, f"{out}/{n}/_SUCCESS")[1])]
    return sorted(int(n.partition("=")[2]) for n in whole)


def _version(spark: SparkSession, out: str, kind: str, number: int) -> DataFrame:
    return spark.read.schema(EDGES).parquet(f"{out}/{kind}={number}")


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        system, folder = _folder(spark, path)
        system.delete(folder, True)


def _parts(spark: SparkSession, out: str) -> list[DataFrame]:
    """The newest compacted table, and the batches after it."""
    compacted = whole_versions(spark, out, "compacted")
    newest = compacted[-1] if compacted else -1
    parts = [_version(spark, out, "compacted", newest)] if compacted else []
    return parts + [_version(spark, out, "batch", b) for b in whole_versions(spark, out, "batch") if b > newest]


def read_edge_counts(spark: SparkSession, out: str) -> DataFrame:
    """Edges summed over all batches so far."""
    parts = _parts(spark, out)
    return merge_edges(*parts) if parts else spark.createDataFrame([], EDGES).select(*EDGE_KEYS, "weight")


def compact_edge_counts(spark: SparkSession, out: str) -> DataFrame:
    """Replace the batches by their sum, and return it.

    The sum is a folder named after its last batch.  Batches and older sums are deleted only
    when it is whole; until then readers use them, and after that they pass over them.
    """
    batches = whole_versions(spark, out, "batch")
    compacted = whole_versions(spark, out, "compacted")
    fresh = [b for b in batches if not compacted or b > compacted[-1]]
    if fresh:
        read_edge_counts(spark, out).write.mode("overwrite").parquet(f"{out}/compacted={fresh[-1]}")
        delete_folders(spark, [f"{out}/batch={b}" for b in batches] + [f"{out}/compacted={c}" for c in compacted])
    return read_edge_counts(spark, out)
