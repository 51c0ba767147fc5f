"""Writers.  Rankings stay distributed: the part files of a CSV folder, read in name
order, are the ranking; nothing is funnelled through one task."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.urls import LINK_TYPES
from linkrank.operators.attributes import FEATURES
from linkrank.operators.graph import connectivity_json
from linkrank.operators.ranking import all_orders, ranked
from linkrank.sources.split_gzip import write_lines


@contextmanager
def writers_per_type(spark: SparkSession) -> Iterator[None]:
    """Let a task hold one open file per link type.

    Otherwise Spark sorts every task's rows by the partition column before writing them.  Spark
    has this as a setting of the session only, so other threads of the session have it meanwhile;
    it changes how their files are written, not what is in them.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), len(LINK_TYPES) + 1)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _write_by_type(rows: DataFrame, path: str) -> None:
    with writers_per_type(rows.sparkSession):
        rows.write.mode("overwrite").partitionBy("link_type").parquet(path)


def write_page_links(page_links: DataFrame, path: str) -> None:
    _write_by_type(page_links, path)


def write_page_links_json(page_links: DataFrame, path: str) -> None:
    """Gzip JSON lines ``{"parentURL": ..., "childLinks": [...]}``, one folder per type."""
    rows = page_links.select(
        F.col("parent_url").alias("parentURL"), F.col("child_links").alias("childLinks"), "link_type"
    )
    with writers_per_type(rows.sparkSession):
        rows.write.mode("overwrite").partitionBy("link_type").json(path, compression="gzip")


def write_crawl(pages: DataFrame, path: str, **sizes) -> None:
    """Add pages to a folder as gzip JSON lines that any reader takes and many tasks can share;
    ``sizes`` as in :func:`linkrank.sources.split_gzip.write_lines`."""
    write_lines(pages.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in pages.columns])).alias("value")), path, **sizes)


def write_edges(edges: DataFrame, path: str) -> None:
    _write_by_type(edges, path)


def write_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def write_connectivity(connectivity: DataFrame, path: str) -> None:
    """Gzip JSON lines with a source, a slice number and the links of that slice."""
    connectivity_json(connectivity).write.mode("overwrite").option("compression", "gzip").text(path)


#: Every text comes back as it was: blanks around it stay, and a quote is doubled.
CSV = {
    "header": True,
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
}


def _write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV folder written here; names may hold line breaks."""
    return spark.read.schema(schema).options(**CSV, multiLine=True).csv(path)


def write_ranked_csv(attributes: DataFrame, path: str, by: str | None = None) -> None:
    _write_csv(ranked(attributes, by).select("url", *FEATURES), path)


def write_sorted_lists(attributes: DataFrame, folder: str, tag: str = "") -> None:
    """One ranking per attribute, all from one sort; ``attributes`` should be a stored table.

    The rankings are written beside their places and moved there when all are whole.
    """
    spark = attributes.sparkSession
    hidden = f"{folder}/_sorting-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(hidden).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # Sorted by the partition column first: a task has one file open.
        all_orders(attributes).write.partitionBy("sorted_by").options(**CSV).csv(hidden)
        for feature in FEATURES:
            made, place = path(f"{hidden}/sorted_by={feature}"), path(f"{folder}/{feature}{tag}")
            if not system.exists(made):  # no rows
                write_ranked_csv(attributes, place.toString(), feature)
                continue
            system.create(path(f"{made}/_SUCCESS"), True).close()
            system.delete(place, True)
            if not system.rename(made, place):
                raise OSError(f"{made} could not be moved to {place}")
    finally:
        system.delete(path(hidden), True)


def write_edge_table(table: DataFrame, path: str) -> None:
    _write_csv(table.select("src", "dst", "weight", "dstcount"), path)


def append_audit_log(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").options(**CSV).csv(path)
