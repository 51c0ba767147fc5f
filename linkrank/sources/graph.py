"""Stored links, edges, indices and exclusion lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.graph import edges_from_json, parents_from_json
from linkrank.operators.links import select_types
from linkrank.sources.crawl import read_named

PAGE_LINKS = "parent_url string, child_links array<string>, link_type string"
EDGES = "src string, dst string, weight bigint, link_type string"


def read_page_links(spark: SparkSession, path: str, link_types: Iterable[str]) -> DataFrame:
    """Cleaned links; only the folders of the wanted types are read."""
    return select_types(spark.read.schema(PAGE_LINKS).parquet(path), link_types)


def read_page_links_json(spark: SparkSession, path: str, link_types: Iterable[str]) -> DataFrame:
    """Cleaned links as ``{"parentURL": ..., "childLinks": [...]}`` lines, one folder per type."""
    schema = "parentURL string, childLinks array<string>, link_type string"
    rows = select_types(spark.read.schema(schema).json(path), link_types)
    return rows.filter(F.col("parentURL").isNotNull()).select(
        F.col("parentURL").alias("parent_url"),
        F.coalesce("childLinks", F.array().cast("array<string>")).alias("child_links"),
        "link_type",
    )


def read_edges(spark: SparkSession, path: str, link_types: Iterable[str]) -> DataFrame:
    return select_types(spark.read.schema(EDGES).parquet(path), link_types)


def read_connectivity(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nested-map JSON files -> (edges, parents).

    Counts of the same edge in several files or lines are added up.  Parents include those
    with an empty map.  Graphs written by this package have a line for each source, or several;
    a graph stored as one long line is for :func:`linkrank.sources.one_line.read_one_line_graph`,
    as a line here is read by one task.  A line that cannot be read ends the job.
    """
    lines = read_named(spark.read.text, spark, path)
    edges = edges_from_json(lines).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    return edges, parents_from_json(lines)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id bigint, name string").parquet(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line, from a file or from every file of a folder (there, not ``*txt``)."""
    space = r"[ \t\n\r\x0B\f]+"
    return read_named(spark.read.text, spark, path).select(
        F.regexp_replace(F.regexp_replace("value", f"^{space}", ""), f"{space}$", "").alias("url")
    )
