"""Work on a link graph stored as nested JSON maps, without parsing pages again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkrank.operators.attributes import url_attributes
from linkrank.operators.graph import edge_table
from linkrank.operators.staging import stage
from linkrank.sinks import tables
from linkrank.sources.graph import read_connectivity
from linkrank.sources.one_line import read_one_line_graph


def _edges(spark: SparkSession, path: str, one_line: bool) -> DataFrame:
    read = read_one_line_graph if one_line else read_connectivity
    return stage(read(spark, path)[0], "edges")


def rerank_stored(
    spark: SparkSession, path: str, out: str, one_line: bool = False, **pagerank_options
) -> DataFrame:
    """Write one ranking per attribute of the stored graph; returns the attribute table.

    ``one_line``: the graph is one nested map on a single line, which many tasks read.
    """
    edges = _edges(spark, path, one_line)
    attributes = stage(url_attributes(edges, **pagerank_options), "attributes")
    tables.write_sorted_lists(attributes, out)
    return attributes


def export_edge_table(
    spark: SparkSession, path: str, out: str, min_sources: int = 2, one_line: bool = False
) -> None:
    """Write the edges whose destinations several sources share, as CSV."""
    edges = _edges(spark, path, one_line)
    tables.write_edge_table(edge_table(edges, min_sources), out)
