"""The attribute table: degrees, ratios and both PageRanks of every node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.operators.graph import degrees, encode_edges, with_ratios
from linkrank.operators.pagerank import pagerank
from linkrank.operators.staging import stage

# The exported attributes.
FEATURES = (
    "uniqueout",
    "uniquein",
    "outdeg",
    "indeg",
    "uin_uout_ratio",
    "in_out_ratio",
    "pagerank",
    "pagerank_noweight",
)


def url_attributes(
    edges: DataFrame, *, node_index: DataFrame | None = None, **pagerank_options
) -> DataFrame:
    """(url, the eight attributes).  ``edges`` should be a stored table: it is read repeatedly.

    With a ``node_index`` the graph work runs on ids, which keeps the per-step shuffles narrow
    when names are full URLs; the names come back in one join at the end.
    """
    graph = edges
    if node_index is not None:
        encoded = encode_edges(edges, node_index)
        graph = stage(
            encoded.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "weight"),
            "encoded",
        )
    counts = stage(degrees(graph), "degrees")
    ranks = pagerank(graph, node_degrees=counts, **pagerank_options)
    table = with_ratios(counts.join(ranks, "node"))
    if node_index is None:
        return table.select(F.col("node").alias("url"), *FEATURES)
    return table.join(node_index, F.col("node") == F.col("id")).select(
        F.col("name").alias("url"), *FEATURES
    )
