"""The link graph of one granularity: nodes, ids, degrees, maps, edge table.

``edges`` here are (src, dst, weight) with distinct (src, dst).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.operators.positions import with_position
from linkrank.operators.staging import stage

MAP_TYPE = "map<string,map<string,bigint>>"
ROW_TYPE = "src string, slice int, children map<string,bigint>"


def graph_nodes(edges: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Distinct names: both ends of every edge and, if given, parents without links."""
    names = edges.select(F.explode(F.array("src", "dst")).alias("name"))
    if parents is not None:
        names = names.unionByName(parents.select(F.col("src").alias("name")))
    return names.distinct()


def build_index(names: DataFrame) -> DataFrame:
    """Dense ids 0..N-1 in name order: (id, name)."""
    return with_position(names.select("name").distinct(), [F.col("name")], "id").select("id", "name")


def index_extension(index: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name) of the names that ``index`` lacks, with the ids after its largest one."""
    new = names.select("name").distinct().join(index, "name", "left_anti")
    largest = index.agg(F.max("id").alias("largest")).first()["largest"]
    start = 0 if largest is None else largest + 1
    return with_position(new, [F.col("name")], "id", start).select("id", "name")


def extend_index(index: DataFrame, names: DataFrame) -> DataFrame:
    """Give new names the ids after the largest one; ids already given do not change."""
    return index.unionByName(index_extension(index, names))


def encode_edges(edges: DataFrame, index: DataFrame) -> DataFrame:
    """Names to ids.  A hub that fills one join partition is split by adaptive execution."""
    source = index.select(F.col("name").alias("src"), F.col("id").alias("src_id"))
    target = index.select(F.col("name").alias("dst"), F.col("id").alias("dst_id"))
    return edges.join(source, "src").join(target, "dst").select("src_id", "dst_id", "weight")


def decode_edges(encoded: DataFrame, index: DataFrame) -> DataFrame:
    source = index.select(F.col("name").alias("src"), F.col("id").alias("src_id"))
    target = index.select(F.col("name").alias("dst"), F.col("id").alias("dst_id"))
    return encoded.join(source, "src_id").join(target, "dst_id").select("src", "dst", "weight")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, outdeg, indeg, uniqueout, uniquein) from one scan and one aggregation.

    Every edge counts once at each end; the sums are partial before the shuffle, so hubs
    do not pile up in one task.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def end(node, outdeg, uniqueout, indeg, uniquein):
        return F.struct(
            F.col(node).alias("node"),
            outdeg.alias("outdeg"),
            indeg.alias("indeg"),
            uniqueout.alias("uniqueout"),
            uniquein.alias("uniquein"),
        )

    weight = F.col("weight")
    ends = edges.select(
        F.inline(F.array(end("src", weight, one, none, none), end("dst", none, none, weight, one)))
    )
    counters = ["outdeg", "indeg", "uniqueout", "uniquein"]
    return ends.groupBy("node").agg(*[F.sum(c).alias(c) for c in counters])


def with_ratios(table: DataFrame) -> DataFrame:
    """In/out ratios, weighted and unique; 0.0 where there is no out-link."""

    def ratio(over, under):
        return F.when(F.col(under) == 0, 0.0).otherwise(F.col(over) / F.col(under))

    return table.withColumns(
        {
            "in_out_ratio": ratio("indeg", "outdeg"),
            "uin_uout_ratio": ratio("uniquein", "uniqueout"),
        }
    )


def graph_summary(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """One row: names, edges, total weight, parents."""
    one = F.lit(1)
    parts = [
        graph_nodes(edges, parents).agg(F.count(one).alias("names")),
        edges.agg(F.count(one).alias("edges"), F.coalesce(F.sum("weight"), F.lit(0)).alias("links")),
        parents.select("src").distinct().agg(F.count(one).alias("parents")),
    ]
    counts = ["names", "edges", "links", "parents"]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in counts])


def edge_table(edges: DataFrame, min_sources: int = 2) -> DataFrame:
    """Edges whose destination has at least ``min_sources`` sources, with that count.

    Counted and joined back, not windowed: a window would bring a whole hub to one task,
    while the count is partial.  The counts are staged, so that the join reads both sides
    straight from a shuffle; only then can adaptive execution split a hub.
    """
    sources = stage(
        edges.groupBy("dst")
        .agg(F.count(F.lit(1)).alias("dstcount"))
        .filter(F.col("dstcount") >= min_sources),
        "sources",
    )
    return edges.select("src", "dst", "weight").join(sources, "dst").select(
        "src", "dst", "weight", "dstcount"
    )


def node_connectivity(
    edges: DataFrame, parents: DataFrame | None = None, max_children: int = 100_000
) -> DataFrame:
    """Export form: (src, slice, children map<dst, weight>).

    A source with more than ``max_children`` destinations is spread over several rows, so no
    map grows with the data.  Reading the rows back adds them up again.  With ``parents``,
    pages without links appear with an empty map.
    """
    edges = edges.select("src", "dst", "weight")
    large = stage(
        edges.groupBy("src")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_children)
        .select("src", F.ceil(F.col("n") / max_children).cast("int").alias("slices")),
        "large",
    )
    place = F.conv(F.substring(F.md5(F.col("dst").cast("binary")), 1, 8), 16, 10).cast("long")
    slice_no = F.when(F.col("slices").isNull(), F.lit(0)).otherwise(
        F.pmod(place, F.col("slices")).cast("int")
    )
    # Placed by (src, slice): without this, a join that shuffles by src would leave all
    # slices of a hub in one task.
    maps = (
        edges.join(large, "src", "left")
        .select("src", slice_no.alias("slice"), "dst", "weight")
        .repartition("src", "slice")
        .groupBy("src", "slice")
        .agg(F.map_from_entries(F.collect_list(F.struct("dst", "weight"))).alias("children"))
    )
    if parents is None:
        return maps
    linked = edges.select("src").distinct()
    empty = parents.select("src").distinct().join(linked, "src", "left_anti")
    return maps.unionByName(
        empty.select(
            "src", F.lit(0).alias("slice"), F.create_map().cast("map<string,bigint>").alias("children")
        )
    )


def connectivity_json(connectivity: DataFrame) -> DataFrame:
    """One JSON object per row: ``{"src": "...", "slice": 0, "children": {"<dst>": weight, ...}}``.

    A source may have several rows, told apart by ``slice``; its links are those of all of them.
    """
    return connectivity.select(F.to_json(F.struct("src", "slice", "children")).alias("value"))


def _maps(lines: DataFrame) -> DataFrame:
    """(src, children) of stored lines: rows of :func:`connectivity_json`, or whole nested maps
    ``{"<src>": {"<dst>": weight, ...}, ...}``.  A line that is neither ends the job."""
    row = F.from_json("value", ROW_TYPE)
    # Whatever is not a labelled row must be a map, and must be readable.
    nested = F.from_json("value", MAP_TYPE, {"mode": "FAILFAST"})
    labelled = F.create_map(F.col("row.src"), F.col("row.children"))
    graph = F.when(F.col("row.slice").isNotNull() & F.col("row.children").isNotNull(), labelled).otherwise(nested)
    read = lines.filter(F.trim("value") != "").select("value", row.alias("row"))
    return read.select(F.explode(graph).alias("src", "children"))


def edges_from_json(lines: DataFrame) -> DataFrame:
    """Rows of nested JSON maps -> (src, dst, weight), not yet merged over rows."""
    return _maps(lines).select("src", F.explode("children").alias("dst", "weight"))


def parents_from_json(lines: DataFrame) -> DataFrame:
    """The sources named in nested JSON maps, also those with no links."""
    return _maps(lines).select("src").distinct()
