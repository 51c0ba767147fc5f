"""Weighted and unweighted PageRank as a loop of DataFrame steps.

The edges are laid out once, partitioned and sorted by source; they never move again.
A step sends each node's share of rank to the edges (N rows), and the sums by
destination back (partial before the shuffle).  Both ranks travel in the same step.

A source with very many edges is cut into slices of bounded size, and only that
source's share is repeated per slice; sums by destination need no such care.

Each step's ranks are written to the shared scratch folder, which cuts the lineage and
survives lost executors.  Two folders take turns.  The residual and the rank held by
nodes without out-links are observed during that write, so a step is one job.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.graph import degrees
from linkrank.operators.staging import scratch_path, stage, write_and_read

# Result column -> (total that a node shares out, whether a link counts by its weight).
WALKS = {"pagerank": ("outdeg", True), "pagerank_noweight": ("uniqueout", False)}
ROWS_PER_SLICE = 1_000_000
MIN_ROWS_PER_PARTITION = 100_000
MAX_ROWS_PER_PARTITION = 10_000_000


class NotConverged(RuntimeError):
    """The residual was still above the tolerance after the last allowed step."""


def _layout(edges: DataFrame, totals: DataFrame, hubs: int, parts: int, rows_per_slice: int):
    """Edges placed for the loop, and the columns that place them."""
    links = edges.select("src", "dst", "weight")
    keys = ["src"]
    if hubs:
        # Staged, so that its real size decides between broadcast and shuffle join.
        large = stage(
            totals.filter(F.col("uniqueout") > rows_per_slice).select(
                F.col("node").alias("src"), _slices(rows_per_slice).alias("slices")
            ),
            "hubs",
        )
        slice_no = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("slices")).cast("int"), F.lit(0))
        links = links.join(large, "src", "left").select(
            "src", slice_no.alias("slice"), "dst", "weight"
        )
        keys = ["src", "slice"]
    return links.repartition(parts, *keys).sortWithinPartitions(*keys), keys


def _partitions(spark: SparkSession, rows: int) -> int:
    """The configured number of shuffle partitions, unless they would be tiny or huge."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(configured, math.ceil(rows / MIN_ROWS_PER_PARTITION))
    needed = math.ceil(rows / MAX_ROWS_PER_PARTITION)
    return max(1, wanted, needed)


def _slices(rows_per_slice: int):
    return F.ceil(F.col("uniqueout") / rows_per_slice).cast("int")


def pagerank(
    edges: DataFrame,
    *,
    node_degrees: DataFrame | None = None,
    walks: Iterable[str] = tuple(WALKS),
    damping: float = 0.85,
    tol: float = 1e-6,
    max_iter: int = 100,
    fixed_iters: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(node, one column per walk).  ``edges`` should be a stored table: it is read twice.

    ``node_degrees``, if at hand, is the stored result of :func:`degrees` on these edges.

    Starts at 1/N, spreads the rank of nodes without out-links evenly and stops once the
    summed change is below ``N * tol``; raises :class:`NotConverged` after ``max_iter``.
    With ``fixed_iters`` it makes exactly that many steps instead.
    """
    walks = list(walks)
    spark = edges.sparkSession
    totals = node_degrees if node_degrees is not None else stage(degrees(edges), "degrees")
    totals = totals.select("node", "outdeg", "uniqueout")
    shape = totals.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum("uniqueout"), F.lit(0)).alias("edges"),
        F.count_if(F.col("uniqueout") > rows_per_slice).alias("hubs"),
        *[F.count_if(F.col(WALKS[w][0]) == 0).alias(w) for w in walks],
    ).first()
    n = shape["nodes"]
    ranks = totals.select(
        "node", "outdeg", "uniqueout", *[F.lit(1.0 / max(n, 1)).alias(w) for w in walks]
    )
    if n == 0:
        return ranks.select("node", *walks)

    links, keys = _layout(
        edges, totals, shape["hubs"], _partitions(spark, shape["edges"]), rows_per_slice
    )
    links.persist(StorageLevel.MEMORY_AND_DISK)
    # A view of our own: frames passed to spark.sql() are uncached when the call returns.
    view = f"linkrank_links_{uuid.uuid4().hex}"
    links.createOrReplaceTempView(view)
    idle = {w: shape[w] / n for w in walks}  # rank on nodes that link nowhere
    moving = set(walks)
    folders = [scratch_path(spark, "ranks"), scratch_path(spark, "ranks")]
    try:
        for step in range(fixed_iters if fixed_iters is not None else max_iter):
            seen = Observation()
            update = _step(ranks, view, keys, walks, moving, idle, n, damping, rows_per_slice)
            update = update.observe(
                seen,
                *[F.sum(F.abs(F.col(w) - F.col(f"{w}_old"))).alias(f"{w}_change") for w in walks],
                *[F.sum(F.when(F.col(WALKS[w][0]) == 0, F.col(w))).alias(f"{w}_idle") for w in walks],
            ).select("node", "outdeg", "uniqueout", *walks)
            ranks = write_and_read(update, folders[step % 2])
            facts = seen.get
            idle = {w: facts[f"{w}_idle"] or 0.0 for w in walks}
            if fixed_iters is None:
                moving = {w for w in moving if facts[f"{w}_change"] >= n * tol}
                if not moving:
                    break
        else:
            if fixed_iters is None:
                raise NotConverged(f"{sorted(moving)} not converged after {max_iter} steps")
    finally:
        spark.catalog.dropTempView(view)
        links.unpersist()
    return ranks.select("node", *walks)


def _step(ranks, view, keys, walks, moving, idle, n, damping, rows_per_slice) -> DataFrame:
    """New ranks beside the old ones.  Walks that have converged keep their value.

    Written as one SQL statement: a step is analysed once, not once per method call.  Adding
    the old rows to the sum by node keeps nodes without in-links and saves a join.
    """
    sliced = "slice" in keys
    slices = (
        f"lateral view explode(sequence(0, ceil(uniqueout / {rows_per_slice}) - 1)) s as slice"
        if sliced
        else ""
    )

    def columns(template):
        return ", ".join(
            template.format(w=w, total=WALKS[w][0], times="* weight" if WALKS[w][1] else "")
            for w in walks
        )

    def updated(w):
        if w not in moving:
            return f"max({w}_old) as {w}"
        floor = (1.0 - damping) / n + damping * idle[w] / n
        return f"{floor!r}D + {damping!r}D * sum({w}_in) as {w}"

    query = f"""
        with shares as (
          select node as src {", cast(slice as int) as slice" if sliced else ""},
                 {columns("case when {total} > 0 then {w} / {total} else 0.0D end as {w}_share")}
          from {{ranks}} {slices} where uniqueout > 0
        ), inflow as (
          select dst as node, {columns("{w}_share {times} as {w}_in")},
                 cast(null as bigint) as outdeg, cast(null as bigint) as uniqueout,
                 {columns("cast(null as double) as {w}_old")}
          from {view} join shares using ({", ".join(keys)})
        ), carried as (
          select node, {columns("0.0D as {w}_in")}, outdeg, uniqueout, {columns("{w} as {w}_old")}
          from {{ranks}}
        )
        select node, max(outdeg) as outdeg, max(uniqueout) as uniqueout,
               {columns("max({w}_old) as {w}_old")}, {", ".join(updated(w) for w in walks)}
        from (select * from inflow union all select * from carried)
        group by node
    """
    return ranks.sparkSession.sql(query, ranks=ranks)
