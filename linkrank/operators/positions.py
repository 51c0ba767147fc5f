"""Global positions (dense ids, ranks) without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.operators.staging import stage

# monotonically_increasing_id: partition number in the upper bits, row in the lower 33.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def with_position(
    df: DataFrame, order: list[Column], name: str, start: int | Column = 0
) -> DataFrame:
    """Add ``name``: the row's position under ``order``, counted from ``start``.

    One range-partitioned sort; each row then needs only its place in its partition plus
    the sizes of the partitions before it.  The sorted rows are staged first, because the
    sizes and the places must come from the same run of the sort.  The broadcast table
    has one row per sort partition, whatever the data size.
    """
    placed = stage(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "positions"
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    first = F.lit(start) if isinstance(start, int) else start
    position = F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK)) + first
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, position.cast("long").alias(name)
    )
