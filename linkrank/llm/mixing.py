"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, served up to three times over.  A
place in a queue gets a virtual finish time: the words of its source up to its end, divided by
the source's target.  All places are range-sorted by finish time, which is the order of the mix,
and the mix ends when its budget of words is spent; the place that its source's target ends
in is cut there.  Running totals are taken inside sort partitions and completed by the totals
of the partitions before, so that no source and no queue is in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkrank.llm.shared import ship
from linkrank.operators.positions import with_position
from linkrank.operators.staging import stage

#: A word, as in the contract of the query.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: How often a document is used at most.
EPOCHS = 3

_ROW_BITS = 40


def running_total(rows: DataFrame, order: list[str], key: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of the long ``value`` over the rows of the same ``key`` up to this one.

    ``order`` (starting with ``key``, a long that is never null) is the order of the rows; equal
    rows may come in any order.  Adds ``row`` too, a number of its own for every row.  The result
    is a stored table, so that both stay the same whenever it is read.
    """
    ship(rows.sparkSession)
    schema = StructType([*rows.schema.fields]).add("part", "integer").add("row", "long").add("running", "long")

    def cumulate(batches):
        part, before, last, total = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(key).to_numpy(), batch.column(value).to_numpy()
            firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums = np.cumsum(values)
            base = np.concatenate([[0], sums])[firsts]
            if keys[0] == last:
                base[0] = -total
            running = sums - np.repeat(base, np.diff(np.append(firsts, len(keys))))
            last, total = keys[-1], int(running[-1])
            row = (part << _ROW_BITS) + before + np.arange(len(keys))
            before += len(keys)
            added = [pa.array(np.full(len(keys), part, np.int32)), pa.array(row), pa.array(running)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    placed = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cumulate, schema), "running"
    )
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each part that a key reaches: as many as parts and keys together, at most.
    bases = (
        placed.groupBy(key, "part")
        .agg(F.sum(value).alias("own"))
        .select(key, "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    )
    return placed.join(bases, [key, "part"]).select(
        *rows.columns, "row", (F.col("running") + F.col("base")).alias(out)
    )


def source_targets(sources: DataFrame, budget: int | None = None) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size), one row for each source.

    Targets share ``budget`` words (all, if None) by weight; none is above EPOCHS times its
    source's size, and what others leave is shared again.  Each round is one small aggregation
    and brings two numbers to the driver; it ends because capped sources stay capped.
    """
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    order = [F.col("source").asc_nulls_last()]
    numbered = with_position(sources, order, "number").withColumns(
        {"weight": F.element_at(weights, (F.col("number") % len(WEIGHTS) + 1).cast("int")), "cap": EPOCHS * F.col("source_size")}
    )
    numbered = stage(numbered, "sources")
    words = numbered.agg(F.sum("source_size")).first()[0] or 0
    budget = words if budget is None else min(budget, EPOCHS * words)
    level, capped = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        found = numbered.agg(
            F.count_if(above).alias("capped"),
            F.sum(F.when(above, F.col("cap"))).alias("spent"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"),
        ).first()
        if found["capped"] == capped or not found["weights"]:
            break
        capped = found["capped"]
        level = (budget - (found["spent"] or 0)) / found["weights"]
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return numbered.select("source", "source_size", "number", "weight", target.alias("target"))


def queues(docs: DataFrame, budget: int | None = None, seed: str = "") -> DataFrame:
    """The documents in their sources' queues: (row, doc_id, source, size, source_size, target,
    number, queue_end), ``queue_end`` being the words of the queue up to the document's end.

    The shuffle is by a digest of seed and doc_id, so reruns agree; rows with equal ids follow
    each other by size.  Rows without text have no words.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sized = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size")), "sizes")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), budget)
    targets = stage(sources.withColumnRenamed("source", "its_source"), "targets")
    draw = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    drawn = (
        sized.join(targets, F.col("source").eqNullSafe(F.col("its_source")))
        .drop("its_source", "weight")
        .withColumn("draw", F.conv(F.substring(draw, 1, 15), 16, 10).cast("long"))
    )
    return running_total(drawn, ["number", "draw", "doc_id", "size"], "number", "size", "queue_end").drop("draw")


def mixture(queued: DataFrame, budget: int | None = None) -> DataFrame:
    """The mix of ``queues(...)``: a row for each use of a document, sorted by ``mix_start``.

    Columns: row, doc_id, source, epoch (from 0), finish (virtual time), mix_start (words of the mix
    before it) and taken (words used; less than the size only where the target ends).
    """
    # A use of a document begins after the words of its queue in earlier epochs and before it.
    begin = F.col("epoch") * F.col("source_size") + F.col("queue_end") - F.col("size")
    left = F.floor("target") - F.col("begin")
    uses = (
        queued.filter("size > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
        .withColumn("begin", begin)
        .filter(left > 0)
        .withColumn("taken", F.least(F.col("size"), left))
        .withColumn("finish", (F.col("begin") + F.col("taken")) / F.col("target"))
        .select(F.lit(0).cast("long").alias("all"), F.col("row").alias("use_of"), "doc_id", "source", "epoch", "number", "begin", "finish", "taken")
    )
    placed = running_total(uses, ["all", "finish", "number", "begin"], "all", "taken", "mix_end")
    start = F.col("mix_end") - F.col("taken")
    kept = placed.withColumn("mix_start", start)
    if budget is not None:
        kept = kept.filter(F.col("mix_start") < budget).withColumn(
            "taken", F.least(F.col("taken"), F.lit(budget) - F.col("mix_start"))
        )
    return kept.select(F.col("use_of").alias("row"), "doc_id", "source", "epoch", "finish", "mix_start", "taken")


def mixed(docs: DataFrame, budget: int | None = None, seed: str = "") -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of each row of (doc_id, text, source).

    A null text has no words and is not taken, and a null source is a source of its own, the last
    in order.  Rows that repeat an id are documents of their own.  Without any words all targets are
    0.  An empty table gives no rows.  Other columns are not read.
    """
    queued = stage(queues(docs, budget, seed), "queues")
    words = queued.agg(F.sum("size")).first()[0] or 0
    mix = mixture(queued, words if budget is None else budget)
    taken = mix.groupBy("row").agg(F.sum("taken").alias("taken"))
    return queued.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source"
    )
