"""From raw documents to token ids: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm import bpe, decontaminate, minhash, quality, toxicity
from linkrank.llm.queries import tokenizer_path
from linkrank.llm.shared import table
from linkrank.operators.staging import scratch_path, stage, write_and_read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_DECODED = "__decoded"


def _same_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier does not reject; a null text counts as empty.

    Each row is judged by its own text, rows that repeat an id too.  An empty table gives no rows.
    """
    score = _free(docs, "score")
    rows = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), score)
    return _same_columns(rows.filter(F.col(score) < toxicity.THRESHOLD), docs)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject; a null text counts as empty.

    Each row is judged by its own text, rows that repeat an id too.  An empty table gives no rows.
    """
    score = _free(docs, "score")
    rows = quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")), score)
    return _same_columns(rows.filter(F.col(score) >= quality.THRESHOLD), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id (null last).

    Every row is a document of its own, told apart by a key that is given here: rows may repeat ids,
    with the same text or with others.  Of rows of a group that share the smallest id any one stays.
    Texts without words are no duplicates of anything.  An empty table gives no rows.
    """
    key = _free(docs, "row_key")
    # Stored, so that the keys are the same whenever the rows are read.
    keyed = stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = minhash.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("member"), "component_id")
    ids = keyed.select(F.col(key).alias("member"), F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "member")).alias("first")
    kept = groups.join(ids, "member").groupBy("component_id").agg(first).select(F.col("first.member").alias(key))
    return _same_columns(keyed.join(stage(kept, "kept"), key, "left_semi"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by ``benchmark``; texts without words are not.

    Rows that share a doc_id are judged together: all go if one is contaminated.
    """
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = found.filter("contaminated").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the token ids of their whole texts (``ids``).

    The ids are decoded where they are made; the stage fails if they do not give a text back.  A null
    text counts as empty, repeated rows give a row each, an empty table no rows, and a column
    named ``ids`` is replaced.
    """
    return bpe.encode_table(docs, tokenizer_path(), check=True)


def checked(encoded: DataFrame) -> DataFrame:
    """Stored ``encoded`` rows, which fail where the decoded ``ids`` are not the text."""
    decoded = bpe.decode_table(encoded, tokenizer_path(), out=_DECODED)
    same = F.col(_DECODED) == F.coalesce(F.col("text"), F.lit(""))
    wrong = F.raise_error(F.concat(F.lit("ids do not give the text of doc_id "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    ids = F.when(same, F.col("ids")).otherwise(wrong.cast("array<int>")).alias("ids")
    return decoded.select(*[ids if c == "ids" else F.col(f"`{c}`") for c in encoded.columns])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The classifiers' scores and the token ids have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = write_and_read(function(spark, docs, sf_dir), scratch_path(spark, f"stage-{name}"))
    return docs
