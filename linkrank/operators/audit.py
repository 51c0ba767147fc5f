"""Checks that no crawl file was lost on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_MISSING_PCT = 6.0


def completeness_audit(
    inputs: DataFrame,
    outputs: DataFrame,
    file_col: str = "crawl_file",
    parent_col: str = "src",
    max_missing_pct: float = MAX_MISSING_PCT,
) -> DataFrame:
    """Per input file: distinct parents in and out, percentage missing, and the verdict.

    Distinct counts go through (file, parent) first, so one very large file is spread out.
    """

    def parents(rows, name):
        return rows.groupBy(file_col).agg(F.count_distinct(parent_col).alias(name))

    n_in, n_out = F.col("n_in"), F.coalesce(F.col("n_out"), F.lit(0))
    missing = F.when(n_in == 0, 0.0).otherwise((n_in - n_out) / n_in * 100.0)
    return (
        parents(inputs, "n_in")
        .join(parents(outputs, "n_out"), file_col, "left")
        .select(file_col, "n_in", n_out.alias("n_out"), missing.alias("missing_pct"))
        .withColumn("complete", F.col("missing_pct") <= max_missing_pct)
    )


def completeness_totals(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("complete").alias("passed"),
        F.count_if(~F.col("complete")).alias("failed"),
    )


def files_to_reprocess(audit: DataFrame, file_col: str = "crawl_file") -> DataFrame:
    return audit.filter(~F.col("complete")).select(file_col)


def _without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def input_stem(name: Column) -> Column:
    """``crawl.jl.gz`` -> ``crawl``."""
    return _without_extension(_without_extension(name))


def output_stem(name: Column) -> Column:
    """``crawl.csv`` -> ``crawl``."""
    return _without_extension(name)


def pending_inputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input files (column ``file_name``) for which no output of the same stem exists."""
    done = outputs.select(output_stem(F.col("file_name")).alias("stem"))
    return inputs.withColumn("stem", input_stem(F.col("file_name"))).join(
        done, "stem", "left_anti"
    ).drop("stem")
