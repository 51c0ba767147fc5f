"""Runs over a folder of crawl files that note which files are done, and which failed and why.

A file that cannot be read to its end (a gzip file cut short, say) does not end the run: its rows are
withheld, and its name and the reason go to the ledger.  A file counts as the same while its size
and time of change stay, so a mended file is taken by the next run.  Each run has a number: links go to
``links/run=<n>``, then the ledger rows to ``ledger/run=<n>``.  A run that was killed in between has
no ledger rows and is done over, into the same folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.audit import pending_inputs
from linkrank.operators.staging import stage
from linkrank.options import Options
from linkrank.plans.full_run import _cleaned, _read_crawl
from linkrank.sinks import tables
from linkrank.sources.crawl import list_files, named_exists
from linkrank.sources.graph import PAGE_LINKS

LEDGER = "path string, bytes bigint, modified timestamp, reason string"
#: Files that are probed together at first.
PROBED = 256


def _reason(error: Exception) -> str:
    """The innermost cause that the error names, on one line."""
    lines = [x.strip() for x in str(error).splitlines() if "Caused by:" in x or "Exception:" in x]
    return (lines[-1] if lines else str(error).strip().splitlines()[0]).removeprefix("Caused by:").strip()[:500]


def broken_files(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The files of ``paths`` that cannot be read to the end, with the reason.

    Every file is read once; a group with a broken file is halved until the file is alone, so a
    broken file costs as many more jobs as its group has halvings.
    """
    found: dict[str, str] = {}
    groups = [paths[i : i + PROBED] for i in range(0, len(paths), PROBED)]
    while groups:
        group = groups.pop()
        try:
            # Without columns only the lines are counted; nothing is kept.
            spark.read.option("ignoreCorruptFiles", "false").text(group).agg(F.sum(F.length("value"))).collect()
        except Exception as error:  # whatever a file or a store fails with
            if len(group) == 1:
                found[group[0]] = _reason(error)
            else:
                groups += [group[: len(group) // 2], group[len(group) // 2 :]]
    return found


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """(run, path, bytes, modified, reason): every file that a run has tried; no reason means done."""
    if not named_exists(spark, f"{out}/ledger"):
        return spark.createDataFrame([], f"{LEDGER}, run int")
    return spark.read.schema(f"{LEDGER}, run int").parquet(f"{out}/ledger")


def failed_files(spark: SparkSession, out: str) -> DataFrame:
    """(path, reason) of the files whose last trial failed."""
    last = F.max_by(F.struct("reason"), "run").alias("last")
    found = read_ledger(spark, out).groupBy("path").agg(last)
    return found.filter(F.col("last.reason").isNotNull()).select("path", "last.reason")


def parse_new_files(
    spark: SparkSession, src: str, out: str, options: Options | None = None, extracted: bool = False
) -> DataFrame:
    """Parse the files of ``src`` that no earlier run into ``out`` has tried as they are now; returns
    the ledger rows of this run.

    File names come to the driver, as they do in any scan; contents do not.
    """
    options = options or Options()
    ledger = read_ledger(spark, out)
    run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
    known = ledger.select("path", "bytes", "modified")
    fresh = stage(list_files(spark, src, deep=True).select("path", "bytes", "modified").join(known, ["path", "bytes", "modified"], "left_anti"), "fresh")
    paths = [r["path"] for r in fresh.select("path").orderBy("path").toLocalIterator()]
    broken = broken_files(spark, paths)
    whole = [p for p in paths if p not in broken]
    if whole:
        rows = _cleaned(_read_crawl(spark, whole, options, extracted), options, extracted)
        tables.write_page_links(rows, f"{out}/links/run={run}")
    reasons = spark.createDataFrame(list(broken.items()), "path string, reason string")
    rows = fresh.join(reasons, "path", "left")
    rows.write.mode("overwrite").parquet(f"{out}/ledger/run={run}")
    return read_ledger(spark, out).filter(F.col("run") == run)


def read_parsed_links(spark: SparkSession, out: str) -> DataFrame:
    """The links of all runs that are in the ledger (not of one that was killed before)."""
    runs = [r[0] for r in read_ledger(spark, out).filter(F.col("reason").isNull()).select("run").distinct().collect()]
    schema = f"{PAGE_LINKS}, bad_record string, crawl_file string, run int"
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/links").filter(F.col("run").isin(runs))


def pending_files(spark: SparkSession, src: str, done: str) -> DataFrame:
    """(path, file_name, bytes) of the files below ``src`` for which ``done`` has none of the same stem.

    Both are listed by Spark, folders within folders too; no file is opened.
    """
    return pending_inputs(list_files(spark, src, deep=True), list_files(spark, done, deep=True).select("file_name"))
