"""Command line: full run, re-ranking of a stored graph, edge table of a stored graph."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linkrank import (
    Options,
    clear_scratch,
    export_edge_table,
    rerank_stored,
    run_incremental,
    run_pipeline,
)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linkrank", description=__doc__)
    parser.add_argument("command", choices=["run", "run-extracted", "rerank", "edge-table"])
    parser.add_argument("--incremental", action="store_true", help="parse and count new crawl files only")
    parser.add_argument("source", help="folder of crawl files, or a stored graph (JSON maps)")
    parser.add_argument("target", help="output folder")
    parser.add_argument("--settings", help="JSON settings file")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("linkrank").getOrCreate()
    if given.command == "rerank":
        rerank_stored(spark, given.source, given.target)
    elif given.command == "edge-table":
        export_edge_table(spark, given.source, given.target)
    else:
        options = Options()
        if given.settings:
            lines = spark.read.text(given.settings, wholetext=True)
            options = Options.from_json(lines.first()["value"])
        extracted = given.command == "run-extracted"
        run = run_incremental if given.incremental else run_pipeline
        run(spark, given.source, given.target, options, extracted)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
