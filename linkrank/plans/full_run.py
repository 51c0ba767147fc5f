"""From a folder of crawl files to ranked sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.urls import clean_parent, normalize
from linkrank.operators.attributes import url_attributes
from linkrank.operators.audit import completeness_audit
from linkrank.operators.graph import build_index, extend_index, graph_nodes, node_connectivity
from linkrank.operators.links import (
    clean_extracted,
    count_links,
    drop_index_rows,
    known_parents,
    link_rows,
    parse_pages,
)
from linkrank.operators.ranking import exclude_listed, exclude_urls, top
from linkrank.operators.staging import stage, write_and_read
from linkrank.options import Options
from linkrank.plans.index_versions import extend_versions, read_versions, write_base
from linkrank.sinks import tables
from linkrank.sources.crawl import (
    CORRUPT_COLUMN,
    FILE_COLUMN,
    named_exists,
    read_extracted,
    read_pages,
)
from linkrank.sources.graph import (
    PAGE_LINKS,
    read_edges,
    read_index,
    read_page_links,
    read_url_list,
)
from linkrank.streaming import ingest

INDEX = "node_index"
#: Where the ids are kept, see ``index_versions``; INDEX is a copy for readers.
VERSIONS = "node_index_versions"


def _missing_url(options: Options, extracted: bool) -> str:
    return options.on_missing_url or ("error_url" if extracted else "drop")


def _read_crawl(spark: SparkSession, src: str, options: Options, extracted: bool) -> DataFrame:
    common = {
        "url_col": options.url_col,
        "fail_fast": options.fail_fast,
        "min_partitions": options.min_partitions,
        "spread_above": options.spread_above,
        "gzip_range_bytes": options.gzip_range_bytes,
    }
    if extracted:
        return read_extracted(spark, src, **common)
    return read_pages(spark, src, html_col=options.html_col, **common)


def _cleaned(pages: DataFrame, options: Options, extracted: bool) -> DataFrame:
    common = {
        "url_col": options.url_col,
        "on_missing_url": _missing_url(options, extracted),
        "link_types": options.parse_types,
        "corrupt_col": CORRUPT_COLUMN,
        "keep": [FILE_COLUMN],
    }
    if extracted:
        return clean_extracted(pages, **common)
    return parse_pages(pages, html_col=options.html_col, **common)


def parse_stage(
    spark: SparkSession, src: str, out: str, options: Options, extracted: bool = False
) -> None:
    """Pages to cleaned links of all wanted types, and unreadable rows, in one pass."""
    rows = _cleaned(_read_crawl(spark, src, options, extracted), options, extracted)
    tables.write_page_links(rows, f"{out}/links")


def audit_stage(
    spark: SparkSession,
    src: str,
    out: str,
    options: Options,
    extracted: bool = False,
    link_type: str = "type1",
) -> DataFrame:
    """Compare the pages named in the crawl files with those in the stored links of a type.

    ``extracted`` says which of the two parse stages wrote the links: it decides what a page
    without URL counts as and how names are made.  Reads the input once more, so it is not part
    of :func:`run_pipeline`.  The verdicts are appended to a log and returned.
    """
    if link_type not in options.parse_types:
        raise ValueError(f"cannot audit {link_type}: the parse stage does not write it")
    pages = _read_crawl(spark, src, options, extracted).filter(F.col(CORRUPT_COLUMN).isNull())
    if _missing_url(options, extracted) == "drop":
        pages = drop_index_rows(pages, options.url_col)
    variant = "legacy" if extracted else "current"
    inputs = pages.select(
        FILE_COLUMN, normalize(clean_parent(F.col(options.url_col)), link_type, variant).alias("src")
    )
    stored = spark.read.schema(f"{PAGE_LINKS}, {FILE_COLUMN} string").parquet(f"{out}/links")
    outputs = stored.filter(F.col("link_type") == link_type).select(
        FILE_COLUMN, F.col("parent_url").alias("src")
    )
    verdicts = stage(completeness_audit(inputs, outputs, FILE_COLUMN), "audit")
    tables.append_audit_log(verdicts, f"{out}/audit_log")
    return verdicts


def count_stage(spark: SparkSession, out: str, options: Options) -> None:
    links = link_rows(read_page_links(spark, f"{out}/links", options.link_types))
    tables.write_edges(count_links(links), f"{out}/edges")


def exclude(attributes: DataFrame, options: Options) -> DataFrame:
    """All exclusions that the options ask for."""
    kept = exclude_urls(attributes, options.exclude_urls)
    if options.exclude_top_pagerank > 0:
        # The top is taken from the whole table, whatever the other lists hold.
        kept = exclude_listed(kept, top(attributes, options.exclude_top_pagerank))
    if options.exclude_path:
        kept = exclude_listed(kept, read_url_list(attributes.sparkSession, options.exclude_path))
    return kept


def measure(
    edges: DataFrame,
    parents: DataFrame,
    folder: str,
    options: Options,
    earlier_index: DataFrame | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Index, graph export, attributes and rankings of one graph, written below ``folder``.

    ``edges`` (src, dst, weight) and ``parents`` (src, all pages) should be stored tables.  Names have
    the ids of ``earlier_index``, or with ``keep_ids`` those that are stored in ``folder``.
    """
    names, versions = graph_nodes(edges, parents), f"{folder}/{VERSIONS}"
    if keep_ids:
        index = extend_versions(names, versions)
    else:
        index = build_index(names) if earlier_index is None else extend_index(earlier_index, names)
        index = write_base(index, versions)
    index = write_and_read(index, f"{folder}/{INDEX}")
    if options.write_connectivity:
        tables.write_connectivity(node_connectivity(edges, parents), f"{folder}/node_connectivity")

    attributes = write_and_read(
        url_attributes(
            edges, node_index=index if options.encode_nodes else None, **options.pagerank
        ),
        f"{folder}/attributes",
    )
    kept = exclude(attributes, options)
    if kept is not attributes:
        kept = stage(kept, "kept")  # read by up to nine exports
    if options.write_sorted:
        tables.write_sorted_lists(attributes, f"{folder}/sorted", "_non_filtered")
    if options.write_sorted_filtered:
        tables.write_sorted_lists(kept, f"{folder}/sorted_filtered", "_filtered")
    tables.write_ranked_csv(attributes, f"{folder}/link_attributes_non_filtered", options.sort_by)
    tables.write_ranked_csv(kept, f"{folder}/link_attributes_filtered", options.sort_by)
    return attributes


def _earlier_index(spark: SparkSession, run: str, link_type: str) -> DataFrame | None:
    """The index that a run has stored, also one from before there were versions; None without any.

    An index without versions that was not written to the end is refused: new ids in its place
    would contradict those that were given out.
    """
    folder = f"{run}/metrics/{link_type}"
    found = read_versions(spark, f"{folder}/{VERSIONS}")
    if found is not None:
        return found
    if named_exists(spark, f"{folder}/{INDEX}/_SUCCESS"):
        # Staged: it may be the one that this run replaces.
        return stage(read_index(spark, f"{folder}/{INDEX}"), "earlier-index")
    if named_exists(spark, f"{folder}/{INDEX}"):
        raise ValueError(f"{folder}/{INDEX} was not written to the end: its node ids cannot be kept")
    return None


def metrics_stage(
    spark: SparkSession, out: str, link_type: str, options: Options, keep_ids: bool = False
) -> DataFrame:
    """:func:`measure` on the stored links and edges of one granularity.

    ``keep_ids``: the folder belongs to incremental runs; names that it has ids for keep them.
    """
    edges = read_edges(spark, f"{out}/edges", [link_type]).select("src", "dst", "weight")
    if keep_ids:
        # What incremental runs keep: the links of earlier runs are not read again.
        pages = ingest.read_known_parents(spark, f"{out}/parents", link_type)
    else:
        pages = known_parents(read_page_links(spark, f"{out}/links", [link_type])).select("src")
    parents = stage(pages, "parents")
    folder, earlier = f"{out}/metrics/{link_type}", None
    keep_ids = keep_ids and not options.previous_run
    if options.previous_run:
        earlier = _earlier_index(spark, options.previous_run, link_type)
        if earlier is None:
            raise ValueError(f"{options.previous_run} has no index of {link_type}")
    elif keep_ids and read_versions(spark, f"{folder}/{VERSIONS}") is None:
        # The first run, or one from before there were versions.
        earlier = _earlier_index(spark, out, link_type)
        keep_ids = earlier is None
    return measure(edges, parents, folder, options, earlier, keep_ids)


def _check_types(options: Options) -> None:
    missing = set(options.link_types) - set(options.parse_types)
    if missing:
        raise ValueError(f"cannot count {sorted(missing)}: the parse stage does not write them")


def run_pipeline(
    spark: SparkSession,
    src: str,
    out: str,
    options: Options | None = None,
    extracted: bool = False,
) -> dict[str, DataFrame]:
    """Parse, count and rank; returns the attribute table of each link type.

    Every stage overwrites its own folder below ``out`` and reads only the folder of the
    stage before, so a run can be repeated, or resumed by calling a later stage.
    """
    options = options or Options()
    _check_types(options)
    parse_stage(spark, src, out, options, extracted)
    count_stage(spark, out, options)
    return {t: metrics_stage(spark, out, t, options) for t in options.link_types}


def run_incremental(
    spark: SparkSession,
    src: str,
    out: str,
    options: Options | None = None,
    extracted: bool = False,
) -> dict[str, DataFrame]:
    """As :func:`run_pipeline`, but only crawl files that ``out`` has not seen are parsed and
    counted; node ids of earlier runs stay, also those of a run that died on its way.

    Graphs, metrics and rankings are those of everything so far.  The folder must belong to
    incremental runs with the same types.
    """
    options = options or Options()
    _check_types(options)
    state = f"{out}/state"
    arriving = ingest.stream_extracted if extracted else ingest.stream_pages
    columns = {"url_col": options.url_col}
    if not extracted:
        columns["html_col"] = options.html_col
    pages = arriving(spark, src, **columns)
    ingest.append_links(_cleaned(pages, options, extracted), f"{out}/links", f"{state}/links").awaitTermination()
    links = ingest.stream_links(spark, f"{out}/links", options.link_types)
    ingest.ingest_edge_counts(links, f"{out}/edge_counts", f"{state}/counts").awaitTermination()
    parents = ingest.keep_known_parents(spark, f"{out}/links", f"{out}/parents", f"{state}/parents", options.link_types)
    parents.awaitTermination()
    edges = ingest.compact_edge_counts(spark, f"{out}/edge_counts")
    tables.write_edges(edges, f"{out}/edges")
    return {t: metrics_stage(spark, out, t, options, keep_ids=True) for t in options.link_types}
