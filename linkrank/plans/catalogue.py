"""The registered queries: each operator applied to the test tables."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions.html import extract_hrefs
from linkrank.functions.urls import clean_parent, link_disposition, normalize, unquote
from linkrank.operators import audit, graph, links, ranking
from linkrank.operators.attributes import FEATURES, url_attributes
from linkrank.operators.pagerank import pagerank
from linkrank.operators.positions import with_position
from linkrank.operators.staging import scratch_path, stage
from linkrank.options import Options
from linkrank.plans.crawl_view import DIRTY_PAGES_SQL, crawl_links, crawl_pages, markup, pages
from linkrank.plans.full_run import audit_stage, exclude, run_incremental, run_pipeline
from linkrank.sinks import tables
from linkrank.plans import file_runs, index_versions
from linkrank.plans.stored_graph import export_edge_table, rerank_stored
from linkrank.sources import crawl, graph as stored
from linkrank.sources.one_line import import_index, read_one_line_graph
from linkrank.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters that the SQL of ``oracles`` repeats.
STEPS = 20
DIGITS = 6
TOP_N = 10
TOP_EXCLUDED = 2
EXCLUDED_URLS = ("site1.example.com", "site7.co.uk", "cdn0.example.com")
CHILDREN_PER_MAP = 40
URL_TYPES = ("type1", "type2", "type3")
LONG_LIST = 2_000

ATTRIBUTES = "url string, " + ", ".join(
    f"{f} {'double' if 'ratio' in f or 'pagerank' in f else 'bigint'}" for f in FEATURES
)

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


def _links(spark, sf_dir, link_types=URL_TYPES, **options) -> DataFrame:
    return links.links_from_href_rows(crawl_links(spark, sf_dir), link_types=link_types, **options)


def _edges(spark, sf_dir, link_type="type2") -> DataFrame:
    """(src, dst, weight) of one type, stored."""
    counted = links.count_links(_links(spark, sf_dir, [link_type]))
    return stage(counted.select("src", "dst", "weight"), "edges")


def _parents(spark, sf_dir, link_type="type2") -> DataFrame:
    return links.known_parents(
        links.clean_extracted(
            crawl_pages(spark, sf_dir), link_types=[link_type], variant="current"
        )
    ).select("src")


def _page_rows(spark, sf_dir) -> DataFrame:
    return links.parse_pages(pages(spark, sf_dir), html_col="html")


# ---- extract -------------------------------------------------------------------------


@query
def ingest_rows(spark, sf_dir):
    rows = links.drop_index_rows(pages(spark, sf_dir))
    return rows.select("page_id", "url", F.length("html").alias("html_chars"))


@query
def crawl_json_scan(spark, sf_dir):
    path = scratch_path(spark, "crawl")
    written = pages(spark, sf_dir).select("url", F.col("html").alias("raw_content"))
    written.write.option("compression", "gzip").json(path)
    rows = crawl.read_pages(spark, path).filter(F.col(crawl.CORRUPT_COLUMN).isNull())
    return rows.select("url", F.length("raw_content").alias("html_chars"))


#: Bytes of a stored table that go into one crawl file.
CRAWL_BYTES = 128 << 20


def _crawl_files(spark, sf_dir, name="pages") -> int:
    """How many crawl files a table makes: one, and of large tables more, each written by a task."""
    listed = crawl.list_files(spark, f"{sf_dir}/{name}.parquet")
    return 1 + (listed.agg(F.sum("bytes")).first()[0] or 0) // CRAWL_BYTES


#: Small, so that small tables have several ranges too.
GZIP_RANGE = 64 << 10


@query
def gzip_ranges_scan(spark, sf_dir):
    """All pages in one gzip file, of large tables in several, read by a task for each byte range."""
    path = scratch_path(spark, "crawl")
    written = pages(spark, sf_dir).select("url", F.col("html").alias("raw_content"))
    tables.write_crawl(written.coalesce(_crawl_files(spark, sf_dir)), path, member_bytes=GZIP_RANGE)
    rows = crawl.read_pages(spark, path, gzip_range_bytes=GZIP_RANGE).filter(F.col(crawl.CORRUPT_COLUMN).isNull())
    return rows.select("url", F.length("raw_content").alias("html_chars"))


def _json_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("url", F.col("html").alias("raw_content"))).alias("value"))


def _crawl_folder(spark, rows: DataFrame) -> str:
    """Pages as gzip JSON crawl files."""
    path = scratch_path(spark, "crawl")
    _json_lines(rows).write.text(path, compression="gzip")
    return path


def _broken_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat(F.lit('{"url": '), F.col("url")).alias("value"))


def _outcome(page_links: DataFrame) -> DataFrame:
    return page_links.select(
        "link_type",
        "parent_url",
        F.when(F.col("link_type") != links.CORRUPT, F.size("child_links")).alias("links"),
        "bad_record",
    )


@query
def quarantined_rows(spark, sf_dir):
    """Crawl files in which every other line is not JSON."""
    path, rows = scratch_path(spark, "crawl"), pages(spark, sf_dir)
    lines = _json_lines(rows).unionByName(_broken_lines(rows))
    lines.write.text(path, compression="gzip")
    parsed = links.parse_pages(
        crawl.read_pages(spark, path), corrupt_col=crawl.CORRUPT_COLUMN
    )
    return _outcome(parsed)


@query
def extract_links(spark, sf_dir):
    raw = links.list_raw_links(pages(spark, sf_dir), url_col="url", html_col="html")
    return raw.select("parent_url", F.posexplode("links").alias("pos", "href"))


@query
def extract_links_parser(spark, sf_dir):
    """Raw links of pages that come from crawl files.  (An earlier version compared a second
    parser under this name.)"""
    read = crawl.read_pages(spark, _crawl_folder(spark, pages(spark, sf_dir)))
    raw = links.list_raw_links(read, url_col="url", html_col="raw_content")
    return raw.select("parent_url", F.posexplode("links").alias("pos", "href"))


@query
def extract_links_markup(spark, sf_dir):
    rows = markup(crawl_links(spark, sf_dir))
    return rows.select(
        "page_key", "pos", F.explode(extract_hrefs(F.col("raw_content"))).alias("href")
    )


# ---- clean and normalise ----------------------------------------------------------------


@query
def unquote_urls(spark, sf_dir):
    rows = crawl_links(spark, sf_dir)
    return rows.select("page_key", "pos", unquote(F.col("href")).alias("decoded"))


@query
def clean_parents(spark, sf_dir):
    rows = crawl_links(spark, sf_dir)
    return rows.select("page_key", clean_parent(F.col("parent_url")).alias("parent")).distinct()


@query
def clean_children(spark, sf_dir):
    return links.clean_href_rows(crawl_links(spark, sf_dir), keep=("page_key", "pos"))


@query
def link_dispositions(spark, sf_dir):
    kind = link_disposition(unquote(F.col("href"))).alias("disposition")
    return crawl_links(spark, sf_dir).groupBy(kind).agg(F.count(F.lit(1)).alias("links"))


def _normalized(link_type: str, variant: str = "current") -> Query:
    def run(spark, sf_dir):
        rows = links.clean_href_rows(crawl_links(spark, sf_dir), keep=("page_key", "pos"))
        return rows.select(
            "page_key",
            "pos",
            normalize(F.col("parent"), link_type, variant).alias("src"),
            normalize(F.col("child"), link_type, variant).alias("dst"),
        )

    return run


for _type in URL_TYPES:
    _queries[f"normalize_{_type}"] = _normalized(_type)


@query
def normalize_legacy(spark, sf_dir):
    return _links(spark, sf_dir, variant="legacy", keep=("page_key", "pos"))


# ---- links and edges -----------------------------------------------------------------------


@query
def links_all_types(spark, sf_dir):
    return links.link_rows(_page_rows(spark, sf_dir))


@query
def page_links_json(spark, sf_dir):
    path = scratch_path(spark, "page-links")
    tables.write_page_links_json(_page_rows(spark, sf_dir), path)
    return links.link_rows(stored.read_page_links_json(spark, path, URL_TYPES))


@query
def preextracted_links(spark, sf_dir):
    return links.count_links(links.link_rows(links.clean_extracted(crawl_pages(spark, sf_dir))))


@query
def linkless_parents(spark, sf_dir):
    rows = links.clean_extracted(
        crawl_pages(spark, sf_dir), variant="current", keep=["crawl_file"]
    )
    return links.linkless_parents(rows, extra_keys=["crawl_file"])


@query
def link_counts(spark, sf_dir):
    return links.count_links(_links(spark, sf_dir))


@query
def link_counts_per_file(spark, sf_dir):
    rows = _links(spark, sf_dir, ["type3"], keep=("crawl_file",))
    return links.count_links(rows, extra_keys=["crawl_file"])


@query
def edge_merge(spark, sf_dir):
    per_file = links.count_links(
        _links(spark, sf_dir, keep=("crawl_file",)), extra_keys=["crawl_file"]
    )
    from_pages = links.count_links(links.link_rows(_page_rows(spark, sf_dir)))
    return links.merge_edges(per_file, from_pages)


@query
def edges_by_type(spark, sf_dir):
    path = scratch_path(spark, "edges")
    tables.write_edges(links.count_links(_links(spark, sf_dir)), path)
    return stored.read_edges(spark, path, ["type2", "type3"]).select(*links.EDGE_KEYS, "weight")


@query
def edges_from_map(spark, sf_dir):
    path = scratch_path(spark, "connectivity")
    tables.write_connectivity(graph.node_connectivity(_edges(spark, sf_dir, "type1")), path)
    return stored.read_connectivity(spark, path)[0]


@query
def parents_from_map(spark, sf_dir):
    path = scratch_path(spark, "connectivity")
    edges, parents = _edges(spark, sf_dir, "type1"), _parents(spark, sf_dir, "type1")
    tables.write_connectivity(graph.node_connectivity(edges, parents), path)
    return stored.read_connectivity(spark, path)[1]


def _one_line(spark, parts: DataFrame, opening: str = "{", closing: str = "}", head: str = "") -> str:
    """The texts ``part`` in the order of ``place``, on one line of one plain file, as a crawl of the older
    pipeline left it.  Each text is a row of its own; the separator puts them on one line."""
    path = scratch_path(spark, "one-line")
    order = with_position(parts, [F.col("place")], "_at")
    last = order.agg(F.max("_at")).first()[0]
    text = F.concat(
        F.when(F.col("_at") == 0, F.lit(head + opening)).otherwise(F.lit("")),
        "part",
        F.when(F.col("_at") == last, F.lit(closing)).otherwise(F.lit(",")),
    )
    lines = order.select("_at", text.alias("value")).repartition(1).sortWithinPartitions("_at")
    lines.select("value").write.option("lineSep", " ").text(path)
    return f"{path}/part-*"  # named, as a folder's files ending in txt are logs


def _graph_parts(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """One text ``"<src>": {...}`` for each source."""
    maps = graph.node_connectivity(edges, parents, max_children=1 << 31)
    return maps.select(
        F.col("src").alias("place"), F.regexp_extract(F.to_json(F.create_map("src", "children")), r"^\{(.*)\}$", 1).alias("part")
    )


#: Bytes of a range: one file of the test tables is cut into many.
RANGE_BYTES = 50_000


@query
def edges_from_one_line(spark, sf_dir):
    """A whole graph on one line of one file, read back by a task for each byte range."""
    parts = _graph_parts(_edges(spark, sf_dir, "type1"), _parents(spark, sf_dir, "type1"))
    return read_one_line_graph(spark, _one_line(spark, parts), RANGE_BYTES)[0]


@query
def parents_from_one_line(spark, sf_dir):
    parts = _graph_parts(_edges(spark, sf_dir, "type1"), _parents(spark, sf_dir, "type1"))
    return read_one_line_graph(spark, _one_line(spark, parts), RANGE_BYTES)[1]


@query
def index_import(spark, sf_dir):
    """The two stored index files of an earlier run, each one line; they must agree."""
    edges, parents = _edges(spark, sf_dir, "type1"), _parents(spark, sf_dir, "type1")
    index = stage(graph.build_index(graph.graph_nodes(edges, parents)), "index")
    name = F.regexp_extract(F.to_json(F.array("name")), r"^\[(.*)\]$", 1)
    names = _one_line(spark, index.select(F.col("id").alias("place"), name.alias("part")), "[", "]}", '{"gnv": ')
    ids = _one_line(spark, index.select(F.col("name").alias("place"), F.concat(name, F.lit(": "), F.col("id").cast("string")).alias("part")))
    return import_index(spark, names, ids, RANGE_BYTES)


@query
def rerank_one_line(spark, sf_dir):
    """The rankings that a stored one-line graph is written as, by unique in-links."""
    parts = _graph_parts(_edges(spark, sf_dir), _parents(spark, sf_dir))
    out = scratch_path(spark, "reranked")
    rerank_stored(spark, _one_line(spark, parts), out, one_line=True, fixed_iters=STEPS)
    return _rounded_attributes(tables.read_csv(spark, f"{out}/uniquein", ATTRIBUTES))


@query
def export_one_line(spark, sf_dir):
    parts = _graph_parts(_edges(spark, sf_dir), _parents(spark, sf_dir))
    out = scratch_path(spark, "edge-table")
    export_edge_table(spark, _one_line(spark, parts), out, one_line=True)
    return tables.read_csv(spark, out, "src string, dst string, weight bigint, dstcount bigint")


@query
def node_connectivity(spark, sf_dir):
    maps = graph.node_connectivity(_edges(spark, sf_dir), max_children=CHILDREN_PER_MAP)
    pairs = F.transform(
        F.map_entries("children"),
        lambda entry: F.concat(entry["key"], F.lit("="), entry["value"].cast("string")),
    )
    return maps.select("src", "slice", F.array_join(F.array_sort(pairs), ",").alias("children"))


@query
def non_dangling_edges(spark, sf_dir):
    return graph.edge_table(_edges(spark, sf_dir, "type1"))


@query
def edge_table_csv(spark, sf_dir):
    path = scratch_path(spark, "edge-table")
    tables.write_edge_table(graph.edge_table(_edges(spark, sf_dir)), path)
    return tables.read_csv(spark, path, "src string, dst string, weight bigint, dstcount bigint")


# ---- graph ------------------------------------------------------------------------------


@query
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(_edges(spark, sf_dir, "type1"))


@query
def node_index(spark, sf_dir):
    edges, parents = _edges(spark, sf_dir, "type1"), _parents(spark, sf_dir, "type1")
    return graph.build_index(graph.graph_nodes(edges, parents))


@query
def index_extend(spark, sf_dir):
    edges = _edges(spark, sf_dir, "type1")
    index = graph.build_index(edges.select(F.col("src").alias("name")))
    return graph.extend_index(index, graph.graph_nodes(edges))


@query
def edges_encoded(spark, sf_dir):
    edges = _edges(spark, sf_dir, "type1")
    return graph.encode_edges(edges, graph.build_index(graph.graph_nodes(edges)))


@query
def edges_decoded(spark, sf_dir):
    edges = _edges(spark, sf_dir, "type1")
    index = graph.build_index(graph.graph_nodes(edges))
    return graph.decode_edges(graph.encode_edges(edges, index), index)


@query
def degrees(spark, sf_dir):
    return graph.degrees(_edges(spark, sf_dir, "type1"))


@query
def degree_ratios(spark, sf_dir):
    table = graph.with_ratios(graph.degrees(_edges(spark, sf_dir, "type1")))
    return _rounded(
        table.select("node", "in_out_ratio", "uin_uout_ratio"), "in_out_ratio", "uin_uout_ratio"
    )


@query
def graph_summary(spark, sf_dir):
    return graph.graph_summary(_edges(spark, sf_dir), _parents(spark, sf_dir))


# ---- metrics and rankings ---------------------------------------------------------------


def _attributes(spark, sf_dir, link_type="type2", **options) -> DataFrame:
    """Rounded before ranking, so that both engines break near-ties alike."""
    table = url_attributes(_edges(spark, sf_dir, link_type), fixed_iters=STEPS, **options)
    rounded = _rounded(
        table, "uin_uout_ratio", "in_out_ratio", "pagerank", "pagerank_noweight"
    )
    return stage(rounded, "attributes")


@query
def pagerank_weighted(spark, sf_dir):
    ranks = pagerank(_edges(spark, sf_dir), walks=["pagerank"], fixed_iters=STEPS)
    return _rounded(ranks, "pagerank")


@query
def pagerank_unweighted(spark, sf_dir):
    ranks = pagerank(_edges(spark, sf_dir), walks=["pagerank_noweight"], fixed_iters=STEPS)
    return _rounded(ranks, "pagerank_noweight")


@query
def pagerank_sliced_hubs(spark, sf_dir):
    """The same ranks with every source of more than 50 links cut into slices."""
    edges = _edges(spark, sf_dir)
    return _rounded(
        pagerank(edges, walks=["pagerank"], fixed_iters=STEPS, rows_per_slice=50), "pagerank"
    )


@query
def pagerank_converged(spark, sf_dir):
    """Both walks until the library's own stop rule ends them."""
    return _rounded(pagerank(_edges(spark, sf_dir)), "pagerank", "pagerank_noweight")


@query
def attributes_type2(spark, sf_dir):
    return _attributes(spark, sf_dir)


@query
def attributes_type1_encoded(spark, sf_dir):
    edges = _edges(spark, sf_dir, "type1")
    index = stage(graph.build_index(graph.graph_nodes(edges)), "index")
    table = url_attributes(edges, node_index=index, fixed_iters=STEPS)
    return _rounded(table, "uin_uout_ratio", "in_out_ratio", "pagerank", "pagerank_noweight")


@query
def ranked_sites(spark, sf_dir):
    return ranking.with_rank(_attributes(spark, sf_dir), "outdeg")


@query
def ranked_csv(spark, sf_dir):
    path = scratch_path(spark, "ranked")
    tables.write_ranked_csv(_attributes(spark, sf_dir), path, "outdeg")
    return tables.read_csv(spark, path, ATTRIBUTES)


@query
def sorted_lists_csv(spark, sf_dir):
    """All rankings through the CSV sink, each line with its place in the files."""
    folder = scratch_path(spark, "sorted")
    tables.write_sorted_lists(_attributes(spark, sf_dir), folder)
    parts = []
    for f in FEATURES:
        lines = tables.read_csv(spark, f"{folder}/{f}", ATTRIBUTES).select(
            F.lit(f).alias("sorted_by"),
            "url",
            F.col(f).cast("double").alias("value"),
            F.col("_metadata.file_name").alias("file"),
            F.monotonically_increasing_id().alias("line"),
        )
        parts.append(with_position(stage(lines, "lines"), [F.col("file"), F.col("line")], "rank", start=1))
    return reduce(DataFrame.unionByName, parts).drop("file", "line")


@query
def top_pagerank(spark, sf_dir):
    best = ranking.top(_attributes(spark, sf_dir), TOP_N)
    return ranking.with_rank(best, "pagerank").select("rank", "url", "pagerank")


def _counted_ranking(feature: str) -> Query:
    """Rankings by degree need no PageRank."""

    def run(spark, sf_dir):
        table = graph.with_ratios(graph.degrees(_edges(spark, sf_dir, "type1")))
        table = _rounded(table.select(F.col("node").alias("url"), feature), feature)
        return ranking.with_rank(table, feature)

    return run


def _walked_ranking(feature: str) -> Query:
    def run(spark, sf_dir):
        ranks = pagerank(_edges(spark, sf_dir), walks=[feature], fixed_iters=STEPS)
        table = _rounded(ranks.select(F.col("node").alias("url"), feature), feature)
        return ranking.with_rank(table, feature)

    return run


for _feature in FEATURES:
    _make = _walked_ranking if _feature.startswith("pagerank") else _counted_ranking
    _queries[f"rank_by_{_feature}"] = _make(_feature)


@query
def rerank_from_edges(spark, sf_dir):
    """All rankings of a graph read back from its JSON form, told apart by ``sorted_by``."""
    path = scratch_path(spark, "connectivity")
    tables.write_connectivity(graph.node_connectivity(_edges(spark, sf_dir)), path)
    edges = stage(stored.read_connectivity(spark, path)[0], "edges")
    table = url_attributes(edges, fixed_iters=STEPS)
    table = stage(
        _rounded(table, "uin_uout_ratio", "in_out_ratio", "pagerank", "pagerank_noweight"),
        "attributes",
    )
    parts = [
        ranking.with_rank(table.select("url", F.col(f).cast("double").alias(f)), f).select(
            F.lit(f).alias("sorted_by"), "rank", "url", F.col(f).alias("value")
        )
        for f in FEATURES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- exclusions ------------------------------------------------------------------------


@query
def exclude_top_pagerank(spark, sf_dir):
    return ranking.exclude_top(_attributes(spark, sf_dir), TOP_EXCLUDED)


@query
def exclude_url_list(spark, sf_dir):
    return ranking.exclude_urls(_attributes(spark, sf_dir), EXCLUDED_URLS)


@query
def exclude_long_list(spark, sf_dir):
    """A list of many names, one of them missing."""
    listed = [f"site{n}.example.com" for n in range(2, LONG_LIST)] + [None]
    return ranking.exclude_urls(_attributes(spark, sf_dir), listed)


def _listed_suppliers(spark, sf_dir) -> str:
    """An exclusion list on disk: one host per supplier, with stray blanks around it."""
    path = scratch_path(spark, "exclusions")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    host = F.concat(
        F.lit("  site"), (F.col("s_suppkey") % 10).cast("string"), F.lit(".example.com \t")
    )
    suppliers.select(host.alias("url")).distinct().write.csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


@query
def exclude_url_file(spark, sf_dir):
    listed = stored.read_url_list(spark, _listed_suppliers(spark, sf_dir))
    return ranking.exclude_listed(_attributes(spark, sf_dir), listed)


@query
def ranked_sites_filtered(spark, sf_dir):
    """All exclusions at once; ranks are those of the sites that are left."""
    options = Options(
        exclude_urls=EXCLUDED_URLS,
        exclude_top_pagerank=TOP_EXCLUDED,
        exclude_path=_listed_suppliers(spark, sf_dir),
    )
    return ranking.with_rank(exclude(_attributes(spark, sf_dir), options), "outdeg")


# ---- audit -----------------------------------------------------------------------------


def _audit(spark, sf_dir) -> DataFrame:
    """Pages in against pages that kept a link, per crawl file."""
    rows = crawl_links(spark, sf_dir)
    inputs = rows.select(
        "crawl_file", normalize(clean_parent(F.col("parent_url")), "type1").alias("src")
    )
    outputs = _links(spark, sf_dir, ["type1"], keep=("crawl_file",))
    return audit.completeness_audit(inputs, outputs)


@query
def completeness_audit(spark, sf_dir):
    return _rounded(_audit(spark, sf_dir), "missing_pct")


@query
def completeness_totals(spark, sf_dir):
    return audit.completeness_totals(_audit(spark, sf_dir))


@query
def files_to_reprocess(spark, sf_dir):
    return audit.files_to_reprocess(_audit(spark, sf_dir))


@query
def pending_inputs(spark, sf_dir):
    """Crawl files (named as on disk) without a count file, one of which each complete file has."""
    checked = _audit(spark, sf_dir)
    inputs = checked.select(F.concat("crawl_file", F.lit(".jl.gz")).alias("file_name"))
    outputs = checked.filter("complete").select(
        F.concat("crawl_file", F.lit(".csv")).alias("file_name")
    )
    return audit.pending_inputs(inputs, outputs)


def _named_files(spark, parts: dict[str, DataFrame], folder: str, files: int = 1) -> list[str]:
    """Gzip JSON crawl files, or other text files, of each name: one, and with ``files`` up to as many,
    each written by a task; those after the first are in folders of their own.  Returns their paths."""
    made = []
    for name, lines in parts.items():
        path = scratch_path(spark, "part")
        packed = {"compression": "gzip"} if name.endswith(".gz") else {}
        lines.coalesce(files).write.text(path, **packed)
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
        system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for i, written in enumerate(system.globStatus(pattern)):
            made.append(f"{folder}/more{i}/{name}" if i else f"{folder}/{name}")
            target = spark._jvm.org.apache.hadoop.fs.Path(made[-1])
            system.mkdirs(target.getParent())
            system.delete(target, False)
            system.rename(written.getPath(), target)
    return made


@query
def pending_files(spark, sf_dir):
    """Crawl files in folders, of which two have been counted; logs and other names do not matter.
    Large tables have several files of a name."""
    rows, files = pages(spark, sf_dir), _crawl_files(spark, sf_dir)
    folder, done = scratch_path(spark, "crawl"), scratch_path(spark, "counted")
    parts = {f"{n % 2}/crawl{n}.jl.gz": _json_lines(rows.filter(F.col("page_id") % FILES == n)) for n in range(FILES)}
    _named_files(spark, parts | {"processed.txt": parts["0/crawl0.jl.gz"]}, folder, files)
    counted = rows.groupBy((F.col("page_id") % FILES).alias("file")).count()
    values = {f"crawl{n}.csv": counted.filter(F.col("file") == n).select(F.col("count").cast("string")) for n in (1, 2)}
    _named_files(spark, values, done)
    return file_runs.pending_files(spark, folder, done).select("file_name").distinct()


FILES = 4


def _cut_short(spark, name: str) -> None:
    """Leave the first half of a file, copied in small blocks."""
    named = spark._jvm.org.apache.hadoop.fs.Path
    path, whole = named(name), named(scratch_path(spark, "whole"))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.rename(path, whole)
    source, target = system.open(whole), system.create(path, True)
    spark._jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, 0, system.getFileStatus(whole).getLen() // 2)
    source.close()
    target.close()


@query
def failed_files(spark, sf_dir):
    """Crawl files of which one is cut short at first and mended later: each run's ledger, with the
    pages that it has of each file.  Large tables have several files of a name, which share a row."""
    rows, files = pages(spark, sf_dir), _crawl_files(spark, sf_dir)
    folder, out = scratch_path(spark, "crawl"), scratch_path(spark, "run")
    parts = {f"crawl{n}.jl.gz": _json_lines(rows.filter(F.col("page_id") % FILES == n)) for n in range(FILES)}
    hurt = [p for p in _named_files(spark, parts, folder, files) if p.endswith("/crawl2.jl.gz")]
    for name in hurt:
        _cut_short(spark, name)
    file_runs.parse_new_files(spark, folder, out)
    _named_files(spark, {"crawl2.jl.gz": parts["crawl2.jl.gz"]}, folder, files)
    file_runs.parse_new_files(spark, folder, out)
    ledger = file_runs.read_ledger(spark, out)
    found = file_runs.read_parsed_links(spark, out).filter("link_type = 'type1'")
    counted = found.groupBy("run", F.col("crawl_file").alias("path")).agg(F.count(F.lit(1)).alias("pages"))
    name = F.regexp_extract("path", r"([^/]*)$", 1).alias("file")
    return ledger.join(counted, ["run", "path"], "left").groupBy("run", name).agg(
        F.bool_or(F.col("reason").isNotNull()).alias("failed"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")
    )


@query
def audit_log(spark, sf_dir):
    path = scratch_path(spark, "audit-log")
    tables.append_audit_log(_rounded(_audit(spark, sf_dir), "missing_pct"), path)
    schema = "crawl_file string, n_in bigint, n_out bigint, missing_pct double, complete boolean"
    return tables.read_csv(spark, path, schema)


# ---- full runs -------------------------------------------------------------------------

SETTINGS = """{"types to parse": ["type2"], "output sorted lists by each attribute": "False",
 "output filtered sorted lists by each attribute": "False", "filter custom URL list": "True",
 "URL filter list": ["nowhere.example.com"]}"""


def _options(**more) -> Options:
    return Options.from_json(SETTINGS, pagerank={"fixed_iters": STEPS}, **more)


def _rounded_attributes(table: DataFrame) -> DataFrame:
    return _rounded(table, "uin_uout_ratio", "in_out_ratio", "pagerank", "pagerank_noweight")


def _run(spark, sf_dir) -> tuple[str, str]:
    source, out = _crawl_folder(spark, pages(spark, sf_dir)), scratch_path(spark, "run")
    run_pipeline(spark, source, out, _options())
    return source, out


@query
def full_run(spark, sf_dir):
    """Crawl files of raw pages to the attribute table, read back from the run's own CSV."""
    _, out = _run(spark, sf_dir)
    table = tables.read_csv(spark, f"{out}/metrics/type2/link_attributes_filtered", ATTRIBUTES)
    return _rounded_attributes(table)


def _extracted_folder(spark, sf_dir) -> str:
    path = scratch_path(spark, "extracted")
    crawl_pages(spark, sf_dir).select("url", "children").write.json(path, compression="gzip")
    return path


@query
def extracted_scan(spark, sf_dir):
    rows = crawl.read_extracted(spark, _extracted_folder(spark, sf_dir))
    return rows.select("url", F.explode("children").alias("href"))


@query
def full_run_extracted(spark, sf_dir):
    """Crawl files of links already extracted to the attribute table."""
    out = scratch_path(spark, "run")
    run_pipeline(spark, _extracted_folder(spark, sf_dir), out, _options(), extracted=True)
    return _rounded_attributes(spark.read.parquet(f"{out}/metrics/type2/attributes"))


#: Another sort column, both kinds of sorted lists and two exclusions.
LIST_SETTINGS = json.dumps({
    "types to parse": ["type2"],
    "link attributes sort parameter": "indeg",
    "output sorted lists by each attribute": "True",
    "output filtered sorted lists by each attribute": "True",
    "filter link attributes by top pagerank": "True",
    "top N of pagerank to filter": str(TOP_EXCLUDED),
    "filter custom URL list": "True",
    "URL filter list": list(EXCLUDED_URLS),
})
#: Ranks by PageRank hang on the last bit of sums, so their lists are left to ``sorted_lists_csv``.
EXACT_FEATURES = tuple(f for f in FEATURES if not f.startswith("pagerank"))


def _places(spark, folders: dict[str, str]) -> DataFrame:
    """(list, rank, url) of CSV rankings, by their lines' places in the files."""
    parts = [
        tables.read_csv(spark, path, ATTRIBUTES).select(
            F.lit(name).alias("list"), "url", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line")
        )
        for name, path in folders.items()
    ]
    lines = stage(reduce(DataFrame.unionByName, parts), "lines")
    placed = stage(with_position(lines, [F.col("list"), F.col("file"), F.col("line")], "place"), "places")
    first = placed.groupBy("list").agg(F.min("place").alias("first"))
    return placed.join(first, "list").select("list", (F.col("place") - F.col("first") + 1).alias("rank"), "url")


@query
def settings_run(spark, sf_dir):
    """A run with settings that ask for all lists, over a folder that also holds logs: where each URL
    stands in the rankings it writes."""
    source, out = _extracted_folder(spark, sf_dir), scratch_path(spark, "run")
    again = crawl_pages(spark, sf_dir).select(F.to_json(F.struct("url", "children")).alias("value"))
    again.write.mode("append").text(source)  # each task's file ends in txt, as logs do
    options = Options.from_json(LIST_SETTINGS, pagerank={"fixed_iters": STEPS})
    run_pipeline(spark, source, out, options, extracted=True)
    folder = f"{out}/metrics/type2"
    lists = {f"link_attributes_{kind}": f"{folder}/link_attributes_{kind}" for kind in ("filtered", "non_filtered")}
    for f in EXACT_FEATURES:
        lists |= {f"{f}_filtered": f"{folder}/sorted_filtered/{f}_filtered", f"{f}_non_filtered": f"{folder}/sorted/{f}_non_filtered"}
    return _places(spark, lists)


@query
def unreadable_settings_run(spark, sf_dir):
    """Settings that are no JSON give a run with the defaults."""
    out = scratch_path(spark, "run")
    with warnings.catch_warnings(action="ignore"):
        options = Options.from_json(LIST_SETTINGS[:-1], pagerank={"fixed_iters": STEPS})
    run_pipeline(spark, _extracted_folder(spark, sf_dir), out, options, extracted=True)
    return _places(spark, {"link_attributes_filtered": f"{out}/metrics/type2/link_attributes_filtered"})


@query
def index_files(spark, sf_dir):
    """The index that a run stores."""
    _, out = _run(spark, sf_dir)
    return stored.read_index(spark, f"{out}/metrics/type2/node_index").select("id", "name")


@query
def run_audit(spark, sf_dir):
    """The audit of a run, summed over its crawl files, of which each page is in one."""
    source, out = _run(spark, sf_dir)
    verdicts = audit_stage(spark, source, out, _options(), link_type="type2")
    pages_in = crawl.read_pages(spark, source).select("crawl_file").distinct()
    return verdicts.join(pages_in, "crawl_file").agg(
        F.count_if(~F.col("complete")).alias("failed"), F.sum(F.col("n_in") - F.col("n_out")).alias("missing")
    )


@query
def incremental_full_run(spark, sf_dir):
    """Two arrivals of crawl files, each followed by a run over what is new."""
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "run")
    rows = pages(spark, sf_dir)
    early = F.col("page_id") % 2 == 0
    for arrived in (rows.filter(early), rows.filter(~early)):
        _json_lines(arrived).write.mode("append").text(folder, compression="gzip")
        found = run_incremental(spark, folder, out, _options())
    return _rounded_attributes(found["type2"])


@query
def index_after_crash(spark, sf_dir):
    """Ids after two arrivals, between which a run has died: it left half a version and no copy."""
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "run")
    versions = f"{out}/metrics/type2/node_index_versions"
    rows = pages(spark, sf_dir)
    early = F.col("page_id") % 2 == 0
    for arrived in (rows.filter(early), rows.filter(~early)):
        _json_lines(arrived).write.mode("append").text(folder, compression="gzip")
        run_incremental(spark, folder, out, _options())
        if not index_versions.whole_versions(spark, versions, "delta"):
            half = arrived.select((-F.col("page_id")).alias("id"), F.col("url").alias("name"))
            half.write.parquet(f"{versions}/delta=1")
            ingest.delete_folders(spark, [f"{versions}/delta=1/_SUCCESS", f"{out}/metrics/type2/node_index"])
    return index_versions.read_versions(spark, versions)


# ---- unusual pages ---------------------------------------------------------------------


def _dirty_pages(spark, sf_dir) -> DataFrame:
    """Pages whose URL is missing, padded, encoded or too short, and whose links are missing."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(DIRTY_PAGES_SQL.replace("from orders", "from {orders}"), orders=orders)


@query
def dirty_pages(spark, sf_dir):
    """A missing URL stands for an error page."""
    return links.count_links(links.link_rows(links.clean_extracted(_dirty_pages(spark, sf_dir))))


@query
def dirty_pages_dropped(spark, sf_dir):
    """Pages without URL are left out; all others are known, with or without links."""
    rows = links.clean_extracted(_dirty_pages(spark, sf_dir), variant="current", on_missing_url="drop")
    return links.known_parents(rows)


# ---- streaming ---------------------------------------------------------------------------


def _stream(spark, sf_dir) -> DataFrame:
    # A pattern, because a stream reads folders or patterns: the table may be a file.
    return spark.readStream.schema(pages(spark, sf_dir).schema).parquet(f"{sf_dir}/pages.parque[t]")


def _ingested(spark, sf_dir) -> str:
    out = scratch_path(spark, "stream-links")
    ingest.ingest_links(
        _stream(spark, sf_dir),
        out,
        scratch_path(spark, "stream-checkpoint"),
        html_col="html",
        corrupt_col=None,
    ).awaitTermination()
    return out


@query
def incremental_links(spark, sf_dir):
    out = _ingested(spark, sf_dir)
    return links.link_rows(stored.read_page_links(spark, out, URL_TYPES))


@query
def incremental_edges(spark, sf_dir):
    arriving = ingest.stream_links(spark, _ingested(spark, sf_dir))
    out = scratch_path(spark, "stream-counts")
    ingest.ingest_edge_counts(
        arriving, out, scratch_path(spark, "stream-checkpoint")
    ).awaitTermination()
    return ingest.read_edge_counts(spark, out)


@query
def running_edges(spark, sf_dir):
    arriving = ingest.stream_links(spark, _ingested(spark, sf_dir))
    out = scratch_path(spark, "running-counts")
    ingest.keep_running_counts(
        arriving, out, scratch_path(spark, "stream-checkpoint")
    ).awaitTermination()
    return ingest.read_running_counts(spark, out).select(*links.EDGE_KEYS, "weight")


@query
def incremental_arrivals(spark, sf_dir):
    """Readable files arrive first, broken ones later; each run reads only what is new."""
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "stream-links")
    state, rows = scratch_path(spark, "stream-checkpoint"), pages(spark, sf_dir)
    for lines in (_json_lines(rows), _broken_lines(rows)):
        lines.write.mode("append").text(folder, compression="gzip")
        ingest.ingest_links(ingest.stream_pages(spark, folder), out, state).awaitTermination()
    schema = "parent_url string, child_links array<string>, bad_record string, link_type string"
    return _outcome(spark.read.schema(schema).parquet(out))


@query
def hosts_by_outlinks(spark, sf_dir):
    """Flagship: raw pages -> links -> hosts ranked by number of out-links."""
    rows = links.parse_pages(pages(spark, sf_dir), html_col="html", link_types=["type2"])
    edges = links.count_links(links.link_rows(rows))
    table = graph.degrees(edges).select(F.col("node").alias("url"), "outdeg", "uniqueout")
    return ranking.with_rank(table, "outdeg")


def queries() -> dict[str, Query]:
    return dict(_queries)
