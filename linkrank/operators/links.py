"""From crawled pages to link rows and weighted edges.

Shapes:
  page links  (parent_url, child_links array, link_type)   one row per page and type
  links       (link_type, src, dst)                        one row per link
  edges       (link_type, src, dst, weight)                distinct pairs with counts

Everything up to ``links`` works row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions.html import extract_hrefs
from linkrank.functions.urls import (
    LINK_TYPES,
    check_names,
    clean_parent,
    host_name,
    page_name,
    registered_domain,
    resolve_child,
    unquote,
)

EDGE_KEYS = ["link_type", "src", "dst"]
CORRUPT = "corrupt"  # link_type under which unreadable input rows are kept


def drop_index_rows(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Keep the rows that carry a page URL."""
    return pages.filter(F.col(url_col).isNotNull())


def _accepted(
    pages: DataFrame, url_col: str, on_missing_url: str, corrupt_col: str | None
) -> DataFrame:
    if on_missing_url == "drop":
        if corrupt_col is None:
            return drop_index_rows(pages, url_col)
        return pages.filter(F.col(url_col).isNotNull() | F.col(corrupt_col).isNotNull())
    if on_missing_url == "error_url":
        return pages
    raise ValueError("on_missing_url must be 'drop' or 'error_url'")


def list_raw_links(
    pages: DataFrame,
    url_col: str = "cleaned_url",
    html_col: str = "raw_content",
) -> DataFrame:
    """Every href of every page, as found: (parent_url, links array)."""
    hrefs = extract_hrefs(F.col(html_col))
    return pages.select(F.col(url_col).alias("parent_url"), hrefs.alias("links"))


def _page_links(
    pages: DataFrame,
    url: Column,
    hrefs: Column,
    link_types: Iterable[str],
    variant: str,
    corrupt_col: str | None,
    keep: Iterable[str],
) -> DataFrame:
    link_types, keep = list(link_types), list(keep)
    check_names(link_types, variant)
    parent, corrupt = F.col("parent"), F.col("corrupt")
    decoded = pages.select(
        *keep,
        clean_parent(url).alias("parent"),
        F.transform(hrefs, unquote).alias("decoded"),
        (F.col(corrupt_col) if corrupt_col else F.lit(None).cast("string")).alias("corrupt"),
    )
    children = F.filter(
        F.transform("decoded", lambda href: resolve_child(parent, href)),
        lambda child: child.isNotNull(),
    )
    cleaned = decoded.select(*keep, "parent", children.alias("children"), "corrupt")
    # Hosts are worked out once and serve both type2 and type3.
    hosts = cleaned.select(
        "*",
        host_name(parent, variant).alias("parent_host"),
        F.transform("children", lambda child: host_name(child, variant)).alias("child_hosts"),
    )
    names = {
        "type1": (
            page_name(parent, variant),
            F.transform("children", lambda child: page_name(child, variant)),
        ),
        "type2": (F.col("parent_host"), F.col("child_hosts")),
        "type3": (
            registered_domain(F.col("parent_host")),
            F.transform("child_hosts", registered_domain),
        ),
    }
    records = [
        F.struct(
            names[t][0].alias("parent_url"),
            names[t][1].alias("child_links"),
            corrupt.alias("bad_record"),
            F.lit(t).alias("link_type"),
        )
        for t in link_types
    ]
    if corrupt_col is None:
        return hosts.select(*keep, F.inline(F.array(*records))).drop("bad_record")
    rejected = F.struct(
        F.lit(None).cast("string").alias("parent_url"),
        F.lit(None).cast("array<string>").alias("child_links"),
        corrupt.alias("bad_record"),
        F.lit(CORRUPT).alias("link_type"),
    )
    return hosts.select(
        *keep, F.inline(F.when(corrupt.isNull(), F.array(*records)).otherwise(F.array(rejected)))
    )


def parse_pages(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "raw_content",
    link_types: Iterable[str] = LINK_TYPES,
    on_missing_url: str = "drop",
    corrupt_col: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Raw pages -> page links at the wanted granularities, in one pass over the HTML.

    Pages without usable HTML stay, with no child links.  With ``corrupt_col`` (the text of
    rows that could not be parsed) such rows come out in the same pass, once each, with
    ``link_type = 'corrupt'`` and their text in ``bad_record``.
    """
    pages = _accepted(pages, url_col, on_missing_url, corrupt_col)
    hrefs = extract_hrefs(F.col(html_col))
    return _page_links(pages, F.col(url_col), hrefs, link_types, "current", corrupt_col, keep)


def clean_extracted(
    pages: DataFrame,
    *,
    url_col: str = "url",
    children_col: str = "children",
    link_types: Iterable[str] = LINK_TYPES,
    variant: str = "legacy",
    on_missing_url: str = "error_url",
    corrupt_col: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Pages whose links are already extracted -> page links."""
    pages = _accepted(pages, url_col, on_missing_url, corrupt_col)
    hrefs = F.coalesce(
        F.filter(children_col, lambda href: href.isNotNull()), F.array().cast("array<string>")
    )
    return _page_links(pages, F.col(url_col), hrefs, link_types, variant, corrupt_col, keep)


def _decoded_hrefs(rows: DataFrame, parent: str, href: str, keep: Iterable[str]) -> DataFrame:
    return rows.select(
        *keep, clean_parent(F.col(parent)).alias("parent"), unquote(F.col(href)).alias("decoded")
    )


def clean_href_rows(
    rows: DataFrame, parent: str = "parent_url", href: str = "href", keep: Iterable[str] = ()
) -> DataFrame:
    """One row per href -> (``keep`` columns, parent, child) for the hrefs that are page links.

    Rows are dropped by exploding a NULL array, not by a filter: Spark would push a filter
    below the cleaning and run the cleaning twice.
    """
    decoded = _decoded_hrefs(rows, parent, href, keep)
    child = resolve_child(F.col("parent"), F.col("decoded"))
    return decoded.select(*keep, "parent", child.alias("child")).select(
        *keep, "parent", F.explode(F.when(F.col("child").isNotNull(), F.array("child"))).alias("child")
    )


def links_from_href_rows(
    rows: DataFrame,
    parent: str = "parent_url",
    href: str = "href",
    *,
    link_types: Iterable[str] = LINK_TYPES,
    variant: str = "current",
    keep: Iterable[str] = (),
) -> DataFrame:
    """One row per href -> links, one per requested type, in a single pass."""
    link_types = list(link_types)
    check_names(link_types, variant)
    cleaned = _decoded_hrefs(rows, parent, href, keep).select(
        *keep, "parent", resolve_child(F.col("parent"), F.col("decoded")).alias("child")
    )
    hosts = cleaned.select(
        "*",
        host_name(F.col("parent"), variant).alias("parent_host"),
        host_name(F.col("child"), variant).alias("child_host"),
    )

    def name(end: str, link_type: str) -> Column:
        if link_type == "type1":
            return page_name(F.col(end), variant)
        host = F.col(f"{end}_host")
        return host if link_type == "type2" else registered_domain(host)

    records = [
        F.struct(
            F.lit(t).alias("link_type"), name("parent", t).alias("src"), name("child", t).alias("dst")
        )
        for t in link_types
    ]
    return hosts.select(*keep, F.inline(F.when(F.col("child").isNotNull(), F.array(*records))))


def select_types(rows: DataFrame, link_types: Iterable[str]) -> DataFrame:
    """Only these granularities; on a table partitioned by type this prunes folders."""
    return rows.filter(F.col("link_type").isin(*link_types))


def link_rows(page_links: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    return page_links.select(
        *keep, "link_type", F.col("parent_url").alias("src"), F.explode("child_links").alias("dst")
    )


def _usable_parent(name: str) -> Column:
    return F.length(name) > 1


def count_links(links: DataFrame, extra_keys: Iterable[str] = ()) -> DataFrame:
    """Weighted edges; parents with a name of at most one character are left out.

    ``extra_keys`` (say, the crawl file) are counted apart.  Counting is partial before the
    shuffle, so a link repeated over a third of the crawl costs one row per task.
    """
    return (
        links.filter(_usable_parent("src"))
        .groupBy(*extra_keys, *EDGE_KEYS)
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def merge_edges(*counts: DataFrame) -> DataFrame:
    """Sum counts of the same edge, over any number of tables or files."""
    rows = reduce(
        DataFrame.unionByName, [c.select(*EDGE_KEYS, F.col("weight")) for c in counts]
    )
    return rows.groupBy(*EDGE_KEYS).agg(F.sum("weight").alias("weight"))


def known_parents(page_links: DataFrame) -> DataFrame:
    """Distinct pages per type, with or without links."""
    return (
        page_links.filter(_usable_parent("parent_url"))
        .select("link_type", F.col("parent_url").alias("src"))
        .distinct()
    )


def linkless_parents(page_links: DataFrame, extra_keys: Iterable[str] = ()) -> DataFrame:
    """Pages none of whose copies kept a link; one aggregation, no self-join.

    With ``extra_keys`` (say, the crawl file), none of the copies there.
    """
    keys = list(extra_keys)
    return (
        page_links.filter(_usable_parent("parent_url"))
        .groupBy(*keys, "link_type", F.col("parent_url").alias("src"))
        .agg(F.max(F.size("child_links")).alias("links"))
        .filter(F.col("links") == 0)
        .select(*keys, "link_type", "src")
    )
