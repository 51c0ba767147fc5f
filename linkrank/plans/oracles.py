"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

from linkrank.operators.attributes import FEATURES
from linkrank.plans import catalogue as c
from linkrank.plans.crawl_view import CRAWL_LINKS_SQL, DIRTY_PAGES_SQL


def _unquote(url: str) -> str:
    for _ in range(5):
        url = f"url_decode({url})"
    return url


def _page(url: str, variant: str) -> str:
    cut = f"split_part(split_part({url}, '?', 1), ';', 1)"
    return cut if variant == "legacy" else f"replace({cut}, 'www.', '')"


def _host(url: str, variant: str) -> str:
    for scheme in ("http://", "https://", "http:/", "https:/"):
        url = f"replace({url}, '{scheme}', '')"
    host = f"split_part({url}, '/', 1)"
    if variant == "legacy":
        return host
    return f"replace(split_part(split_part({host}, '?', 1), '#', 1), 'www.', '')"


def _domain(url: str, variant: str) -> str:
    host = _host(url, variant)
    return (
        f"array_to_string(case when contains({host}, '.co.') then string_split({host}, '.')[-3:]"
        f" else string_split({host}, '.')[-2:] end, '.')"
    )


_DIRTY = DIRTY_PAGES_SQL.replace("array(", "list_value(")

_NAME = {"type1": _page, "type2": _host, "type3": _domain}


def _name(url: str, link_type: str, variant: str = "current") -> str:
    return _NAME[link_type](url, variant)


_PARENT = f"split_part(ltrim({_unquote('trim(parent_url)')}), ' ', 1)"

# crawl -> decoded -> cleaned(page_key, pos, crawl_file, parent, child)
_CLEANED = f"""
crawl as ({CRAWL_LINKS_SQL}),
decoded as (select page_key, pos, crawl_file, {_PARENT} as parent, {_unquote("href")} as d from crawl),
cleaned as (
  select page_key, pos, crawl_file, parent, case when starts_with(d, '/')
         then parent || split_part(d, ' ', 1) else split_part(d, ' ', 1) end as child
  from decoded where starts_with(d, '/') or starts_with(d, 'http'))
"""

_PAGE_HREFS = """
hrefs as (
  select url as parent, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as d,
         generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 as pos
  from pages),
page_cleaned as (
  select parent, case when starts_with(d, '/') then parent || split_part(d, ' ', 1)
         else split_part(d, ' ', 1) end as child
  from hrefs where starts_with(d, '/') or starts_with(d, 'http'))
"""


def _links(types=c.URL_TYPES, variant="current", extra="", source="cleaned") -> str:
    return " union all ".join(
        f"select {extra} '{t}' as link_type, {_name('parent', t, variant)} as src,"
        f" {_name('child', t, variant)} as dst from {source}"
        for t in types
    )


def _edge_ctes(link_type: str = "type2") -> str:
    return f"""{_CLEANED},
edges as (
  select src, dst, count(*) as weight from ({_links([link_type])}) where length(src) > 1
  group by src, dst)"""


_DEGREES = """
nodes as (select src as node from edges union select dst from edges),
outs as (select src as node, sum(weight)::bigint as outdeg, count(*) as uniqueout from edges group by src),
ins as (select dst as node, sum(weight)::bigint as indeg, count(*) as uniquein from edges group by dst),
degrees as (
  select node, coalesce(outdeg, 0) as outdeg, coalesce(indeg, 0) as indeg,
         coalesce(uniqueout, 0) as uniqueout, coalesce(uniquein, 0) as uniquein
  from nodes left join outs using (node) left join ins using (node)),
ratios as (
  select *, case when outdeg = 0 then 0.0 else indeg::double / outdeg end as in_out_ratio,
         case when uniqueout = 0 then 0.0 else uniquein::double / uniqueout end as uin_uout_ratio
  from degrees)
"""


def _walk_sql(name: str, weighted: bool, steps: int = c.STEPS, until_settled: bool = False) -> str:
    """Power iteration as a recursive query; the result is its last step, or the first whose
    summed change is below 1e-6 for each node."""
    last = str(steps)
    if until_settled:
        last = (
            f"(select min(step) from (select x.step, sum(abs(x.r - y.r)) as change from {name}_walk x"
            f" join {name}_walk y on y.step = x.step - 1 and y.node = x.node group by x.step)"
            " where change < 1e-6 * (select count(*) from nodes))"
        )
    share = "weight" if weighted else "1"
    return f"""
{name}_trans as (
  select e.src, e.dst, ({share})::double / o.total as p
  from edges e join (select src, sum({share}) as total from edges group by src) o using (src)),
{name}_walk as (
  select 0 as step, node, 1.0::double / (select count(*) from nodes) as r from nodes
  union all
  select s.step + 1, s.node,
         0.15::double / (select count(*) from nodes)
         + 0.85::double * s.idle / (select count(*) from nodes)
         + 0.85::double * coalesce(i.inflow, 0)
  from (select step, node, sum(case when node not in (select src from edges) then r else 0 end)
               over () as idle from {name}_walk) s
  left join (select t.dst as node, sum(w.r * t.p) as inflow
             from {name}_walk w join {name}_trans t on t.src = w.node group by t.dst) i
         on i.node = s.node
  where s.step < {steps}),
{name}_rank as (select node, r as {name} from {name}_walk where step = {last})"""


_WEIGHTED = _walk_sql("pagerank", True)
_UNWEIGHTED = _walk_sql("pagerank_noweight", False)


def _r(name: str) -> str:
    return f"round({name}, {c.DIGITS}) as {name}"


def _with(ctes: str, select: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes} {select}"


_ATTRIBUTES = f"""{_DEGREES}, {_WEIGHTED}, {_UNWEIGHTED},
attributes as (
  select node as url, uniqueout, uniquein, outdeg, indeg, {_r("uin_uout_ratio")},
         {_r("in_out_ratio")}, {_r("pagerank")}, {_r("pagerank_noweight")}
  from ratios join pagerank_rank using (node) join pagerank_noweight_rank using (node))"""

_TOP = f"(select url from attributes order by pagerank desc, url limit {c.TOP_EXCLUDED})"
_LIST = "(" + ", ".join(f"'{u}'" for u in c.EXCLUDED_URLS) + ")"
_FILE = "(select distinct concat('site', s_suppkey % 10, '.example.com') from supplier)"


def _attr_sql(select: str, link_type: str = "type2") -> str:
    return _with(f"{_edge_ctes(link_type)}, {_ATTRIBUTES}", select, recursive=True)


def _rank(by: str) -> str:
    return f"row_number() over (order by {by} desc, url)"


_AUDIT = f"""{_CLEANED},
n_in as (select crawl_file, count(distinct {_name(_PARENT, "type1")}) as n_in from crawl group by 1),
n_out as (select crawl_file, count(distinct {_name("parent", "type1")}) as n_out from cleaned group by 1),
audit as (
  select crawl_file, n_in, coalesce(n_out, 0) as n_out,
         (n_in - coalesce(n_out, 0))::double / n_in * 100.0 as missing_pct
  from n_in left join n_out using (crawl_file)),
verdict as (select *, missing_pct <= 6.0 as complete from audit)"""

_PARENT_NAMES = {
    t: f"select distinct {_name(_PARENT, t)} as src from crawl where length({_name(_PARENT, t)}) > 1"
    for t in c.URL_TYPES
}


def oracle_sql() -> dict[str, str]:
    edge_counts = "select link_type, src, dst, count(*) as weight from ({}) where length(src) > 1 group by all"
    page_links = _with(_PAGE_HREFS, _links(source="page_cleaned"))
    page_extract = _with(_PAGE_HREFS, "select parent as parent_url, pos::integer as pos, d as href from hrefs")
    counts = _with(_CLEANED, edge_counts.format(_links()))
    weighted = _with(f"{_edge_ctes()}, {_DEGREES}, {_WEIGHTED}", "", True)
    unweighted = _with(f"{_edge_ctes()}, {_DEGREES}, {_UNWEIGHTED}", "", True)

    page_edges = f"""{_PAGE_HREFS}, edges as (
  select src, dst, count(*) as weight from ({_links(["type2"], source="page_cleaned")})
  where length(src) > 1 group by src, dst)"""
    page_attributes = _with(f"{page_edges}, {_ATTRIBUTES}", "select * from attributes", True)
    legacy_edges = f"""{_CLEANED}, edges as (
  select src, dst, count(*) as weight from ({_links(["type2"], "legacy")})
  where length(src) > 1 group by src, dst)"""
    settled = ", ".join(
        _walk_sql(name, weighted, 100, True)
        for name, weighted in (("pagerank", True), ("pagerank_noweight", False))
    )
    dirty = f"""dirty as ({_DIRTY}),
dirty_decoded as (
  select coalesce({_PARENT.replace("parent_url", "url")}, 'http://www.error.com') as parent,
         url, children from dirty),
dirty_cleaned as (
  select parent, case when starts_with(d, '/') then parent || split_part(d, ' ', 1)
         else split_part(d, ' ', 1) end as child
  from (select parent, unnest(children) as d from dirty_decoded)
  where starts_with(d, '/') or starts_with(d, 'http'))"""

    outcome = _with(
        _PAGE_HREFS,
        " union all ".join(
            f"select '{t}' as link_type, {_name('url', t)} as parent_url,"
            " len(list_filter(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda h:"
            " starts_with(h, '/') or starts_with(h, 'http')))::integer as links,"
            " null::varchar as bad_record from pages"
            for t in c.URL_TYPES
        )
        + " union all select 'corrupt', null, null, concat('{\"url\": ', url) from pages",
    )

    sql = {
        "full_run": page_attributes,
        "incremental_full_run": page_attributes,
        "extracted_scan": _with(_CLEANED, "select parent_url as url, href from crawl"),
        "full_run_extracted": _with(f"{legacy_edges}, {_ATTRIBUTES}", "select * from attributes", True),
        "settings_run": _with(
            f"{legacy_edges}, {_ATTRIBUTES}, kept as (select * from ratios where node not in {_TOP} and node not in {_LIST})",
            " union all ".join(
                f"select '{name}_{kind}' as list, row_number() over (order by {by} desc, node) as rank, node as url from {source}"
                for kind, source in (("filtered", "kept"), ("non_filtered", "ratios"))
                for name, by in (("link_attributes", "indeg"), *((f, f) for f in c.EXACT_FEATURES))
            ),
            True,
        ),
        "unreadable_settings_run": _with(
            f"{legacy_edges}, {_ATTRIBUTES}",
            "select 'link_attributes_filtered' as list, row_number() over (order by outdeg desc, node) as rank,"
            " node as url from ratios",
            True,
        ),
        "index_files": _with(
            f"{page_edges}, names as (select src as name from edges union select dst from edges"
            f" union select {_name('url', 'type2')} from pages)",
            "select row_number() over (order by name) - 1 as id, name from names",
        ),
        "index_after_crash": _with(
            f"{page_edges}, names as (select src as name from edges union select dst from edges"
            f" union select {_name('url', 'type2')} from pages),"
            f" early as (select distinct {_name('url', 'type2')} as name from pages where page_id % 2 = 0)",
            "select row_number() over (order by early.name is null, names.name) - 1 as id, names.name"
            " from names left join early on names.name = early.name",
        ),
        "run_audit": "select 0::bigint as failed, 0::bigint as missing",
        "dirty_pages": _with(dirty, edge_counts.format(_links(variant="legacy", source="dirty_cleaned"))),
        "dirty_pages_dropped": _with(
            dirty,
            " union all ".join(
                f"select distinct '{t}' as link_type, {_name('parent', t)} as src from dirty_decoded"
                f" where url is not null and length({_name('parent', t)}) > 1"
                for t in c.URL_TYPES
            ),
        ),
        "pagerank_converged": _with(
            f"{_edge_ctes()}, {_DEGREES}, {settled}",
            f"select node, {_r('pagerank')}, {_r('pagerank_noweight')}"
            " from pagerank_rank join pagerank_noweight_rank using (node)",
            True,
        ),
        "exclude_long_list": _attr_sql(
            f"select * from attributes where url not in (select 'site' || i || '.example.com'"
            f" from range(2, {c.LONG_LIST}) t(i))"
        ),
        "quarantined_rows": outcome,
        "incremental_arrivals": outcome,
        "ingest_rows": "select page_id, url, length(html)::integer as html_chars from pages where url is not null",
        "crawl_json_scan": "select url, length(html)::integer as html_chars from pages",
        "extract_links": page_extract,
        "extract_links_parser": page_extract,
        "extract_links_markup": f"select page_key, pos, href from ({CRAWL_LINKS_SQL})",
        "unquote_urls": _with(_CLEANED, "select page_key, pos, d as decoded from decoded"),
        "clean_parents": _with(_CLEANED, "select distinct page_key, parent from decoded"),
        "clean_children": _with(_CLEANED, "select page_key, pos, parent, child from cleaned"),
        "link_dispositions": _with(
            _CLEANED,
            "select case when starts_with(d, '/') then 'internal' when starts_with(d, 'http')"
            " then 'external' else 'dropped' end as disposition, count(*) as links"
            " from decoded group by 1",
        ),
        "normalize_legacy": _with(_CLEANED, _links(variant="legacy", extra="page_key, pos,")),
        "links_all_types": page_links,
        "page_links_json": page_links,
        "preextracted_links": _with(_CLEANED, edge_counts.format(_links(variant="legacy"))),
        "linkless_parents": _with(
            _CLEANED,
            " union all ".join(
                f"select distinct crawl_file, '{t}' as link_type, {_name(_PARENT, t)} as src from crawl"
                f" where length({_name(_PARENT, t)}) > 1 and (crawl_file, {_name(_PARENT, t)}) not in"
                f" (select (crawl_file, {_name('parent', t)}) from cleaned)"
                for t in c.URL_TYPES
            ),
        ),
        "link_counts": counts,
        "link_counts_per_file": _with(
            _CLEANED,
            "select crawl_file, link_type, src, dst, count(*) as weight from"
            f" ({_links(['type3'], extra='crawl_file,')}) where length(src) > 1 group by all",
        ),
        "edge_merge": _with(
            f"{_CLEANED}, {_PAGE_HREFS}",
            edge_counts.format(f"{_links()} union all {_links(source='page_cleaned')}"),
        ),
        "edges_by_type": _with(_CLEANED, edge_counts.format(_links(["type2", "type3"]))),
        "edges_from_map": _with(_edge_ctes("type1"), "select src, dst, weight from edges"),
        "parents_from_map": _with(_CLEANED, _PARENT_NAMES["type1"]),
        "node_connectivity": _with(
            f"""{_edge_ctes()},
sized as (select *, count(*) over (partition by src) as n from edges),
sliced as (
  select src, dst, weight, (case when n > {c.CHILDREN_PER_MAP}
         then ('0x' || substr(md5(dst), 1, 8))::bigint % ceil(n / {c.CHILDREN_PER_MAP}.0)::bigint
         else 0 end)::integer as slice
  from sized)""",
            "select src, slice, string_agg(dst || '=' || weight, ',' order by dst || '=' || weight)"
            " as children from sliced group by src, slice",
        ),
        "graph_nodes": _with(
            _edge_ctes("type1"), "select src as name from edges union select dst from edges"
        ),
        "node_index": _with(
            f"{_edge_ctes('type1')}, names as (select src as name from edges union"
            f" select dst from edges union {_PARENT_NAMES['type1']})",
            "select row_number() over (order by name) - 1 as id, name from names",
        ),
        "index_extend": _with(
            f"{_edge_ctes('type1')}, old as (select distinct src as name from edges),"
            " fresh as (select dst as name from edges except select name from old)",
            "select row_number() over (order by name) - 1 as id, name from old union all"
            " select row_number() over (order by name) - 1 + (select count(*) from old), name from fresh",
        ),
        "edges_encoded": _with(
            f"{_edge_ctes('type1')}, names as (select src as name from edges union select dst"
            " from edges), ids as (select row_number() over (order by name) - 1 as id, name from names)",
            "select s.id as src_id, d.id as dst_id, weight from edges join ids s on s.name = src"
            " join ids d on d.name = dst",
        ),
        "edges_decoded": _with(_edge_ctes("type1"), "select src, dst, weight from edges"),
        "degrees": _with(f"{_edge_ctes('type1')}, {_DEGREES}", "select * from degrees"),
        "degree_ratios": _with(
            f"{_edge_ctes('type1')}, {_DEGREES}",
            f"select node, {_r('in_out_ratio')}, {_r('uin_uout_ratio')} from ratios",
        ),
        "graph_summary": _with(
            f"{_edge_ctes()}, parents as ({_PARENT_NAMES['type2']}), names as (select src as name"
            " from edges union select dst from edges union select src from parents)",
            "select (select count(*) from names) as names, (select count(*) from edges) as edges,"
            " (select sum(weight) from edges)::bigint as links, (select count(*) from parents) as parents",
        ),
        "pagerank_weighted": weighted + f"select node, {_r('pagerank')} from pagerank_rank",
        "pagerank_sliced_hubs": weighted + f"select node, {_r('pagerank')} from pagerank_rank",
        "pagerank_unweighted": unweighted
        + f"select node, {_r('pagerank_noweight')} from pagerank_noweight_rank",
        "attributes_type2": _attr_sql("select * from attributes"),
        "attributes_type1_encoded": _attr_sql("select * from attributes", "type1"),
        "ranked_sites": _attr_sql(f"select *, {_rank('outdeg')} as rank from attributes"),
        "ranked_csv": _attr_sql("select * from attributes"),
        "top_pagerank": _attr_sql(
            f"select {_rank('pagerank')} as rank, url, pagerank from attributes"
            f" order by pagerank desc, url limit {c.TOP_N}"
        ),
        "sorted_lists_csv": _attr_sql(
            " union all ".join(
                f"select '{f}' as sorted_by, {_rank(f)} as rank, url, {f}::double as value from attributes"
                for f in FEATURES
            )
        ),
        "rerank_from_edges": _attr_sql(
            " union all ".join(
                f"select '{f}' as sorted_by, {_rank(f)} as rank, url, {f}::double as value from attributes"
                for f in FEATURES
            )
        ),
        "exclude_top_pagerank": _attr_sql(f"select * from attributes where url not in {_TOP}"),
        "exclude_url_list": _attr_sql(f"select * from attributes where url not in {_LIST}"),
        "exclude_url_file": _attr_sql(f"select * from attributes where url not in {_FILE}"),
        "ranked_sites_filtered": _attr_sql(
            f"select *, {_rank('outdeg')} as rank from attributes where url not in {_TOP}"
            f" and url not in {_LIST} and url not in {_FILE}"
        ),
        "completeness_audit": _with(
            _AUDIT, f"select crawl_file, n_in, n_out, {_r('missing_pct')}, complete from verdict"
        ),
        "audit_log": _with(
            _AUDIT, f"select crawl_file, n_in, n_out, {_r('missing_pct')}, complete from verdict"
        ),
        "completeness_totals": _with(
            _AUDIT,
            "select count(*) as files, count(*) filter (complete) as passed,"
            " count(*) filter (not complete) as failed from verdict",
        ),
        "files_to_reprocess": _with(_AUDIT, "select crawl_file from verdict where not complete"),
        "pending_inputs": _with(
            _AUDIT, "select crawl_file || '.jl.gz' as file_name from verdict where not complete"
        ),
        "incremental_links": page_links,
        "incremental_edges": _with(_PAGE_HREFS, edge_counts.format(_links(source="page_cleaned"))),
        "running_edges": _with(_PAGE_HREFS, edge_counts.format(_links(source="page_cleaned"))),
        "hosts_by_outlinks": _with(
            f"{_PAGE_HREFS}, edges as (select src, dst, count(*) as weight from"
            f" ({_links(['type2'], source='page_cleaned')}) where length(src) > 1 group by src, dst),"
            f" {_DEGREES}",
            "select node as url, outdeg, uniqueout, row_number() over (order by outdeg desc, node)"
            " as rank from degrees",
        ),
    }
    sql |= {
        "edges_from_one_line": sql["edges_from_map"],
        "parents_from_one_line": sql["parents_from_map"],
        "index_import": sql["node_index"],
        "gzip_ranges_scan": sql["crawl_json_scan"],
        "pending_files": "select 'crawl' || n || '.jl.gz' as file_name from unnest([0, 3]) as t(n)",
        "failed_files": f"""
select 1 as run, 'crawl' || page_id % {c.FILES} || '.jl.gz' as file, page_id % {c.FILES} = 2 as failed,
       case when page_id % {c.FILES} = 2 then 0 else count(url) end as pages from pages group by page_id % {c.FILES}
union all select 2, 'crawl2.jl.gz', false, count(url) from pages where page_id % {c.FILES} = 2""",
        "rerank_one_line": sql["attributes_type2"],
    }
    for t in c.URL_TYPES:
        sql[f"normalize_{t}"] = _with(
            _CLEANED,
            f"select page_key, pos, {_name('parent', t)} as src, {_name('child', t)} as dst from cleaned",
        )
    for name, link_type in (("non_dangling_edges", "type1"), ("edge_table_csv", "type2"), ("export_one_line", "type2")):
        sql[name] = _with(
            _edge_ctes(link_type),
            "select src, dst, weight, dstcount from edges join (select dst, count(*) as dstcount"
            " from edges group by dst having count(*) > 1) using (dst)",
        )
    for f in FEATURES:
        if f.startswith("pagerank"):
            head = weighted if f == "pagerank" else unweighted
            sql[f"rank_by_{f}"] = (
                head + f"select *, {_rank(f)} as rank from (select node as url, {_r(f)} from {f}_rank)"
            )
        else:
            sql[f"rank_by_{f}"] = _with(
                f"{_edge_ctes('type1')}, {_DEGREES}",
                f"select *, {_rank(f)} as rank from (select node as url,"
                f" {_r(f) if 'ratio' in f else f} from ratios)",
            )
    return sql
