"""Link-graph analytics of web crawls on Spark DataFrames."""

from linkrank.operators.attributes import FEATURES, url_attributes
from linkrank.operators.audit import completeness_audit, completeness_totals, pending_inputs
from linkrank.operators.graph import (
    build_index,
    decode_edges,
    degrees,
    edge_table,
    encode_edges,
    extend_index,
    graph_nodes,
    node_connectivity,
)
from linkrank.operators.links import (
    clean_extracted as clean_links,
    count_links,
    link_rows,
    list_raw_links,
    merge_edges,
    parse_pages as parse_links,
)
from linkrank.operators.pagerank import NotConverged, pagerank
from linkrank.operators.ranking import (
    exclude_listed,
    exclude_top,
    exclude_urls,
    ranked,
    top,
    with_rank,
)
from linkrank.operators.staging import clear_scratch
from linkrank.options import Options
from linkrank.plans.full_run import audit_stage, exclude, run_incremental, run_pipeline
from linkrank.plans.index_versions import read_versions as read_index_versions
from linkrank.plans.stored_graph import export_edge_table, rerank_stored

__all__ = [
    "FEATURES",
    "NotConverged",
    "Options",
    "audit_stage",
    "build_index",
    "clean_links",
    "clear_scratch",
    "completeness_audit",
    "completeness_totals",
    "count_links",
    "decode_edges",
    "degrees",
    "edge_table",
    "encode_edges",
    "exclude",
    "exclude_listed",
    "exclude_top",
    "exclude_urls",
    "export_edge_table",
    "extend_index",
    "graph_nodes",
    "link_rows",
    "list_raw_links",
    "merge_edges",
    "node_connectivity",
    "pagerank",
    "parse_links",
    "pending_inputs",
    "ranked",
    "read_index_versions",
    "rerank_stored",
    "run_incremental",
    "run_pipeline",
    "top",
    "url_attributes",
    "with_rank",
]
