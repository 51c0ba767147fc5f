"""Settings of a full run."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field

from linkrank.functions.urls import LINK_TYPES

# Keys of the JSON settings file.
_KEYS = {
    "types": "types to parse",
    "sort_by": "link attributes sort parameter",
    "write_sorted": "output sorted lists by each attribute",
    "write_sorted_filtered": "output filtered sorted lists by each attribute",
    "use_top": "filter link attributes by top pagerank",
    "top_n": "top N of pagerank to filter",
    "use_urls": "filter custom URL list",
    "urls": "URL filter list",
    "use_path": "filter custom URL from files",
    "path": "custom URL list file or directory",
}


def _is_true(value) -> bool:
    return str(value).lower() == "true"


@dataclass(frozen=True)
class Options:
    """Defaults run everything for hosts and leave nothing out."""

    link_types: tuple[str, ...] = ("type2",)  # counted and ranked
    parse_types: tuple[str, ...] = LINK_TYPES  # written by the parse stage
    sort_by: str = "outdeg"
    write_sorted: bool = True
    write_sorted_filtered: bool = True
    write_connectivity: bool = True  # the graph once more, as JSON maps
    exclude_top_pagerank: int = 0
    exclude_urls: tuple[str, ...] = ()
    exclude_path: str | None = None
    url_col: str = "url"
    html_col: str = "raw_content"
    on_missing_url: str | None = None  # None: drop for raw pages, error URL for extracted links
    encode_nodes: bool = True
    previous_run: str | None = None  # output folder of an earlier run whose node ids stay
    min_partitions: int | None = None
    spread_above: int | None = None  # bytes of a gzip file above which its rows are spread
    gzip_range_bytes: int | None = None  # gzip files written by write_crawl: bytes of a task
    fail_fast: bool = False
    pagerank: dict = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str, **more) -> Options:
        """Read the JSON settings of earlier crawls; ``more`` sets what they cannot say.

        Text that is no JSON object gives the defaults, with a warning.
        """
        try:
            given = json.loads(text)
            if not isinstance(given, dict):
                raise ValueError("not an object")
        except ValueError as problem:
            warnings.warn(f"unreadable settings, defaults are used: {problem}", stacklevel=2)
            return cls(**more)

        def value(name, default=None):
            return given.get(_KEYS[name], default)

        settings = {
            "link_types": tuple(value("types", cls.link_types)),
            "sort_by": value("sort_by", cls.sort_by),
            "write_sorted": _is_true(value("write_sorted", False)),
            "write_sorted_filtered": _is_true(value("write_sorted_filtered", False)),
            "exclude_top_pagerank": int(value("top_n", 0)) if _is_true(value("use_top")) else 0,
            "exclude_urls": tuple(value("urls", ())) if _is_true(value("use_urls")) else (),
            "exclude_path": value("path") if _is_true(value("use_path")) else None,
        }
        return cls(**{**settings, **more})
