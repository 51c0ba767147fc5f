"""Rankings of the attribute table and exclusion of unwanted sites.

Ties are broken by URL.  Exclusion removes rows after the metrics are computed on the
whole graph; it matches node names exactly, so lists must use the table's granularity.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.operators.attributes import FEATURES
from linkrank.operators.positions import with_position

DEFAULT_SORT = "outdeg"


def sort_attribute(name: str | None) -> str:
    return name if name in FEATURES else DEFAULT_SORT


def _order(by: str) -> list[Column]:
    return [F.desc(by), F.asc("url")]


def ranked(attributes: DataFrame, by: str | None = None) -> DataFrame:
    """Sorted by an attribute, largest first; an unknown attribute means ``outdeg``."""
    return attributes.orderBy(*_order(sort_attribute(by)))


def all_orders(attributes: DataFrame) -> DataFrame:
    """All rankings at once: a row for each attribute (``sorted_by``) and URL, by attribute, and
    within it as :func:`ranked`.

    One range sort, whose sample of the table gives the bounds of all attributes together; ties are
    cut by URL, so that no value has to fit in a task.
    """
    kinds = dict(attributes.dtypes)
    # Whole numbers keep a column of their own, in which they are exact.
    whole = lambda f: F.col(f).cast("bigint") if kinds[f] != "double" else F.lit(None).cast("bigint")
    real = lambda f: F.col(f) if kinds[f] == "double" else F.lit(None).cast("double")
    keys = [F.struct(F.lit(f).alias("sorted_by"), whole(f).alias("_whole"), real(f).alias("_real")) for f in FEATURES]
    rows = attributes.select(F.explode(F.array(*keys)).alias("_key"), "url", *FEATURES).select("_key.*", "url", *FEATURES)
    ordered = rows.orderBy("sorted_by", F.desc("_whole"), F.desc("_real"), F.asc("url"))
    return ordered.select("sorted_by", "url", *FEATURES)


def with_rank(attributes: DataFrame, by: str | None = None) -> DataFrame:
    """Add ``rank`` (1 = largest) without bringing the table to one task."""
    return with_position(attributes, _order(sort_attribute(by)), "rank", start=1)


def top(attributes: DataFrame, n: int, by: str = "pagerank") -> DataFrame:
    return attributes.orderBy(*_order(by)).limit(n)


def exclude_listed(attributes: DataFrame, urls: DataFrame) -> DataFrame:
    """Leave out the URLs of a table; Spark broadcasts it if it is small enough."""
    return attributes.join(urls.select("url").distinct(), "url", "left_anti")


def exclude_urls(attributes: DataFrame, urls: Iterable[str]) -> DataFrame:
    """A null in the list excludes nothing, whatever the length of the list."""
    urls = [u for u in urls if u is not None]
    if not urls:
        return attributes
    listed = attributes.sparkSession.createDataFrame([(u,) for u in urls], "url string")
    return exclude_listed(attributes, listed)


def exclude_top(attributes: DataFrame, n: int, by: str = "pagerank") -> DataFrame:
    """Leave out the ``n`` largest; only the names of these ``n`` rows take part in the join."""
    return exclude_listed(attributes, top(attributes, n, by)) if n > 0 else attributes
