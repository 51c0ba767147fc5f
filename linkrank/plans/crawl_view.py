"""Crawl-shaped inputs taken from the test tables.

``pages`` is raw HTML.  All its links are internal, so graph queries read
``CRAWL_LINKS_SQL``, a view over ``lineitem`` and ``orders`` with one row per href:
internal, external, percent-encoded, malformed and dropped links over many sites.  An
order is a page, its line items are the links, and the order date names the crawl file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same text runs in Spark SQL and in DuckDB.
CRAWL_LINKS_SQL = """
select l_orderkey as page_key, l_linenumber as pos,
 cast(cast(o_orderdate as date) as varchar(10)) as crawl_file,
 concat(case when o_custkey % 3 = 0 then 'https://' else 'http://' end,
        case when o_custkey % 4 = 1 then 'www.' else '' end,
        'site', o_custkey % 40, case when o_custkey % 5 = 2 then '.co.uk' else '.example.com' end,
        '/p', o_orderkey % 7, case when o_orderkey % 6 = 0 then '?s=1' when o_orderkey % 6 = 1 then ';j=2' else '' end) as parent_url,
 case l_partkey % 11
  when 0 then concat('/in/', l_partkey % 5)
  when 1 then concat('http://www.site', l_suppkey % 50, '.example.com/x')
  when 2 then concat('https://a.b.site', l_suppkey % 50, '.co.uk/y?z=1.5')
  when 3 then concat('http%3A%2F%2Fsite', l_suppkey % 50, '.example.com%2Fq')
  when 4 then 'javascript:void(0)'
  when 5 then concat('http://site', l_suppkey % 45, '.example.com?x=1.2#frag')
  when 6 then '#top'
  when 7 then concat('http%253A//site', l_suppkey % 45, '.example.com/a%2520b%20c')
  when 8 then concat('//cdn', l_suppkey % 4, '.example.com/lib.js')
  when 9 then concat('https:/site', l_suppkey % 40, '.co.uk;p=1+2%zz')
  else '' end as href
from lineitem join orders on l_orderkey = o_orderkey
"""

# Also in both: pages as a crawl should not hold them.
DIRTY_PAGES_SQL = """
select o_orderkey as page_key,
 case o_orderkey % 6
  when 0 then null
  when 1 then concat('  http://www.a', o_custkey % 9, '.com/x ')
  when 2 then concat('http%3A%2F%2Fb', o_custkey % 9, '.co.uk%2Fy z')
  when 3 then 'h'
  when 4 then concat('http://c', o_custkey % 9, '.org/p?q=1')
  else ' ' end as url,
 case o_custkey % 4
  when 0 then null
  when 1 then array()
  when 2 then array(null, '/a', concat('http://www.d', o_custkey % 5, '.com/z'))
  else array('mailto:x', 'https://e.f.co.uk;j=1') end as children
from orders
"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    query = CRAWL_LINKS_SQL.replace(
        "from lineitem join orders", "from {lineitem} lineitem join {orders} orders"
    )
    return spark.sql(query, lineitem=lineitem, orders=orders)


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same links as pages with a list of hrefs: (crawl_file, page_key, url, children).

    One copy of the page per link, as when a crawl fetches a page again: nothing is grouped, so
    an order with very many line items is no burden.
    """
    return crawl_links(spark, sf_dir).select(
        "crawl_file", "page_key", F.col("parent_url").alias("url"), F.array("href").alias("children")
    )


def markup(rows: DataFrame) -> DataFrame:
    """Each href set in HTML in one of five notations, beside anchors that must not count."""
    href = F.col("href")
    coded = F.replace(F.replace(href, F.lit("/"), F.lit("&#47;")), F.lit(":"), F.lit("&#x3A;"))
    shapes = {
        0: ['<p><a href="', href, '">x</a>'],
        1: ["<!-- <a href='/no'> --><A CLASS=b HREF='", href, "' title=\"<a href=/no>\">x</A>"],
        2: ["<script>s='<a href=\"/no\">'</script><a\n id=i href = \"", href, '" href="/no">x'],
        3: ['<abbr href="/no"><a data-href="/no" href="', coded, '"/>'],
        4: ["<style>a[href='/no']{}</style><link href=/no><a name=n><a href='", coded, "'>"],
    }

    def text(parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    html = F.coalesce(*[F.when(F.col("page_key") % 5 == k, text(p)) for k, p in shapes.items()])
    return rows.withColumn("raw_content", html)
