import pytest
from pyspark.sql import functions as F

from linkrank.operators import links

PAGES = [
    ("http://www.a.com/p?x=1", '<a href="/in"><a href="http://b.com/y"><a href="http://b.com/y"><a href="#t">'),
    ("http://c.co.uk/", "<p>no links</p>"),
    ("http://c.co.uk/", None),
    (None, '<a href="/lost">'),
    ("x", '<a href="http://b.com/">'),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "url string, raw_content string")


def test_page_links_of_all_types(pages, rows):
    got = rows(links.parse_pages(pages).filter("parent_url like '%a.com%'"))
    assert got == [
        ("a.com", ["a.com", "b.com", "b.com"], "type2"),
        ("a.com", ["a.com", "b.com", "b.com"], "type3"),
        ("http://a.com/p", ["http://a.com/p", "http://b.com/y", "http://b.com/y"], "type1"),
    ]


def test_pages_without_url_or_links(pages, rows):
    parsed = links.parse_pages(pages, link_types=["type2"])
    assert rows(parsed, "parent_url") == [("a.com",), ("c.co.uk",), ("c.co.uk",), ("x",)]
    kept = links.parse_pages(pages, link_types=["type2"], on_missing_url="error_url")
    assert ("error.com",) in rows(kept, "parent_url")
    assert rows(links.linkless_parents(parsed)) == [("type2", "c.co.uk")]
    assert rows(links.known_parents(parsed), "src") == [("a.com",), ("c.co.uk",)]


def test_counts_leave_out_one_character_parents(pages, rows):
    parsed = links.parse_pages(pages, link_types=["type2"])
    assert rows(links.count_links(links.link_rows(parsed))) == [
        ("type2", "a.com", "a.com", 1),
        ("type2", "a.com", "b.com", 2),
    ]


def test_raw_listing_cleans_nothing(pages, rows):
    listed = links.list_raw_links(pages, url_col="url").filter("parent_url like '%a.com%'")
    assert rows(listed) == [
        ("http://www.a.com/p?x=1", ["/in", "http://b.com/y", "http://b.com/y", "#t"])
    ]


def test_extracted_links_use_the_legacy_names(spark, rows):
    pages = spark.createDataFrame(
        [
            ("http://www.a.com/p", ["http://www.b.com?x=1.5", "/in", "mailto:x", None]),
            (None, None),
        ],
        "url string, children array<string>",
    )
    got = rows(links.clean_extracted(pages, link_types=["type2"]))
    assert got == [
        ("www.a.com", ["www.b.com?x=1.5", "www.a.com"], "type2"),
        ("www.error.com", [], "type2"),
    ]


def test_corrupt_rows_come_out_once(spark, rows):
    pages = spark.createDataFrame(
        [("http://a.com", "<a href=/x>", None), (None, None, "{oops"), (None, None, None)],
        "url string, raw_content string, bad string",
    )
    parsed = links.parse_pages(pages, corrupt_col="bad")
    assert rows(parsed.filter("link_type = 'corrupt'"), "bad_record") == [("{oops",)]
    assert parsed.filter("link_type != 'corrupt'").count() == 3


def test_row_form_equals_page_form(spark, rows):
    hrefs = ["/a", "http://www.x.co.uk/q?z", "javascript:1", "", "http%3A//y.com%20z", "//cdn/x"]
    pages = spark.createDataFrame([("http://www.p.com/;s", hrefs)], "url string, children array<string>")
    by_page = links.link_rows(links.clean_extracted(pages, variant="current"))
    by_row = links.links_from_href_rows(pages.select("url", F.explode("children").alias("href")), "url")
    assert rows(by_page, *links.EDGE_KEYS) == rows(by_row, *links.EDGE_KEYS)


def test_merging_does_not_depend_on_the_split(spark, rows):
    pairs = [("type2", f"s{i % 7}", f"d{i % 5}", i % 3) for i in range(200)]
    df = spark.createDataFrame(pairs, "link_type string, src string, dst string, part int")
    whole = links.count_links(df)
    parts = [links.count_links(df.filter(F.col("part") == p)) for p in range(3)]
    assert rows(links.merge_edges(*parts)) == rows(whole)
    assert rows(links.merge_edges(links.count_links(df, ["part"]))) == rows(whole)


def test_cleaning_runs_once_per_href(spark):
    """No filter on the cleaned link may be pushed below the cleaning."""
    df = spark.createDataFrame([("http://p.com", "/x")], "parent_url string, href string")
    plan = links.links_from_href_rows(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UrlCodec.decode") == 2  # one for the parent, one for the href
