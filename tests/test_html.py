import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from linkrank.functions.html import extract_hrefs


class Anchors(HTMLParser):
    """A plain parser to compare with."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links = []

    def handle_starttag(self, tag, attrs):
        hrefs = [value or "" for name, value in attrs if name == "href"]
        if tag == "a" and hrefs:
            self.links.append(hrefs[0])


def parsed(html):
    anchors = Anchors()
    anchors.feed(html or "")
    anchors.close()
    return anchors.links


CASES = [
    ('<a href="/x">', ["/x"]),
    ("<a class=\"y\" href='/q?a=1&amp;b=2' title=\"<a href=z>\">", ["/q?a=1&b=2"]),
    ("<A HREF=/un>", ["/un"]),
    ('<!-- <a href="/c"> --><a href="/d">', ["/d"]),
    ('<!-- open <a href="/c">', []),
    ("<script>var a='<a href=\"/s\">'</script><a href=\" /sp \">", [" /sp "]),
    ('<style>a{}<a href="/st"></style><a href=/z/><link href="/no">', ["/z/"]),
    ("<a name=x>", []),
    ("<a href>", [""]),
    ('<a href="">', [""]),
    ('<abbr href="/no">', []),
    ('<a data-href="/no" href="/yes" href="/second">', ["/yes"]),
    ("<img alt=\"<a href='/in'>\"><a href=\"/out\">", ["/out"]),
    ('<a class="x"href="/glued">', ["/glued"]),
    ('<a\nhref\n=\n"/nl">', ["/nl"]),
    ('<a " href="/stray">', ["/stray"]),
    ('<a = href="/eq">', ["/eq"]),
    ('<a href="/1"><b><a href="/1"></b><a href="/0">', ["/1", "/1", "/0"]),
    ("no markup", []),
    ("", []),
    (None, []),
    ('<a href="&#47;n&#x2F;&eacute;&lt;&apos;">', ["/n/é<'"]),
    ('<a href="/a?b=1&bogus;&c=2&#x1F600;&d">', ["/a?b=1&bogus;&c=2😀&d"]),
]


@pytest.mark.parametrize("html, links", CASES)
def test_extraction(spark, html, links):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(extract_hrefs(F.col("h"))).first()[0] == links
    assert parsed(html) == links


def test_unclosed_entity_names_stay(spark):
    """An unclosed name is no entity: query parameters survive."""
    df = spark.createDataFrame([('<a href="/a?x=1&copy=2&lt=3">',)], "h string")
    assert df.select(extract_hrefs(F.col("h"))).first()[0] == ["/a?x=1&copy=2&lt=3"]


def test_declarations_end_at_the_next_bracket(spark):
    html = '<!DOCTYPE html><?x a="1"?><![CDATA[ <a href="/in">]]><a href="/out">'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(extract_hrefs(F.col("h"))).first()[0] == ["/out"]


def test_out_of_range_references_do_not_fail(spark):
    html = '<a href="/a&#0;&#xD800;&#x110000;&#9999999;b">'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(extract_hrefs(F.col("h"))).first()[0] == ["/ab"]


@pytest.mark.parametrize(
    "reference, text",
    [
        ("&#00000065;", "A"), ("&#x0000041;", "A"), ("&#X041", "A"), ("&#65", "A"), ("&#123456789;", ""),
        ("&#x110000;", ""), ("&#99999999999999999999999;", ""), ("&#xFFFFFFFFFFFFFFFFFF;", ""), ("&#000;", ""),
        ("&#x1F600;", "😀"), ("&#1114111;", "\U0010ffff"), ("&#x;", "&#x;"), ("&#;", "&#;"),
    ],
)
def test_numeric_references(spark, reference, text):
    df = spark.createDataFrame([(f'<a href="/{reference}z">',)], "h string")
    assert df.select(extract_hrefs(F.col("h"))).first()[0] == [f"/{text}z"]


def test_random_documents_agree(spark):
    rng = random.Random(7)
    pieces = [
        "text ", "<p>", "</p>", "<br/>", "<!-- note -->", "<!-- <a href='/c'> -->",
        "<script>if (a<b) x='<a href=q>';</script>", "<style>p>a{}</style>", "<img src=/i alt='a > b'>",
        '<a href="/one">', "<a href='/two' rel=x>", "<a id=q href=/three>", "<a name=anchor>",
        '<A TITLE="x > y" HREF="http://e.com/?a=b&amp;c=d">', "</a>", "<abbr title=t>", "&amp; ", "< 5 ",
    ]
    docs = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(d,) for d in docs], "h string")
    found = df.select("h", extract_hrefs(F.col("h")).alias("n"))
    assert [r for r in found.collect() if r["n"] != parsed(r["h"])] == []


@pytest.mark.parametrize(
    "html",
    [
        "<a " + "word " * 100_000 + 'href="/x">',
        "<a " * 100_000,
        "<!-- " * 50_000,
        "<a href='" * 50_000,
        '<a x="' + "y" * 500_000 + '" href="/x">',
    ],
)
def test_hostile_pages_neither_overflow_nor_stall(spark, html):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(F.size(extract_hrefs(F.col("h")))).first()[0] >= 0
