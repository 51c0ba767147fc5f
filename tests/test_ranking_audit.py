import pytest
from pyspark.sql import functions as F

from linkrank.operators import audit, ranking
from linkrank.operators.attributes import FEATURES


@pytest.fixture(scope="module")
def table(spark):
    data = [(f"u{i}", *[float((i * 7) % 5 + k) for k in range(len(FEATURES))]) for i in range(12)]
    return spark.createDataFrame(data, "url string, " + ", ".join(f"{f} double" for f in FEATURES))


def test_sort_falls_back_to_outdeg(table):
    assert ranking.sort_attribute("nonsense") == ranking.sort_attribute(None) == "outdeg"
    expected = [r["url"] for r in sorted(table.collect(), key=lambda r: (-r["outdeg"], r["url"]))]
    assert [r["url"] for r in ranking.ranked(table, "nonsense").collect()] == expected
    ranked = ranking.with_rank(table, "outdeg").collect()
    assert [r["url"] for r in sorted(ranked, key=lambda r: r["rank"])] == expected


def test_exclusions(spark, table, rows):
    top = [r["url"] for r in ranking.top(table, 2).collect()]
    assert top == ["u2", "u7"]
    left = {r["url"] for r in ranking.exclude_top(table, 2).collect()}
    assert left == {f"u{i}" for i in range(12)} - set(top)
    assert ranking.exclude_top(table, 0) is table
    assert ranking.exclude_urls(table, []) is table
    assert ranking.exclude_urls(table, ["u0", "absent"]).count() == 11
    many = [f"u{i}" for i in range(5, 3000)]
    assert ranking.exclude_urls(table, many).count() == 5
    for listed in (["u0", None], [*many, None]):
        kept = ranking.exclude_urls(table, listed)
        assert kept.count() == ranking.exclude_urls(table, listed[:-1]).count() > 0
    listed = spark.createDataFrame([("u1",), ("u1",), ("",)], "url string")
    assert ranking.exclude_listed(table, listed).count() == 11


def test_audit(spark, rows):
    inputs = [("f1", f"p{i}") for i in range(100)] * 2 + [("f2", f"p{i}") for i in range(10)]
    outputs = [("f1", f"p{i}") for i in range(94)] + [("f2", f"p{i}") for i in range(9)]
    inputs += [("f3", "p0")]
    schema = "crawl_file string, src string"
    verdicts = audit.completeness_audit(
        spark.createDataFrame(inputs, schema), spark.createDataFrame(outputs, schema)
    )
    assert rows(verdicts) == [
        ("f1", 100, 94, 6.0, True), ("f2", 10, 9, 10.0, False), ("f3", 1, 0, 100.0, False)
    ]
    assert rows(audit.completeness_totals(verdicts)) == [(3, 1, 2)]
    assert rows(audit.files_to_reprocess(verdicts)) == [("f2",), ("f3",)]


def test_stems(spark, rows):
    inputs = spark.createDataFrame([("a.jl.gz",), ("b.c.jl.gz",), ("d.gz",)], "file_name string")
    outputs = spark.createDataFrame([("b.c.csv",), ("a.b.csv",)], "file_name string")
    assert rows(audit.pending_inputs(inputs, outputs)) == [("a.jl.gz",), ("d.gz",)]
    assert inputs.select(audit.input_stem(F.col("file_name"))).first()[0] == "a"
