"""The registered queries and the corpus pipeline on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from compare import check, connect
from linkrank.llm import decontaminate, minhash, oracles, quality, queries, toxicity
from linkrank.operators.staging import scratch_path, write_and_read
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_all_are_registered():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.queries()) < set(names) and "pipeline" in names
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "bpe"]


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert check(spark, connect(FOLDER), name, FOLDER) == ""


def test_stages(spark):
    docs = pipeline.table(spark, FOLDER, "documents")
    labels, benchmark = pipeline.table(spark, FOLDER, "labels"), pipeline.table(spark, FOLDER, "benchmark")
    for name, function in pipeline.STAGES:
        before = docs
        docs = write_and_read(function(spark, before, FOLDER), scratch_path(spark, name))
        if name == "toxicity":
            gone = {r.doc_id for r in toxicity.toxicity_scores(before, labels).collect() if r.predicted == 1}
        elif name == "quality":
            gone = {r.doc_id for r in quality.quality_scores(before, labels).collect() if r.predicted == 0}
        elif name == "near_duplicates":
            gone = {r.doc_id for r in minhash.near_duplicates(before).collect() if not r.kept}
        elif name == "decontamination":
            gone = {r.doc_id for r in decontaminate.contamination(before, benchmark).collect() if r.contaminated}
        else:
            gone = set()
        own = lambda rows: sorted(map(tuple, rows.select("doc_id", "text", "lang", "source", "n_chars").collect()))
        assert own(docs) == [r for r in own(before) if r[0] not in gone], name
        assert gone or name in ("toxicity", "bpe")  # the smallest tables have few toxic rows
    assert docs.columns == [*before.columns, "ids"]


def test_odd_rows_go_through(spark, odd_docs, no_docs):
    odd = odd_docs.drop("ids")
    for docs in (odd, no_docs.drop("ids")):
        kept = docs
        for name, function in pipeline.STAGES:
            following = write_and_read(function(spark, kept, FOLDER), scratch_path(spark, name))
            assert following.columns == kept.columns + (["ids"] if name == "bpe" else []), name
            kept = following
        assert kept.count() <= docs.count()


def test_repeated_rows_are_one_group(spark, prose):
    rows = [(1, prose(1, 50)), (1, prose(1, 50)), (2, prose(1, 50)), (3, ""), (3, ""), (None, prose(2, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, prose(1, 50)), (3, ""), (3, ""), (None, prose(2, 50))], key=repr
    )


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark, prose):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(3, b), (5, a), (5, b + "word"), (7, "A b c d e f"), (7, "a  b c\nd e f"), (None, a)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, row_key int")
    kept = pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found[:2] == [(3, b), (5, a)] and len(found) == 3 and found[2][0] == 7


def test_ids_that_do_not_give_the_text_fail(spark, odd_docs):
    docs = odd_docs.drop("ids")
    encoded = pipeline.encode(spark, docs, FOLDER)
    assert encoded.columns == [*docs.columns, "ids"] and encoded.filter("size(ids) >= 0").count() == docs.count()
    wrong = encoded.withColumn("ids", F.expr("CASE WHEN doc_id = 7 THEN slice(ids, 1, 0) ELSE ids END"))
    with pytest.raises(Exception, match="doc_id 7"):
        pipeline.checked(wrong).collect()
