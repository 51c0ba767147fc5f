from types import SimpleNamespace

import pytest

from linkrank.operators import staging


def session(master, **conf):
    context = SimpleNamespace(applicationId="app-1", master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    spark = session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://nn/tmp/"})
    assert staging.scratch_root(spark) == "hdfs://nn/tmp/linkrank-app-1"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.scratch_root(session("yarn"))


def test_one_process_falls_back_to_one_temporary_folder():
    spark = session("local[4]")
    assert staging.scratch_root(spark) == staging.scratch_root(spark)


def test_staged_tables_keep_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    table = staging.stage(df, "t")
    assert table.schema == df.schema and rows(table) == rows(df)
    empty = staging.stage(df.limit(0), "t")
    assert empty.schema == df.schema and empty.count() == 0
