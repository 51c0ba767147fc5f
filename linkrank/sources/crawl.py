"""Crawl input: JSON lines, plain or gzip, one object per page.

Rows that are not JSON keep their text in ``_corrupt_record`` instead of failing the
file.  A gzip file is one task from scan to link extraction, and raw pages are not
shuffled unless asked: ``spread_above`` spreads gzip files of more bytes after reading, and
``min_partitions`` spreads the whole scan.  With ``gzip_range_bytes`` a gzip file written by
``sinks.tables.write_crawl`` is read by a task for each range of so many bytes, other gzip files by
one task each (see ``sources.split_gzip``).  Defining a scan runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
FILE_COLUMN = "crawl_file"
GZIP = ".gz"


def page_schema(url_col: str = "url", html_col: str = "raw_content") -> T.StructType:
    return T.StructType().add(url_col, "string").add(html_col, "string").add(CORRUPT_COLUMN, "string")


def extracted_schema(url_col: str = "url", children_col: str = "children") -> T.StructType:
    return (
        T.StructType()
        .add(url_col, "string")
        .add(children_col, T.ArrayType(T.StringType()))
        .add(CORRUPT_COLUMN, "string")
    )


def not_a_ledger():
    """Files whose name ends in ``txt`` are logs.  Spark skips them before opening them."""
    return ~F.endswith(F.col("_metadata.file_name"), F.lit("txt"))


def named_paths(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """(files, folders) that a path, a list of paths or a pattern names, asked of the file system."""
    files, folders = [], []
    for one in [path] if isinstance(path, str) else path:
        named = spark._jvm.org.apache.hadoop.fs.Path(one)
        system = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = system.globStatus(named)
        if not found:
            raise FileNotFoundError(one)
        for status in found:
            (folders if status.isDirectory() else files).append(status.getPath().toString())
    return files, folders


def named_exists(spark: SparkSession, path: str) -> bool:
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.exists(named))


def read_named(reader, spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``reader(paths)`` of everything that ``path`` names: files whatever their name is, and in
    folders all files that are not logs."""
    files, folders = named_paths(spark, path)
    parts = [reader(files)] if files else []
    if folders:
        parts.append(reader(folders).filter(not_a_ledger()))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _parsed(lines: DataFrame, schema: T.StructType, fail_fast: bool) -> DataFrame:
    """JSON lines (value, file) as Spark's JSON source reads them: blank lines are no rows, and an array
    of objects is a row for each."""
    options = {"mode": "FAILFAST" if fail_fast else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    one = F.from_json("value", schema, options)
    many = F.from_json("value", T.ArrayType(schema), {"mode": options["mode"]})
    broken = F.array(F.struct(*[(F.col("value") if f.name == CORRUPT_COLUMN else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))
    is_array = F.rlike("value", F.lit(r"^\s*\["))
    found = F.when(is_array, F.coalesce(many, broken)).otherwise(F.array(one))
    rows = lines.filter(F.rlike("value", F.lit(r"\S"))).select(F.explode(found).alias("page"), F.col("file").alias(FILE_COLUMN))
    return rows.select("page.*", FILE_COLUMN)


def _read(
    spark: SparkSession,
    path,
    schema,
    fail_fast: bool,
    min_partitions: int | None,
    spread_above: int | None,
    gzip_range_bytes: int | None = None,
):
    def read(paths: list[str]) -> DataFrame:
        return (
            spark.read.schema(schema)
            .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .json(paths)
            .withColumn(FILE_COLUMN, F.col("_metadata.file_path"))
            .withColumn("_bytes", F.col("_metadata.file_size"))
        )

    rows = read_named(read, spark, path)
    if gzip_range_bytes is not None:
        from linkrank.sources.split_gzip import read_lines

        packed = _parsed(read_lines(spark, path, gzip_range_bytes, GZIP), schema, fail_fast)
        rows = rows.filter(~F.endswith(FILE_COLUMN, F.lit(GZIP))).drop("_bytes").unionByName(packed)
    elif spread_above is not None:
        # Conditions on file metadata choose files, so no file is read twice.
        large = (F.col("_bytes") > spread_above) & F.endswith(FILE_COLUMN, F.lit(GZIP))
        rows = rows.filter(~large).unionByName(
            rows.filter(large).repartition(spark.sparkContext.defaultParallelism)
        )
    rows = rows.drop("_bytes")
    return rows.repartition(min_partitions) if min_partitions else rows


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    *,
    url_col: str = "url",
    html_col: str = "raw_content",
    fail_fast: bool = False,
    min_partitions: int | None = None,
    spread_above: int | None = None,
    gzip_range_bytes: int | None = None,
) -> DataFrame:
    return _read(spark, path, page_schema(url_col, html_col), fail_fast, min_partitions, spread_above, gzip_range_bytes)


def read_extracted(
    spark: SparkSession,
    path: str | list[str],
    *,
    url_col: str = "url",
    children_col: str = "children",
    fail_fast: bool = False,
    min_partitions: int | None = None,
    spread_above: int | None = None,
    gzip_range_bytes: int | None = None,
) -> DataFrame:
    return _read(spark, path, extracted_schema(url_col, children_col), fail_fast, min_partitions, spread_above, gzip_range_bytes)


def list_files(spark: SparkSession, path: str, glob: str = "*", deep: bool = False) -> DataFrame:
    """Files of a folder, with ``deep`` also of the folders in it, as rows (path, file_name, bytes, modified).

    Only the listing is read: contents are a column of Spark's source that is not asked for.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(deep)).load(path)
    return files.filter(not_a_ledger()).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
