"""Sinks, snapshots and digests.

Tables go to Parquet (or CSV/JSON for interchange), written by the executors
in parallel; nothing is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def has_success(spark: SparkSession, path: str) -> bool:
    """Whether a job finished writing the folder ``path``."""
    fs, where = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    fs, where = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Tabular sink (overwrite).  Partition columns become directories, so a
    later read filtered on them prunes whole folders."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_ordered(df: DataFrame, path: str, order: list[Column], partitions: int | None = None) -> None:
    """Globally ordered sink: file ``part-k`` holds the k-th stretch of the order, sorted.

    Rows are range-partitioned, so no task sorts the whole; ``order`` should be
    total, or rows that tie may change places between runs.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an ordered sink with ``position`` (from 0) in its order.

    The manifest (rows per file, in the order of the files' names) gives each file
    its first position; a row's place in its file gives the rest.
    """
    rows = spark.read.parquet(path)
    columns = rows.columns
    placed = rows.select(*columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per file: a window over all of them is small.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    return placed.join(manifest, "_file").select(*columns, (F.col("_first") + F.col("_index")).alias("position"))


def write_records(df: DataFrame, path: str) -> None:
    """Nested-record sink: JSON lines, structs and arrays kept as such."""
    df.write.mode("overwrite").json(path)


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """32 bits of each row's MD5, as a number that any engine can compute.

    A row is its columns as text, joined by ``|``, NULL as ``~``; floating-point
    columns count in whole ten-thousandths.
    """
    kinds = dict(df.dtypes)

    def text(c: str):
        x = F.col(f"`{c}`")
        if kinds[c] in ("double", "float"):
            x = F.round(x * 10_000).cast("decimal(38,0)")
        return F.coalesce(x.cast("string"), F.lit("~"))

    row = F.md5(F.concat_ws("|", *[text(c) for c in columns or df.columns]))
    return F.conv(F.substring(row, 1, 8), 16, 10).cast("long")


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-free content fingerprint: rows, and the sum of their digests.

    One pass with map-side combine; equal tables give equal rows whatever their
    partitioning or order.
    """
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(df, columns)).alias("digest"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Fingerprint of the lines of every text file under ``path``, one row per file; files of any size split over tasks."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.md5("value").alias("h"))
    return lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.conv(F.substring("h", 1, 8), 16, 10).cast("long")).alias("digest")
    )


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, by: list[str], sort_by: list[str] | None = None
) -> DataFrame:
    """Store ``df`` as a table bucketed (and sorted) on ``by`` at ``path``; return the table.

    Written once, the table carries its hash partitioning: every later
    ``PARTITION BY by`` window or aggregation on it plans without an Exchange.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
