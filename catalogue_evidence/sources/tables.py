"""Tables of text in CSV, reports in JSON, and images and files as rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from catalogue_evidence.sources.shared import ranked


def text_schema(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


ACCURACY = 10_000  # of quantiles: they lie at most one row in so many beside the place asked for


def read_table_csv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Columns of text by the header's names, blank for null; a missing path is a table without rows. A byte order mark
    and line ends in quoted cells are taken as what they are."""
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], text_schema(fields))
        raise
    have = {c.lstrip("﻿"): c for c in raw.columns}
    cols = [F.coalesce(F.col(f"`{have[f]}`").cast("string"), F.lit("")) if f in have else F.lit("") for f in fields]
    return raw.select(*[c.alias(f) for c, f in zip(cols, fields)])


def write_table_csv(df: DataFrame, path: str, fields: list[str], mode: str = "overwrite") -> None:
    """The fields in their order as CSV, those that df lacks blank, its others left out."""
    cols = [(F.col(f).cast("string") if f in df.columns else F.lit("")).alias(f) for f in fields]
    df.select(*cols).write.mode(mode).csv(path, header=True, escape='"', emptyValue="")


def write_regional(df: DataFrame, path: str, rows_in_file: int = 5_000_000) -> None:
    """A folder of Parquet for each region. Regions are few and large, so each is written by many tasks."""
    df.repartition("region", F.spark_partition_id()).write.mode("overwrite").option("maxRecordsPerFile", rows_in_file).partitionBy("region").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row report as one JSON object."""
    df.coalesce(1).write.mode("overwrite").json(path)


@contextmanager
def whole_listings(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a shuffle partition; Spark's own way is a task for each of the first 10,000, which
    takes much longer to start than to list a folder."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(int(was), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    try:
        yield
    finally:
        spark.conf.set(name, was)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images below path as rows; undecodable files have a width of -1."""
    with whole_listings(spark):
        return spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of files below path."""
    with whole_listings(spark):
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length) of files below root, with paths from there; contents aren't read."""
    mark = root.rstrip("/").split("://")[-1].lstrip("/") + "/"
    files = read_files(spark, root, pattern).select("path", "length")
    return files.select(F.substring_index("path", mark, -1).alias("path"), "length")


def write_files(df: DataFrame, path: str, key: str, content: str) -> None:
    """A file for each row, of its text as UTF-8 and a line end, in a folder named by the key; keys are unique. Rows are
    dealt out over several tasks a shuffle partition, whatever their bytes: each file takes time of its own to make."""
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.select(key, content).repartition(parts, key).write.option("maxRecordsPerFile", 1).partitionBy(key).text(path)


def slice_rows(df: DataFrame, order: str, start: int, limit: int, rows_in_task: int = 250_000) -> DataFrame:
    """Rows start up to start + limit by place, from 0, in order of a whole-numbered column, whatever gaps it has.

    Two quantiles enclose the slice, a count says how many rows lie below and between them, and only the rows between
    them get places, from range partitions. Texts that are no numbers come first; rows of equal numbers are in either
    order."""
    number = F.coalesce(F.col(order).try_cast("long"), F.lit(-(1 << 63)))
    numbered = df.withColumn("_n", number)
    n = df.count()
    end = min(n, start + limit)
    if start >= end:
        return df.limit(0)
    room = 2 / ACCURACY
    shares = [max(0.0, start / n - room), min(1.0, end / n + room)]
    lo, hi = numbered.agg(F.percentile_approx("_n", shares, ACCURACY).alias("q")).first()["q"]
    within = lambda lo, hi: (F.col("_n") >= lo) & (F.col("_n") <= hi)
    counts = numbered.agg(F.count_if(F.col("_n") < lo).alias("below"), F.count_if(within(lo, hi)).alias("inside")).first()
    below, inside = counts["below"], counts["inside"]
    if below > start or below + inside < end:  # quantiles may miss by rounding of very large numbers
        lo, hi, below, inside = -(1 << 63), (1 << 63) - 1, 0, n
    placed = ranked(numbered.filter(within(lo, hi)), [], ["_n"], max(1, -(-inside // rows_in_task)), "_place", "slice")
    return placed.filter((F.col("_place") >= start - below) & (F.col("_place") < end - below)).select(*df.columns)
