"""Parquet layers: flat and year/month partitioned, read and written."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("year", "month"),
    dynamic: bool = False,
) -> None:
    """Hive-style ``year=/month=`` layout.

    Rows are clustered by the partition columns with a ``REBALANCE`` hint:
    at run time AQE cuts the shuffle into partitions of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` -- a month holding a
    third of all rows is split over as many tasks as its size needs, small
    months are coalesced -- so each month gets a few right-sized files
    instead of one file per input task, and no task writes a whole month.
    With ``dynamic`` only the months present in ``df`` are replaced
    (re-running a single month leaves the others intact).
    """
    clustered = df.hint("rebalance", *partition_cols)
    writer = clustered.write.mode("overwrite").partitionBy(*partition_cols)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a layer with an explicit schema (no inference across files)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def month_bounds(lo: _dt.date | str, hi: _dt.date | str) -> tuple[int, int]:
    """The months of two dates as numbers ``year * 100 + month``."""
    lo_d = _dt.date.fromisoformat(str(lo)[:10])
    hi_d = _dt.date.fromisoformat(str(hi)[:10])
    return lo_d.year * 100 + lo_d.month, hi_d.year * 100 + hi_d.month


def month_range_predicate(
    lo: _dt.date | str, hi: _dt.date | str, year_col: str = "year", month_col: str = "month"
) -> Column:
    """Predicate on partition columns selecting the months ``lo``..``hi``.

    Written on ``year`` / ``month`` only, so the scan prunes whole partition
    directories (``PartitionFilters``) before any file is opened.
    """
    return (F.col(year_col) * 100 + F.col(month_col)).between(*month_bounds(lo, hi))


def read_months(
    spark: SparkSession,
    path: str,
    lo: _dt.date | str,
    hi: _dt.date | str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Only the partitions of the months ``lo``..``hi`` of a partitioned layer."""
    return read_layer(spark, path, schema).where(month_range_predicate(lo, hi))


def partition_volume(df: DataFrame, partition_cols: Sequence[str] = ("year", "month")) -> DataFrame:
    """Rows per partition of a layer."""
    return df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("row_count"))


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of a layer's Parquet files, from the file listing; no file is opened.

    Files without rows are listed too.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return listing.option("recursiveFileLookup", "true").load(path).select("path")


def file_count(spark: SparkSession, path: str) -> int:
    """Number of Parquet files of a layer; 0 for a layer without any."""
    return data_files(spark, path).count()


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, files) of a partitioned layer, from its file listing."""
    year = F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int").alias("year")
    month = F.regexp_extract("path", r"/month=(\d+)/", 1).cast("int").alias("month")
    return data_files(spark, path).groupBy(year, month).agg(F.count(F.lit(1)).alias("files"))
