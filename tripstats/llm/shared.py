"""Where operators keep intermediate tables, and how tasks reach files there.

Intermediate tables cut the lineage: a lost executor costs a re-read, not a
re-computation of everything before.  They live under the folder named by
``spark.checkpoint.dir``, which driver and executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and return it as read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_system(uri: str):
    """(file system, path) of a shared folder, for tasks that write archives byte by byte."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    # Hadoop's names of S3 connectors; other schemes are as pyarrow knows them.
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def free_name(columns: list[str], name: str) -> str:
    """``name`` with as many underscores before it as make it differ from all of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
