"""Parquet layers: partitioned writes, month pruning, dynamic overwrite, volume."""

from pyspark.sql import functions as F

from tripstats.plans import trip_carrier as T
from tripstats.schemas import SILVER_SCHEMA
from tripstats.sources.layers import (
    file_count,
    partition_files,
    partition_volume,
    read_layer,
    read_months,
    write_partitioned,
)

from .conftest import SF_SMALL


def test_partitioned_roundtrip_and_pruning(spark, tmp_dir):
    silver = T.carrier_silver(spark, SF_SMALL)
    path = tmp_dir + "/silver"
    write_partitioned(silver, path)
    back = read_layer(spark, path, SILVER_SCHEMA)
    assert back.count() == silver.count()
    got = read_months(spark, path, "1997-02-01", "1997-04-30", SILVER_SCHEMA)
    want = silver.where((F.col("year") == 1997) & F.col("month").between(2, 4))
    assert got.count() == want.count() > 0
    # small data: AQE coalesces each month into one file
    per_month = back.select("year", "month", F.col("_metadata.file_path").alias("f")).distinct()
    assert max(r["n"] for r in per_month.groupBy("year", "month").agg(F.count("f").alias("n")).collect()) == 1
    vol = {(r["year"], r["month"]): r["row_count"] for r in partition_volume(back).collect()}
    assert sum(vol.values()) == silver.count()
    files = {(r["year"], r["month"]): r["files"] for r in partition_files(spark, path).collect()}
    assert files.keys() == vol.keys() and file_count(spark, path) == sum(files.values()) >= len(vol)


def test_file_count_is_a_listing_with_empty_files(spark, tmp_dir):
    silver = T.carrier_silver(spark, SF_SMALL)
    silver.limit(10).coalesce(1).write.parquet(tmp_dir + "/one")
    silver.where("false").coalesce(1).write.mode("append").parquet(tmp_dir + "/one")
    assert file_count(spark, tmp_dir + "/one") == 2
    write_partitioned(silver.where("false"), tmp_dir + "/none")
    assert file_count(spark, tmp_dir + "/none") == 0


def test_dynamic_overwrite_replaces_only_given_months(spark, tmp_dir):
    silver = T.carrier_silver(spark, SF_SMALL)
    path = tmp_dir + "/silver"
    write_partitioned(silver, path)
    one_month = silver.where((F.col("year") == 1997) & (F.col("month") == 5)).limit(3)
    write_partitioned(one_month, path, dynamic=True)
    back = read_layer(spark, path, SILVER_SCHEMA)
    may = back.where((F.col("year") == 1997) & (F.col("month") == 5)).count()
    assert may == 3
    assert back.count() == silver.count() - silver.where((F.col("year") == 1997) & (F.col("month") == 5)).count() + 3


def test_hot_month_is_split_over_tasks(spark, tmp_dir):
    """With a small advisory size, one month holding most rows gets several files."""
    silver = T.carrier_silver(spark, "/root/testdata/sf0.01")
    hot = silver.where((F.col("year") == 1997) & (F.col("month") == 5))
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("_i")).drop("_i")
    skewed = silver.unionByName(copies)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_partitioned(skewed, tmp_dir + "/skewed")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = read_layer(spark, tmp_dir + "/skewed", SILVER_SCHEMA)
    assert back.count() == skewed.count()
    files = back.where((F.col("year") == 1997) & (F.col("month") == 5)).select("_metadata.file_path").distinct().count()
    assert files > 1
