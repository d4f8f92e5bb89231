"""Raw trip records derived from ``lineitem`` (carrier of the layer steps).

Cleaning, look-ups, the CSV edge, the partitioned silver layer and the
quality gate need trip-shaped input.  This projection renames and recasts
``lineitem`` columns into the raw trip layout -- text timestamps, text
location and payment codes, double amounts -- so those steps run over a
given table and grow with it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_trips
from ..sources.tables import read_table

# Fixed parameters of the carrier: a four-year window inside the
# 1995-2001 ship dates, like the default 2020-2023 window on trips.
CARRIER_DATE_LO = "1996-01-01"
CARRIER_DATE_HI = "1999-12-31"
# Months read back from the partitioned layer (partition pruning).
SCAN_MONTH_LO = "1997-01-01"
SCAN_MONTH_HI = "1998-06-30"


def lineitem_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("VendorID"),
        # Text of wall-clock times: a cast of timestamp_ntz is zone-free
        # (date_format would apply the session zone's DST gaps).
        F.col("l_shipdate").cast("string").alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).cast("string").alias(
            "tpep_dropoff_datetime"
        ),
        (F.col("l_linenumber") - 1).cast("double").alias("passenger_count"),
        F.col("l_discount").alias("trip_distance"),
        F.col("l_linestatus").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.col("l_suppkey").cast("string").alias("PULocationID"),
        F.col("l_partkey").cast("string").alias("DOLocationID"),
        F.col("l_linenumber").cast("double").cast("string").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("l_extendedprice") + F.col("l_tax")).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
    )


def carrier_silver(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Cleaned carrier trips with the carrier's date window."""
    kw.setdefault("date_lo", CARRIER_DATE_LO)
    kw.setdefault("date_hi", CARRIER_DATE_HI)
    return clean_trips(lineitem_raw_trips(spark, sf_dir), **kw)


# Fault rows in silver types: each breaks one gate rule (passenger 0, null
# pickup location, passenger -1).
FAULT_ROWS = (
    ("1997-01-15 10:00:00", 0.0, "100"),
    ("1997-01-15 11:00:00", 1.0, None),
    ("1997-01-15 12:00:00", -1.0, "200"),
)


def fault_rows(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        list(FAULT_ROWS), "pickup_text string, passenger_count double, PULocationID string"
    )
    ts = F.col("pickup_text").try_cast("timestamp_ntz")
    return rows.select(
        ts.alias("pickup_datetime"),
        ts.alias("dropoff_datetime"),
        "passenger_count",
        "PULocationID",
        F.lit("1").alias("DOLocationID"),
        F.lit(1.0).alias("trip_distance"),
        F.lit(10.0).alias("fare_amount"),
        F.lit(0.0).alias("tip_amount"),
        F.lit(10.0).alias("total_amount"),
        F.lit("1.0").alias("payment_type"),
        F.lit("Credit card").alias("payment_type_desc"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
    )


def with_faults(silver: DataFrame, faults: DataFrame) -> DataFrame:
    """Silver plus the fault rows (columns they lack are null)."""
    return silver.unionByName(faults, allowMissingColumns=True)


def month_bounds() -> tuple[_dt.date, _dt.date]:
    return _dt.date.fromisoformat(SCAN_MONTH_LO), _dt.date.fromisoformat(SCAN_MONTH_HI)
