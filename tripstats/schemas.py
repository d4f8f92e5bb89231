"""Table layouts of the trip pipeline and its fixed look-up values."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw / bronze trip record: CSV with a header, read with this explicit schema
# (column order matters: a CSV schema is positional).
RAW_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.StringType(), True),
        T.StructField("tpep_pickup_datetime", T.StringType(), True),
        T.StructField("tpep_dropoff_datetime", T.StringType(), True),
        T.StructField("passenger_count", T.DoubleType(), True),
        T.StructField("trip_distance", T.DoubleType(), True),
        T.StructField("RatecodeID", T.StringType(), True),
        T.StructField("store_and_fwd_flag", T.StringType(), True),
        T.StructField("PULocationID", T.StringType(), True),
        T.StructField("DOLocationID", T.StringType(), True),
        T.StructField("payment_type", T.StringType(), True),
        T.StructField("fare_amount", T.DoubleType(), True),
        T.StructField("extra", T.DoubleType(), True),
        T.StructField("mta_tax", T.DoubleType(), True),
        T.StructField("tip_amount", T.DoubleType(), True),
        T.StructField("tolls_amount", T.DoubleType(), True),
        T.StructField("improvement_surcharge", T.DoubleType(), True),
        T.StructField("total_amount", T.DoubleType(), True),
        T.StructField("congestion_surcharge", T.DoubleType(), True),
        T.StructField("airport_fee", T.DoubleType(), True),
    ]
)

# Bronze keeps, beside the raw columns, the original text of any CSV line
# whose values did not parse (null for good lines), for audit and counting.
CORRUPT_RECORD_COL = "_corrupt_record"
BRONZE_SCHEMA = T.StructType(
    list(RAW_TRIP_SCHEMA.fields) + [T.StructField(CORRUPT_RECORD_COL, T.StringType(), True)]
)

# Columns the cleaning step adds; ``year`` and ``month`` are the partition
# columns of the silver layer.
SILVER_EXTRA_FIELDS = [
    T.StructField("pickup_datetime", T.TimestampNTZType(), True),
    T.StructField("dropoff_datetime", T.TimestampNTZType(), True),
    T.StructField("payment_type_desc", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
]
SILVER_SCHEMA = T.StructType(list(RAW_TRIP_SCHEMA.fields) + SILVER_EXTRA_FIELDS)
SILVER_PARTITION_COLUMNS = ("year", "month")

# Payment code -> description.  The code is matched as text
# after trimming, so "1.0" maps and "1" does not; anything unmapped or null
# becomes OTHER_PAYMENT.
PAYMENT_TYPE_MAP = {
    "0.0": "Flex Fare trip",
    "1.0": "Credit card",
    "2.0": "Cash",
    "3.0": "No charge",
    "4.0": "Dispute",
    "5.0": "Unknown",
    "6.0": "Voided trip",
}
OTHER_PAYMENT = "Other"

# Default bounds of the cleaning step (inclusive text bounds).
DEFAULT_DATE_LO = "2020-01-01"
DEFAULT_DATE_HI = "2023-12-31"

# Defaults of the approximate methods.
DEFAULT_SAMPLE_SIZE = 100_000
DEFAULT_SAMPLE_SEED = 1234
DEFAULT_CMS_EPS = 0.0001
DEFAULT_CMS_CONFIDENCE = 0.95
DEFAULT_CMS_SEED = 1

# Text that stands for a null key inside a sketch key.
NULL_KEY_TEXT = "__NULL__"
# Separator of composite sketch keys.
KEY_DELIMITER = "|"

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("query_name", T.StringType(), False),
        T.StructField("exact_time_ms", T.LongType(), True),
        T.StructField("sample_time_ms", T.LongType(), True),
        T.StructField("cms_time_ms", T.LongType(), True),
        T.StructField("sample_absolute_error", T.DoubleType(), True),
        T.StructField("sample_pct_error", T.DoubleType(), True),
        T.StructField("cms_absolute_error", T.DoubleType(), True),
        T.StructField("cms_pct_error", T.DoubleType(), True),
    ]
)
