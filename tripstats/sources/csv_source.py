"""CSV at the edge: raw trip files read with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import CORRUPT_RECORD_COL, RAW_TRIP_SCHEMA


def csv_schema(schema: T.StructType, keep_corrupt: bool) -> T.StructType:
    """``schema``, with a last column for the original line of malformed rows if they are kept."""
    if not keep_corrupt:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD_COL, T.StringType(), True)])


def csv_options(verify_header: bool = True, keep_corrupt: bool = False) -> dict[str, str]:
    """Reader options of raw trip files, the same for batch and stream."""
    options = {"header": "true", "mode": "PERMISSIVE"}
    if keep_corrupt:
        options["columnNameOfCorruptRecord"] = CORRUPT_RECORD_COL
    if verify_header:
        options["enforceSchema"] = "false"
    return options


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_TRIP_SCHEMA,
    verify_header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Header CSV (a file or a directory) with an explicit schema.

    PERMISSIVE mode: a malformed number or a short line becomes null instead
    of failing the job; the cleaning filters then drop such rows.

    An explicit CSV schema is positional, so a file whose header lists the
    columns in another order would be read into the wrong columns without
    error.  With ``verify_header`` (``enforceSchema=false``) Spark checks each
    file's header against the schema names and fails instead.

    With ``keep_corrupt`` a string column ``_corrupt_record`` holds the
    original line of every row whose values did not parse (null otherwise),
    so malformed input can be counted and audited instead of vanishing.
    """
    reader = spark.read.schema(csv_schema(schema, keep_corrupt))
    return reader.options(**csv_options(verify_header, keep_corrupt)).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per task, overwriting ``path``."""
    df.write.mode("overwrite").option("header", "true").csv(path)
