"""Dimension look-ups as expressions or broadcast joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import OTHER_PAYMENT, PAYMENT_TYPE_MAP
from .keys import ColumnLike, as_column


def map_lookup(
    code: ColumnLike,
    mapping: Mapping[str, str] = PAYMENT_TYPE_MAP,
    default: str = OTHER_PAYMENT,
) -> Column:
    """``mapping[trim(code)]``, or ``default`` when unmapped or null.

    A native map expression instead of a UDF: it stays in whole-stage codegen
    and does not block optimisations.  The map is a literal of the plan; give
    a large mapping to :func:`lookup_join` as a table, with the same result.
    """
    if not mapping:
        return F.lit(default)
    literal = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(literal, F.trim(as_column(code))), F.lit(default))


def mapping_frame(
    spark: SparkSession,
    mapping: Mapping[str, str],
    code_col: str = "_code",
    desc_col: str = "_desc",
) -> DataFrame:
    schema = T.StructType(
        [T.StructField(code_col, T.StringType(), False), T.StructField(desc_col, T.StringType(), False)]
    )
    return spark.createDataFrame(list(mapping.items()), schema)


def lookup_join(
    df: DataFrame,
    code: str,
    dim: DataFrame,
    dim_code: str,
    dim_desc: str,
    out_col: str,
    default: str = OTHER_PAYMENT,
    broadcast_dim: bool = False,
) -> DataFrame:
    """Left join ``df`` to a dimension on ``trim(code)``; unmatched -> ``default``.

    The dimension is first reduced to one row per code (the smallest
    description of a code listed twice), so no row of ``df`` is multiplied.
    Spark picks the join from the dimension's size, by estimate or at run
    time: broadcast when it is small, sort-merge with skew splitting beyond.
    ``broadcast_dim`` hints a broadcast, for a list of a size fixed in code.
    """
    d = dim.where(F.col(dim_code).isNotNull()).groupBy(F.col(dim_code).alias("_lk_code"))
    d = d.agg(F.min(dim_desc).alias("_lk_desc"))
    if broadcast_dim:
        d = F.broadcast(d)
    joined = df.join(d, F.trim(F.col(code)) == F.col("_lk_code"), "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_lk_desc"), F.lit(default))).drop(
        "_lk_code", "_lk_desc"
    )
