"""Bronze -> silver: parse, filter, enrich, partition columns."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookup import map_lookup
from ..schemas import DEFAULT_DATE_HI, DEFAULT_DATE_LO, OTHER_PAYMENT, PAYMENT_TYPE_MAP

# Upper-bound modes of the pickup range.
INCLUSIVE_MIDNIGHT = "inclusive_midnight"  # ``between(lo, hi)``: hi is hi 00:00:00
HALF_OPEN = "half_open"  # ``[lo, hi + 1 day)``: the whole last day


def parse_timestamp(text: Column) -> Column:
    """Text -> wall-clock timestamp (``timestamp_ntz``); malformed -> null.

    Trip times are local wall-clock times without a zone, so they are kept
    zone-free: hour and weekday never shift with the session time zone.
    ``try_cast`` returns null instead of failing under ANSI mode.  Unlike
    ``to_timestamp`` without a format it needs a date (a bare ``12:34:56`` is
    null), and a zone offset in the text is dropped, not applied.
    """
    return text.try_cast("timestamp_ntz")


def pickup_range(ts: Column, lo: str, hi: str, mode: str = INCLUSIVE_MIDNIGHT) -> Column:
    """Pickup range predicate with text bounds (cast to the column's type).

    ``inclusive_midnight`` keeps ``lo <= ts <= hi 00:00:00`` (so nearly all
    of the last day is dropped); ``half_open`` keeps ``lo <= ts < hi + 1 day``.
    A null timestamp fails both.
    """
    if mode == INCLUSIVE_MIDNIGHT:
        return ts.between(F.lit(lo), F.lit(hi))
    if mode == HALF_OPEN:
        next_day = (_dt.date.fromisoformat(hi[:10]) + _dt.timedelta(days=1)).isoformat()
        return (ts >= F.lit(lo)) & (ts < F.lit(next_day))
    raise ValueError(f"unknown range mode {mode!r}")


def clean_trips(
    bronze: DataFrame,
    date_lo: str = DEFAULT_DATE_LO,
    date_hi: str = DEFAULT_DATE_HI,
    range_mode: str = INCLUSIVE_MIDNIGHT,
    payment_map: Mapping[str, str] = PAYMENT_TYPE_MAP,
    default_payment: str = OTHER_PAYMENT,
    dedup: bool | Sequence[str] = False,
    add_partitions: bool = True,
    dedup_order: Sequence[str] = (),
) -> DataFrame:
    """Bronze trips -> silver trips.

    1. ``pickup_datetime`` / ``dropoff_datetime`` parsed from the text columns
       (malformed -> null, so the row then fails the range filter);
    2. ``passenger_count > 0`` (nulls dropped) -- pushed to the Parquet scan;
    3. pickup and dropoff locations not null -- pushed to the scan;
    4. pickup within ``[date_lo, date_hi]`` per ``range_mode``;
    5. ``payment_type_desc`` from the code map, ``default_payment`` otherwise;
    6. ``year`` / ``month`` of the pickup for the partitioned layout;
    7. optionally drop duplicate rows.  ``dedup=True`` compares the raw columns
       (derived ones follow from them), before anything is derived.  A list
       of columns keeps one row for each of their values: the one that is
       smallest by ``dedup_order``, then by all other columns in order.
    """
    if dedup is True:
        bronze = bronze.dropDuplicates()
    df = bronze.withColumns(
        {
            "pickup_datetime": parse_timestamp(F.col("tpep_pickup_datetime")),
            "dropoff_datetime": parse_timestamp(F.col("tpep_dropoff_datetime")),
        }
    )
    df = (
        df.where(F.col("passenger_count") > 0)
        .where(F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull())
        .where(pickup_range(F.col("pickup_datetime"), date_lo, date_hi, range_mode))
        .withColumn("payment_type_desc", map_lookup(F.col("payment_type"), payment_map, default_payment))
    )
    if add_partitions:
        df = df.withColumns(
            {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
        )
    if dedup and dedup is not True:
        keys, columns = list(dedup), df.columns
        rest = [*dedup_order, *[c for c in columns if c not in keys and c not in dedup_order]]
        best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))  # combined before the shuffle
        df = best.select(*keys, *[F.col("_best").getField(c).alias(c) for c in rest if c not in keys]).select(*columns)
    return df
