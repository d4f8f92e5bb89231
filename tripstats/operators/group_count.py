"""Group counts: exact, scaled from a sample, and their top-k cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_order(keys: Sequence[str]) -> list[Column]:
    """Ascending key order used as tie-breaker (nulls last)."""
    return [F.asc_nulls_last(k) for k in keys]


def row_total(weight: str | None = None) -> Column:
    """``count(*)``, or ``sum(weight)`` for pre-aggregated rows that each
    stand for ``weight`` original rows."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def exact_counts(
    df: DataFrame, keys: Sequence[str], count_col: str, weight: str | None = None
) -> DataFrame:
    """``count(*)`` per group (``sum(weight)`` for weighted rows).

    Planned as partial hash aggregate -> exchange on the keys -> final
    aggregate, so a hot key is collapsed to one row per task before the
    shuffle and cannot skew it.
    """
    return df.groupBy(*keys).agg(row_total(weight).alias(count_col))


def scaled_counts(
    sample_rows: DataFrame,
    keys: Sequence[str],
    factor: float,
    count_col: str,
    weight: str | None = None,
) -> DataFrame:
    """``round(count(*) * factor)`` per group of a sample (a double, half up)."""
    return sample_rows.groupBy(*keys).agg(
        F.round(row_total(weight) * F.lit(float(factor))).alias(count_col)
    )


def top_k(df: DataFrame, count_col: str, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest groups, ties broken by the keys.

    ``orderBy(..).limit(k)`` is planned as ``TakeOrderedAndProject``: every
    task keeps its own best ``k`` and only those reach the final merge.
    """
    return df.orderBy(F.desc(count_col), *key_order(keys)).limit(k)


def order_result(df: DataFrame, order: str, count_col: str, keys: Sequence[str]) -> DataFrame:
    """Presentation order: by count (desc, keys as tie-breakers) or by key."""
    if order == "count":
        return df.orderBy(F.desc(count_col), *key_order(keys))
    if order == "key":
        return df.orderBy(*key_order(keys))
    raise ValueError(f"unknown order {order!r}")
