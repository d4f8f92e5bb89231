"""Error of an estimate against the exact counts, as a one-row aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(c: str) -> Column:
    return F.coalesce(F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))), F.lit(0.0))


def _abs_and_pct(exact_col: str, est_col: str, prefix: str) -> list[Column]:
    """``|sum exact - sum est|`` and that as a percent of ``sum exact``.

    Sums come first and are subtracted after, so over- and under-estimates
    of different keys cancel; a missing estimate counts as 0.  The percent is
    rounded to 4 decimals, half up, and is 0 when the exact total is 0.
    """
    exact, est = _total(exact_col), _total(est_col)
    abs_err = F.abs(exact - est)
    pct = F.when(exact != 0.0, abs_err / exact * 100.0).otherwise(F.lit(0.0))
    return [abs_err.alias(f"{prefix}_absolute_error"), F.round(pct, 4).alias(f"{prefix}_pct_error")]


def error_metrics(
    comparison: DataFrame,
    query_name: str,
    exact_col: str,
    sampled_col: str,
    cms_col: str = "cms_estimated_count",
) -> DataFrame:
    """One row: ``query_name`` and sample / CMS absolute and percent errors."""
    return comparison.agg(
        *_abs_and_pct(exact_col, sampled_col, "sample"), *_abs_and_pct(exact_col, cms_col, "cms")
    ).select(F.lit(query_name).alias("query_name"), "*")


def per_key_error_metrics(
    comparison: DataFrame,
    query_name: str,
    exact_col: str,
    sampled_col: str,
    cms_col: str = "cms_estimated_count",
) -> DataFrame:
    """Mean absolute error per key (no cancellation between keys)."""

    def mae(c: str) -> Column:
        return F.avg(F.abs(F.col(exact_col).cast("double") - F.coalesce(F.col(c).cast("double"), F.lit(0.0))))

    return comparison.agg(
        F.count(F.lit(1)).alias("keys"),
        mae(sampled_col).alias("sample_mean_abs_error"),
        mae(cms_col).alias("cms_mean_abs_error"),
    ).select(F.lit(query_name).alias("query_name"), "*")
