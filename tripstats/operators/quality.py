"""Quality gate over a trip layer, and a quarantine split.

The gate's four checks are answered by **one** aggregate (one scan), not one
count per check.  Its result is a small table ``(check_no, check_name,
observed, passed)``; :func:`enforce_gate` raises for the first failing check
in check order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    """A quality check failed."""


@dataclass(frozen=True)
class GateColumns:
    pickup: str = "pickup_datetime"
    location: str = "PULocationID"
    passengers: str = "passenger_count"


# Check numbers and names, in the order they are enforced.
CHECKS = (
    (1, "row_count_positive"),
    (2, "pickup_datetime_not_null"),
    (3, "pu_location_not_null"),
    (4, "passenger_count_positive"),
)


def gate_report(df: DataFrame, cols: GateColumns = GateColumns()) -> DataFrame:
    """One pass: row count and the violation count of each rule.

    ``observed`` is the row count for check 1 and the number of violating
    rows for the others.  A null passenger count is not a violation (the
    rule is ``passenger_count <= 0``), and the dropoff location is not checked.
    """
    return report_of(gate_counts(df, cols))


def gate_counts(df: DataFrame, cols: GateColumns = GateColumns(), group_cols: Sequence[str] = ()) -> DataFrame:
    """(group_cols, n, v2, v3, v4): the row count and each rule's violations; groups' counts add up."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(cols.pickup).isNull()).alias("v2"),
        F.count_if(F.col(cols.location).isNull()).alias("v3"),
        F.count_if(F.col(cols.passengers) <= 0).alias("v4"),
    )


def report_of(stats: DataFrame) -> DataFrame:
    """The gate's report from one row of counts."""
    entries = [
        F.struct(
            F.lit(no).alias("check_no"),
            F.lit(name).alias("check_name"),
            F.col("n" if no == 1 else f"v{no}").cast("bigint").alias("observed"),
            ((F.col("n") > 0) if no == 1 else (F.col(f"v{no}") == 0)).alias("passed"),
        )
        for no, name in CHECKS
    ]
    return stats.select(F.inline(F.array(*entries)))


def enforce_gate(report: DataFrame) -> int:
    """Raise :class:`QualityGateError` for the lowest failing check.

    Collects the four-row report only; returns the row count on success.
    """
    rows = sorted(report.collect(), key=lambda r: r["check_no"])
    for r in rows:
        if not r["passed"]:
            raise QualityGateError(
                f"quality check {r['check_no']} {r['check_name']} failed (observed {r['observed']})"
            )
    return int(rows[0]["observed"])


def reject_reason(cols: GateColumns = GateColumns()) -> Column:
    """First broken row rule as text, or null for a good row."""
    return (
        F.when(F.col(cols.pickup).isNull(), F.lit("pickup_datetime_null"))
        .when(F.col(cols.location).isNull(), F.lit("pu_location_null"))
        .when(F.col(cols.passengers) <= 0, F.lit("passenger_count_not_positive"))
    )


def quarantine(df: DataFrame, cols: GateColumns = GateColumns()) -> tuple[DataFrame, DataFrame]:
    """Split a layer into rows that pass every row rule and rejected rows.

    Rejected rows carry ``reject_reason`` (the first rule they break).  Both
    sides are filters over the same input; to write both in one scan use
    :func:`tripstats.plans.pipeline.write_quarantine`.
    """
    reason = reject_reason(cols)
    clean = df.where(reason.isNull())
    rejects = df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
    return clean, rejects
