"""The six gold questions over the silver trip layer (trip column names)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.compare import GroupCountQuery


# The questions' domains, shared by the trip layer and the test-table carriers.


def hour_weekday(time_col: str) -> Callable[[DataFrame], DataFrame]:
    """Adds ``hour`` and ``day_of_week`` (1 = Sunday ... 7 = Saturday) of a column."""
    return lambda df: df.withColumns({"hour": F.hour(time_col), "day_of_week": F.dayofweek(time_col)})


def weekday_morning() -> Column:
    return F.col("hour").between(6, 11) & F.col("day_of_week").between(2, 6)


def small_count(col: str) -> Callable[[], Column]:
    return lambda: F.col(col).isNotNull() & F.col(col).between(1, 8)


def positive(col: str) -> Callable[[], Column]:
    return lambda: F.col(col) > 0


Q1 = GroupCountQuery(
    name="Q1_Top20_Busiest_Pickup_Locations",
    keys=("PULocationID",),
    top=20,
    description="Top 20 pickup locations",
)
Q2 = GroupCountQuery(
    name="Q2_Top50_Weekday_Morning_Dropoffs",
    keys=("DOLocationID", "hour"),
    exact_col="exact_dropoff_count",
    sampled_col="sampled_dropoff_count",
    derive=hour_weekday("dropoff_datetime"),
    where=weekday_morning,
    top=50,
    description="Top 50 (dropoff location, hour), weekdays 06-11h by dropoff time",
)
Q3 = GroupCountQuery(
    name="Q3_Busiest_Taxi_Routes",
    keys=("PULocationID", "DOLocationID"),
    top=20,
    description="Top 20 (pickup, dropoff) routes",
)
Q4 = GroupCountQuery(
    name="Q4_Passenger_Count_Distribution",
    keys=("passenger_count",),
    where=small_count("passenger_count"),
    sketch_filtered=False,
    order="key",
    description="Trips per passenger count 1..8 (sketch over the whole layer)",
)
Q5 = GroupCountQuery(
    name="Q5_Payment_Type_Analysis",
    keys=("payment_type_desc",),
    description="Trips per payment description",
)
Q6 = GroupCountQuery(
    name="Q6_Top10_Frequent_Tip_Amounts",
    keys=("tip_amount",),
    where=positive("tip_amount"),
    top=10,
    description="Top 10 tip amounts above zero",
)

TAXI_QUERIES = (Q1, Q2, Q3, Q4, Q5, Q6)
