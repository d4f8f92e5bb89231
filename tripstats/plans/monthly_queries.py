"""Registered queries over monthly state, heavy hitters and stratified estimates.

They run on the lineitem trip carrier, published by month, or on lineitem itself.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.heavy_hitters import bounded_top_k, top_k_by_summary
from ..operators.stratified import stratified_counts
from ..schemas import SILVER_PARTITION_COLUMNS, SILVER_SCHEMA
from ..session import fresh_path
from ..sources.month_store import MonthStore, only_months
from . import carriers as C
from . import monthly as M
from . import pipeline as P
from . import trip_carrier as T
from .taxi import Q1, Q2, Q5, Q6

# Fixed parameters: the month that is published a second time, with each row twice.
AGAIN_MONTH = (1997, 2)
# Counters a task of the heavy-hitter queries.
CAPACITY = 512
STRATIFIED = {"q1": Q1, "q2": Q2, "q5": Q5, "q6": Q6}
MIN_FILES = (1, 10**9)


def published_silver(spark: SparkSession, sf_dir: str) -> str:
    """A fresh silver layer of the carrier's trips; its path."""
    path = fresh_path(spark, "silver-published")
    MonthStore(spark, path).write(T.carrier_silver(spark, sf_dir), replace=True)
    return path


def _republish(spark: SparkSession, path: str) -> None:
    """Publish :data:`AGAIN_MONTH` again with every row twice; the other months stay as they are."""
    store = MonthStore(spark, path)
    month = only_months(store.read(SILVER_SCHEMA), [AGAIN_MONTH])
    store.write(month.unionByName(month), months=[AGAIN_MONTH])


def cms_month_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sketches after one month has changed: the merged cells, and how many months were recomputed."""
    silver = published_silver(spark, sf_dir)
    cells = fresh_path(spark, "monthly-cells")
    M.refresh_sketch(spark, silver, cells, Q1, C.NARROW_CMS)
    _republish(spark, silver)
    again = M.refresh_sketch(spark, silver, cells, Q1, C.NARROW_CMS)
    return M.merged_sketch(spark, silver, cells).withColumn("recomputed_months", F.lit(len(again)))


def sample_merge_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of all months merged from the states of months: that of the whole table, row for row."""
    silver, states = published_silver(spark, sf_dir), fresh_path(spark, "sample-states")
    M.refresh_sample(spark, silver, states, C.TRIP_SAMPLE_K, C.SAMPLE_SEED, "md5")
    return M.merged_sample(spark, silver, states, C.TRIP_SAMPLE_K, C.SAMPLE_SEED, "md5").rows


def sample_merge_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of a range of months, one of them published again since the first draw: of full size, from their states."""
    silver, states = published_silver(spark, sf_dir), fresh_path(spark, "sample-states")
    M.refresh_sample(spark, silver, states, C.TRIP_SAMPLE_K, C.SAMPLE_SEED, "md5")
    _republish(spark, silver)
    M.refresh_sample(spark, silver, states, C.TRIP_SAMPLE_K, C.SAMPLE_SEED, "md5")
    months = (T.SCAN_MONTH_LO, T.SCAN_MONTH_HI)
    return M.merged_sample(spark, silver, states, C.TRIP_SAMPLE_K, C.SAMPLE_SEED, "md5", months).rows


STRATUM_K = 20


def stratified(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question's counts from 20 rows of each month, with standard errors and 95 % intervals."""
    silver, states = published_silver(spark, sf_dir), fresh_path(spark, "sample-states")
    M.refresh_sample(spark, silver, states, STRATUM_K, C.SAMPLE_SEED, "md5")
    rows = M.sample_state_rows(spark, silver, states, STRATUM_K, C.SAMPLE_SEED, "md5")
    return stratified_counts(rows, STRATIFIED[q], SILVER_PARTITION_COLUMNS)


def heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact top 20 from summaries and a count of the candidates only; whether the summary's bounds hold."""
    top = top_k_by_summary(C.lineitem(spark, sf_dir), ["l_suppkey"], 20, C.C1.exact_col, CAPACITY)
    held = F.col(C.C1.exact_col).between(F.col("lower_bound"), F.col("upper_bound"))
    return top.select("l_suppkey", C.C1.exact_col, held.alias("bounds_hold"))


def heavy_hitters_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored monthly summaries of a question, one month published again, merged: the top 20 with their bounds."""
    silver, path = published_silver(spark, sf_dir), fresh_path(spark, "monthly-summaries")
    M.refresh_summary(spark, silver, path, Q1)
    _republish(spark, silver)
    M.refresh_summary(spark, silver, path, Q1)
    return bounded_top_k(M.merged_summary(spark, silver, path, Q1), Q1.keys, 20)


def gate_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's report from stored monthly counts, after one month was published again and checked alone."""
    silver, path = published_silver(spark, sf_dir), fresh_path(spark, "gate-state")
    M.refresh_gate(spark, silver, path)
    _republish(spark, silver)
    M.refresh_gate(spark, silver, path)
    return M.merged_gate(spark, silver, path)


def volume_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status that the volume check gives the published layer, for small and large minimum file counts."""
    files = P.silver_files(spark, published_silver(spark, sf_dir))
    rows = [(n, P.volume_status(files, n)) for n in MIN_FILES]
    return spark.createDataFrame(rows, "min_files bigint, status string").coalesce(1)


def gold_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of two questions with each method timed: whether every method has a time, and the sketch's error sign."""
    silver, out = published_silver(spark, sf_dir), fresh_path(spark, "gold-timed")
    P.build_sample(spark, silver, f"{out}/sample", C.TRIP_SAMPLE_K, C.SAMPLE_SEED)
    P.build_gold(spark, silver, f"{out}/sample", f"{out}/gold", queries=(Q1, Q5), measure_times=True)
    times = [F.coalesce(F.col(f"{m}_time_ms") >= 0, F.lit(False)).alias(f"{m}_timed") for m in ("exact", "sample", "cms")]
    return P.read_metrics(spark, f"{out}/gold").select("query_name", *times, (F.col("cms_absolute_error") >= 0).alias("cms_error_known"))


def queries() -> dict:
    out = {
        "cms_month_refresh": cms_month_refresh,
        "sample_merge_months": sample_merge_months,
        "sample_merge_range": sample_merge_range,
        "q1_heavy_hitters": heavy_hitters,
        "heavy_hitters_by_month": heavy_hitters_by_month,
        "gate_by_month": gate_by_month,
        "volume_gate": volume_gate,
        "gold_times": gold_times,
    }
    return out | {f"stratified_{q}": partial(stratified, q) for q in STRATIFIED}
