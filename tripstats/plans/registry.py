"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lookup import lookup_join, map_lookup, mapping_frame
from ..operators import compare as cmp
from ..operators.clean import HALF_OPEN, INCLUSIVE_MIDNIGHT, clean_trips, pickup_range
from ..operators.errors import error_metrics, per_key_error_metrics
from ..operators.quality import gate_report, quarantine
from ..operators.sample import sample_bernoulli_hash, sample_bernoulli_native, with_sample_sizes
from ..operators.sketch import cms_cells, cms_merge, cms_native
from ..schemas import PAYMENT_TYPE_MAP, SILVER_SCHEMA
from ..session import fresh_path
from ..sources.csv_source import read_raw_csv, write_csv
from ..sources.layers import partition_files, partition_volume, read_months, write_flat, write_partitioned
from . import carriers as C
from . import monthly_queries
from . import trip_carrier as T
from .taxi import TAXI_QUERIES

QueryFn = Callable[[SparkSession, str], DataFrame]

# Events window of the two range modes (text bounds, SURVEY P5).
EVENTS_LO = "2024-01-01"
EVENTS_HI = "2024-01-15"
TRIP_QUERIES = {f"q{i}": q for i, q in enumerate(TAXI_QUERIES, start=1)}


# --- the six questions, per method ------------------------------------------------


def exact(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmp.exact_side(C.CARRIER_QUERIES[q], C.table_for(spark, sf_dir, q))


def sampled(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmp.sample_side(C.CARRIER_QUERIES[q], C.sample_for(spark, sf_dir, q))


def sketched(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = C.CARRIER_QUERIES[q]
    return cmp.cms_side(spec, C.table_for(spark, sf_dir, q), C.NARROW_CMS)


def gold(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = C.CARRIER_QUERIES[q]
    sample = C.sample_for(spark, sf_dir, q)
    return cmp.comparison(spec, C.table_for(spark, sf_dir, q), sample, C.GOLD_CMS)


def trip_gold(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's own question on the carrier's silver: the definitions that users run."""
    return cmp.comparison(TRIP_QUERIES[q], T.carrier_silver(spark, sf_dir), C.stored_sample(spark, sf_dir, "trips"), C.GOLD_CMS)


def trip_sample_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stored_sample(spark, sf_dir, "trips").rows


def sample_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cmp.sample_top(C.C1, C.sample_for(spark, sf_dir, "q1"), 20)


def _stored_gold(q: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison without presentation order, written once for both metric queries and read back."""
    spec = C.CARRIER_QUERIES[q]
    tables = [C.QUERY_TABLE[q], *(("orders", "customer", "supplier") if q == "q3" else ())]
    place = C.stored_place(spark, sf_dir, f"gold-{q}", tables)
    try:
        return spark.read.parquet(spark.read.parquet(place).first()["path"])
    except AnalysisException:  # not there yet
        pass
    path = fresh_path(spark, f"gold-{q}")
    sample = C.sample_for(spark, sf_dir, q)
    write_flat(cmp.comparison(spec, C.table_for(spark, sf_dir, q), sample, C.GOLD_CMS, ordered=False), path)
    write_flat(spark.createDataFrame([(path,)], "path string").coalesce(1), place)  # last: only whole tables are found
    return spark.read.parquet(path)


def gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        error_metrics(_stored_gold(q, spark, sf_dir), spec.name, spec.exact_col, spec.sampled_col)
        for q, spec in C.CARRIER_QUERIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_metrics_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        per_key_error_metrics(_stored_gold(q, spark, sf_dir), spec.name, spec.exact_col, spec.sampled_col)
        for q, spec in C.CARRIER_QUERIES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- sampling and sketching ---------------------------------------------------------


def sample_bottom_k_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.lineitem_sample(spark, sf_dir).rows


def sample_bernoulli_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sample_bernoulli_hash(C.events(spark, sf_dir), C.EVENTS_SAMPLE_K, C.EVENTS_SAMPLE_KEY, C.SAMPLE_SEED)
    return s.rows


def sample_bernoulli_native_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own ``sample(fraction, seed)``: its rows depend on partitioning, so what can be told of any
    draw is returned: the population, the size aimed at, whether the rows are distinct rows of the table and
    whether their number is within six standard deviations."""
    s = sample_bernoulli_native(C.events(spark, sf_dir), C.EVENTS_SAMPLE_K, C.SAMPLE_SEED)
    p = min(1.0, C.EVENTS_SAMPLE_K / max(1, s.population))
    near = abs(s.size - p * s.population) <= 6 * (s.population * p * (1 - p)) ** 0.5
    ids = s.rows.select("event_id").join(C.events(spark, sf_dir).select("event_id"), "event_id", "left_semi")
    return ids.agg(
        F.lit(s.population).cast("long").alias("population"),
        F.lit(C.EVENTS_SAMPLE_K).cast("long").alias("expected_size"),
        (F.count_distinct("event_id") == s.size).alias("distinct_rows_of_table"),
        F.lit(near).alias("size_within_6_sigma"),
    )


def sample_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events sample written with its sizes beside it, and read back."""
    path = fresh_path(spark, "events-sample")
    write_flat(with_sample_sizes(C.stored_sample(spark, sf_dir, "events")), path)
    return spark.read.parquet(path)


def cms_build_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cms_cells(C.lineitem(spark, sf_dir), ["l_suppkey"], C.NARROW_CMS)


def _lineitem_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.lineitem(spark, sf_dir).withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})


def cms_build_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's binary sketch for each ship month: its size in bytes and the rows in it."""
    native = cms_native(_lineitem_months(spark, sf_dir), ["l_suppkey"], C.NARROW_CMS, group_cols=("year", "month"))
    return native.select("year", "month", F.octet_length("sketch").alias("sketch_bytes"), "total_count")


def cms_merge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sketch for each ship month, written as cells by month, read back and merged year by year."""
    path = fresh_path(spark, "cells")
    monthly = cms_cells(_lineitem_months(spark, sf_dir), ["l_suppkey"], C.NARROW_CMS, group_cols=("year", "month"))
    monthly.write.partitionBy("year", "month").parquet(path)
    cells = spark.read.schema("d int, b int, c long, year int, month int").parquet(path)
    years = [r["year"] for r in cells.select("year").distinct().orderBy("year").collect()]  # a few numbers
    yearly = [cms_merge(cells.where(F.col("year") == y).select("d", "b", "c")) for y in years]
    return cms_merge(*yearly) if yearly else cms_merge(cells.select("d", "b", "c"))


# --- layer steps on the lineitem trip carrier ----------------------------------------


def clean_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.carrier_silver(spark, sf_dir)


def clean_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.lineitem_raw_trips(spark, sf_dir)
    return clean_trips(
        raw.unionByName(raw), date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI, dedup=True
    )


def _events_range(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = C.events(spark, sf_dir)
    return ev.where(pickup_range(F.col("ts"), EVENTS_LO, EVENTS_HI, mode))


def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.lineitem_raw_trips(spark, sf_dir)
    return raw.select(
        "PULocationID", "DOLocationID", "payment_type",
        map_lookup(F.col("payment_type"), PAYMENT_TYPE_MAP).alias("payment_type_desc"),
    )


def enrich_broadcast_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.lineitem_raw_trips(spark, sf_dir).select("PULocationID", "DOLocationID", "payment_type")
    dim = mapping_frame(spark, PAYMENT_TYPE_MAP, "code", "description")
    return lookup_join(raw, "payment_type", dim, "code", "description", "payment_type_desc")


def ingest_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips written as header CSV, read back with the explicit schema."""
    path = fresh_path(spark, "raw-csv")
    write_csv(T.lineitem_raw_trips(spark, sf_dir), path)
    return read_raw_csv(spark, path)


def _written_silver(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "silver")
    write_partitioned(T.carrier_silver(spark, sf_dir), path)
    return path


def silver_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_silver(spark, sf_dir)
    lo, hi = T.month_bounds()
    return read_months(spark, path, lo, hi, SILVER_SCHEMA)


def layer_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_silver(spark, sf_dir)
    return partition_volume(spark.read.schema(SILVER_SCHEMA).parquet(path))


def layer_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of the written layer, and whether each has a data file (how many is Spark's choice)."""
    return partition_files(spark, _written_silver(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.min("files") >= 1, F.lit(True)).alias("files_in_each")
    )


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_report(T.carrier_silver(spark, sf_dir))


def _faulty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_faults(T.carrier_silver(spark, sf_dir), T.fault_rows(spark))


def quality_gate_fault(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_report(_faulty_silver(spark, sf_dir))


def quarantine_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_faulty_silver(spark, sf_dir))[0]


def quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_faulty_silver(spark, sf_dir))[1]


def queries() -> dict[str, QueryFn]:
    reg: dict[str, QueryFn] = {}
    for q in C.CARRIER_QUERIES:
        reg[f"{q}_exact"] = partial(exact, q)
    for q in C.CARRIER_QUERIES:
        reg[f"{q}_sample"] = partial(sampled, q)
    reg["q1_sample_topk"] = sample_topk
    for q in C.CARRIER_QUERIES:
        reg[f"{q}_cms"] = partial(sketched, q)
    for q in C.CARRIER_QUERIES:
        reg[f"gold_{q}"] = partial(gold, q)
    for q in TRIP_QUERIES:
        reg[f"trip_gold_{q}"] = partial(trip_gold, q)
    reg["trip_sample"] = trip_sample_q
    reg.update(
        {
            "gold_metrics": gold_metrics,
            "gold_metrics_per_key": gold_metrics_per_key,
            "sample_bottom_k": sample_bottom_k_q,
            "sample_bernoulli_hash": sample_bernoulli_q,
            "sample_bernoulli_native": sample_bernoulli_native_q,
            "sample_materialized": sample_materialized,
            "cms_build_cells": cms_build_cells,
            "cms_build_native": cms_build_native,
            "cms_merge": cms_merge_q,
            "clean_silver": clean_silver,
            "clean_dedup": clean_dedup,
            "filter_between_midnight": partial(_events_range, INCLUSIVE_MIDNIGHT),
            "filter_half_open": partial(_events_range, HALF_OPEN),
            "enrich_lookup": enrich_lookup,
            "enrich_broadcast_join": enrich_broadcast_join,
            "ingest_csv_roundtrip": ingest_csv_roundtrip,
            "silver_partition_scan": silver_partition_scan,
            "layer_volume": layer_volume,
            "layer_file_count": layer_file_count,
            "quality_gate": quality_gate,
            "quality_gate_fault": quality_gate_fault,
            "quarantine_clean": quarantine_clean,
            "quarantine_rejects": quarantine_rejects,
        }
    )
    return reg | monthly_queries.queries()
