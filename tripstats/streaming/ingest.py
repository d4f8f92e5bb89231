"""Incremental ingest: new raw trip files -> silver, as a streaming query.

Replaces "poll for the raw file, then run ingest and clean": a file-source
stream picks up each new CSV file once, the same :func:`clean_trips`
transformation (stateless, so it runs unchanged on a stream) cleans it, and
the file sink appends it to the partitioned silver layer.  The checkpoint
location records which files were processed, so a restarted or failed query
neither skips nor duplicates a file (exactly-once file sink).  With
its default trigger the query processes everything present and stops, which
suits a scheduled batch run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import INCLUSIVE_MIDNIGHT, clean_trips
from ..schemas import (
    CORRUPT_RECORD_COL,
    DEFAULT_DATE_HI,
    DEFAULT_DATE_LO,
    RAW_TRIP_SCHEMA,
    SILVER_PARTITION_COLUMNS,
    SILVER_SCHEMA,
)
from ..sources.csv_source import csv_options, csv_schema
from ..sources.layers import write_partitioned
from ..sources.month_store import MonthStore, only_months

OBSERVATION = "ingest"
EVENT_TIME = "_event_time"
BATCH = "_batch"


def start_silver_stream(
    spark: SparkSession,
    raw_dir: str,
    silver_dir: str,
    checkpoint_dir: str,
    date_lo: str = DEFAULT_DATE_LO,
    date_hi: str = DEFAULT_DATE_HI,
    range_mode: str = INCLUSIVE_MIDNIGHT,
    trigger: Mapping[str, object] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the raw -> silver stream; returns the running query.

    The reader is the batch one's: a file whose header is not in the schema's
    order fails the query, and lines that do not parse are counted, batch by
    batch, as ``malformed_rows`` among ``raw_rows`` in the observation
    ``ingest`` of the query's progress.  ``trigger`` is given to
    ``DataStreamWriter.trigger`` (default: all files present, then stop).
    """
    silver = _silver_stream(spark, raw_dir, date_lo, date_hi, range_mode, max_files_per_trigger)
    writer = (
        silver.writeStream.format("parquet")
        .partitionBy(*SILVER_PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start(silver_dir)


def _silver_stream(
    spark: SparkSession, raw_dir: str, date_lo: str, date_hi: str, range_mode: str, max_files_per_trigger: int | None
) -> DataFrame:
    reader = spark.readStream.schema(csv_schema(RAW_TRIP_SCHEMA, True)).options(**csv_options(keep_corrupt=True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(raw_dir).observe(
        OBSERVATION,
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col(CORRUPT_RECORD_COL).isNotNull()).alias("malformed_rows"),
    )
    raw = raw.drop(CORRUPT_RECORD_COL)
    return clean_trips(raw, date_lo=date_lo, date_hi=date_hi, range_mode=range_mode)


# --- a published silver layer, batch by batch ---------------------------------------------


def start_published_stream(
    spark: SparkSession,
    raw_dir: str,
    silver_dir: str,
    checkpoint_dir: str,
    date_lo: str = DEFAULT_DATE_LO,
    date_hi: str = DEFAULT_DATE_HI,
    range_mode: str = INCLUSIVE_MIDNIGHT,
    trigger: Mapping[str, object] | None = None,
    max_files_per_trigger: int | None = None,
    compact_every: int = 16,
    dedup_within: str | None = None,
    on_publish: Callable[[SparkSession], object] | None = None,
) -> StreamingQuery:
    """Raw -> a published silver layer; each micro-batch lands in a folder of its own number.

    A batch that is run again overwrites its own folder, and one that is
    published already is not published twice, so replays add no row.  Batches
    are clustered by month when they land, and every ``compact_every`` batches
    they are published into their months (:func:`publish_batches`), which
    rewrites those months with right-sized files.  Readers see the published
    months; run :func:`publish_batches` when the stream stops.  A layer is
    written by one stream, or by batch runs, not by both.

    ``dedup_within`` (an interval, say ``"2 days"``) keeps one of equal raw
    rows, across batches too: their keys are state for as long as a pickup
    time is not that far behind the latest one seen, so state is bounded by
    the rows of the interval.  Rows that come later than that are not silver
    rows; :func:`late_rows` counts them.

    ``on_publish`` is called after each publication, and again when its batch
    is replayed, so it has to be repeatable;
    :func:`~tripstats.streaming.sketches.merge_published` is.
    """
    silver = _silver_stream(spark, raw_dir, date_lo, date_hi, range_mode, max_files_per_trigger)
    if dedup_within is not None:
        timed = silver.withColumn(EVENT_TIME, F.col("pickup_datetime").cast("timestamp")).withWatermark(EVENT_TIME, dedup_within)
        silver = timed.dropDuplicatesWithinWatermark(RAW_TRIP_SCHEMA.fieldNames()).drop(EVENT_TIME)

    def land(batch: DataFrame, number: int) -> None:
        write_partitioned(batch, _landing(silver_dir, number))
        if (number + 1) % compact_every == 0:
            publish_batches(batch.sparkSession, silver_dir, number)
            if on_publish is not None:
                on_publish(batch.sparkSession)

    writer = silver.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_dir)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _landing(silver_dir: str, number: int) -> str:
    return f"{silver_dir.rstrip('/')}/landing/batch={number}"


def landed_rows(spark: SparkSession, silver_dir: str, first: int, last: int) -> DataFrame:
    """The rows of landed batches ``first`` to ``last``, with the batch's number."""
    parts = [
        spark.read.schema(SILVER_SCHEMA).parquet(_landing(silver_dir, n)).withColumn(BATCH, F.lit(n)) for n in range(first, last + 1)
    ]
    return reduce(DataFrame.unionByName, parts)


def published_upto(store: MonthStore) -> int:
    """The last batch whose rows are published; -1 if there is none.  It stands in the manifest, as each month's source."""
    return max((int(e.source) for e in store.entries().values() if e.source is not None), default=-1)


def publish_batches(spark: SparkSession, silver_dir: str, upto: int) -> int:
    """Publish the landed batches up to number ``upto`` that are not yet; returns the rows added.

    Their months are written anew, old rows and new, in one version of the
    layer: the manifest's rows of that version say which batches it holds, so
    a batch is in the layer once or not at all.
    """
    store = MonthStore(spark, silver_dir)
    done = published_upto(store)
    if upto <= done:
        return 0
    landed = landed_rows(spark, silver_dir, done + 1, upto).drop(BATCH)
    counts = landed.groupBy(*SILVER_PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a month
    if counts:
        months = [(r["year"], r["month"]) for r in counts]
        rows = only_months(store.read(SILVER_SCHEMA), months).unionByName(landed)
        store.write(rows, months=months, sources=dict.fromkeys(months, str(upto)))
    return sum(r["n"] for r in counts)


def malformed_rows(query: StreamingQuery) -> int:
    """Malformed lines in the batches that the query still reports."""
    found = [(p["observedMetrics"] or {}).get(OBSERVATION) for p in query.recentProgress]
    return sum(int(m["malformed_rows"]) for m in found if m is not None)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped for coming behind the watermark, in the batches that the query still reports."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
