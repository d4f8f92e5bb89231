"""The stream into a published layer, the gate's monthly state and the quarantine."""

import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from tripstats.operators.clean import clean_trips
from tripstats.operators.compare import sketch_cells_for
from tripstats.operators.quality import QualityGateError, gate_report
from tripstats.operators.sketch import SketchParams
from tripstats.plans import monthly as M
from tripstats.plans import pipeline as P
from tripstats.plans import trip_carrier as T
from tripstats.plans.taxi import TAXI_QUERIES
from tripstats.schemas import SILVER_SCHEMA
from tripstats.sources.month_store import MonthStore, StaleMonths, only_months
from tripstats.streaming import ingest, late_rows, merge_published, publish_batches, start_published_stream

from .conftest import SF_SMALL

WINDOW = dict(date_lo="1997-01-01", date_hi="1997-04-30")


def rows(df):
    return sorted(map(str, df.collect()))


def test_batches_are_published_once(spark, tmp_dir):
    raw = T.lineitem_raw_trips(spark, SF_SMALL).where("tpep_pickup_datetime < '1997-06' AND tpep_pickup_datetime >= '1997-01'")
    parts = [raw.where(F.col("VendorID") == v) for v in ("A", "N", "R")]
    kw = dict(max_files_per_trigger=1, compact_every=2, **WINDOW)
    for i in (0, 1):
        parts[i].coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw/p{i}")
    start_published_stream(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/silver", f"{tmp_dir}/ck", **kw).awaitTermination()
    store = MonthStore(spark, f"{tmp_dir}/silver")
    want = clean_trips(parts[0].unionByName(parts[1]), **WINDOW)
    assert rows(store.read(SILVER_SCHEMA)) == rows(want) and ingest.published_upto(store) == 1
    # a third batch lands, and is published when asked for, once
    parts[2].coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw/p2")
    start_published_stream(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/silver", f"{tmp_dir}/ck", **kw).awaitTermination()
    assert rows(store.read(SILVER_SCHEMA)) == rows(want)
    added = publish_batches(spark, f"{tmp_dir}/silver", 2)
    want = clean_trips(parts[0].unionByName(parts[1]).unionByName(parts[2]), **WINDOW)
    assert added == clean_trips(parts[2], **WINDOW).count() and rows(store.read(SILVER_SCHEMA)) == rows(want)
    assert publish_batches(spark, f"{tmp_dir}/silver", 2) == 0
    # a replay of landed batches, before and after they were published, adds nothing
    landed = spark.read.schema(SILVER_SCHEMA).parquet(f"{tmp_dir}/silver/landing/batch=2").collect()
    again = spark.createDataFrame(landed, SILVER_SCHEMA)
    ingest.write_partitioned(again, f"{tmp_dir}/silver/landing/batch=2")
    assert publish_batches(spark, f"{tmp_dir}/silver", 2) == 0
    ingest.write_partitioned(again, f"{tmp_dir}/silver/landing/batch=3")
    ingest.write_partitioned(again.limit(3), f"{tmp_dir}/silver/landing/batch=3")
    assert publish_batches(spark, f"{tmp_dir}/silver", 3) == 3
    assert store.read(SILVER_SCHEMA).count() == want.count() + 3
    # a file a month, however many batches
    assert all(e.files == 1 for e in store.entries().values() if e.row_count)


def faulty(spark):
    silver = T.carrier_silver(spark, SF_SMALL).where("year = 1997 AND month < 4")
    return silver, T.with_faults(silver, T.fault_rows(spark)).select(*SILVER_SCHEMA.names)


def test_gate_checks_changed_months_only(spark, tmp_dir):
    silver, bad = faulty(spark)
    layer, state = f"{tmp_dir}/silver", f"{tmp_dir}/gate"
    store = MonthStore(spark, layer)
    store.write(silver)
    assert len(M.refresh_gate(spark, layer, state)) == 3 and M.refresh_gate(spark, layer, state) == []
    assert rows(M.merged_gate(spark, layer, state)) == rows(gate_report(silver))
    store.write(only_months(bad, [(1997, 1)]), months=[(1997, 1)])
    with pytest.raises(StaleMonths):
        M.merged_gate(spark, layer, state)
    assert M.refresh_gate(spark, layer, state) == [(1997, 1)]
    assert rows(M.merged_gate(spark, layer, state)) == rows(gate_report(bad))
    with pytest.raises(QualityGateError):
        P.run_gate(spark, layer, f"{tmp_dir}/report", state)


def test_quarantine_moves_rejects_by_reason(spark, tmp_dir):
    silver, bad = faulty(spark)
    layer = f"{tmp_dir}/silver"
    store = MonthStore(spark, layer)
    store.write(bad)
    before = store.identities()
    found = M.quarantine_months(spark, layer, f"{tmp_dir}/gate", f"{tmp_dir}/rejects")
    assert found == {"pu_location_null": 1, "passenger_count_not_positive": 2}
    assert rows(store.read(SILVER_SCHEMA)) == rows(silver)
    assert {m for m, v in store.identities().items() if v != before[m]} == {(1997, 1)}
    assert P.run_gate(spark, layer, f"{tmp_dir}/report", f"{tmp_dir}/gate") == silver.count()
    assert M.quarantine_months(spark, layer, f"{tmp_dir}/gate", f"{tmp_dir}/rejects") == {}
    assert MonthStore(spark, f"{tmp_dir}/rejects").entries()[(1997, 1)].row_count == 3
    assert os.path.isdir(f"{tmp_dir}/rejects/manifest")


def test_duplicates_across_batches_are_dropped(spark, tmp_dir):
    raw = T.lineitem_raw_trips(spark, SF_SMALL).where("tpep_pickup_datetime < '1997-05' AND tpep_pickup_datetime >= '1997-01'")
    for i, part in enumerate((raw, raw.unionByName(raw))):
        part.coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw/p{i}")
    want = clean_trips(raw, dedup=True, **WINDOW)
    kw = dict(max_files_per_trigger=1, compact_every=1, **WINDOW)
    query = start_published_stream(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/a", f"{tmp_dir}/ck-a", dedup_within="400 days", **kw)
    query.awaitTermination()
    store = MonthStore(spark, f"{tmp_dir}/a")
    assert store.read(SILVER_SCHEMA).count() == want.count() and late_rows(query) == 0
    assert rows(store.read(SILVER_SCHEMA).select("pickup_datetime", "PULocationID")) == rows(want.select("pickup_datetime", "PULocationID"))
    # state for one day only: a third batch lies behind the watermark that the first has set, and is counted
    raw.coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw/p2")
    query = start_published_stream(spark, f"{tmp_dir}/raw/*", f"{tmp_dir}/b", f"{tmp_dir}/ck-b", dedup_within="1 day", **kw)
    query.awaitTermination()
    assert late_rows(query) > 0
    assert MonthStore(spark, f"{tmp_dir}/b").read(SILVER_SCHEMA).count() == want.count()


PARAMS = SketchParams(eps=0.05, confidence=0.9, seed=7)
QUESTIONS = (TAXI_QUERIES[0], TAXI_QUERIES[5])


def assert_cells_of(spark, layer, root, silver):
    for i, q in enumerate(QUESTIONS, start=1):
        cells = M.merged_sketch(spark, layer, M.sketch_folder(root, i, PARAMS))
        assert rows(cells.select("d", "b", "c")) == rows(sketch_cells_for(q, silver, PARAMS).select("d", "b", "c"))


def test_stream_cells_equal_batch_cells(spark, tmp_dir):
    layer, root = f"{tmp_dir}/silver", f"{tmp_dir}/sketches"
    raw = T.lineitem_raw_trips(spark, SF_SMALL).where("tpep_pickup_datetime < '1997-05' AND tpep_pickup_datetime >= '1997-01'")
    parts = [raw.where(F.pmod(F.xxhash64(*raw.columns), F.lit(4)) == i) for i in range(4)]
    merge = partial(merge_published, silver_dir=layer, root=root, params=PARAMS, queries=QUESTIONS)
    kw = dict(max_files_per_trigger=1, compact_every=1, on_publish=merge, **WINDOW)
    for i in (0, 1):
        parts[i].coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw/p{i}")
    start_published_stream(spark, f"{tmp_dir}/raw/*", layer, f"{tmp_dir}/ck", **kw).awaitTermination()
    store = MonthStore(spark, layer)
    assert_cells_of(spark, layer, root, store.read(SILVER_SCHEMA))
    # a call without anything new, as in a replay, changes nothing
    assert all(m == ([], []) for m in merge(spark).values())
    # batches published in one go, the second for some months only: what is missing is told apart by month
    ingest.write_partitioned(clean_trips(parts[2], **WINDOW), f"{layer}/landing/batch=2")
    publish_batches(spark, layer, 2)
    ingest.write_partitioned(clean_trips(parts[3], **WINDOW).where("month < 3"), f"{layer}/landing/batch=3")
    publish_batches(spark, layer, 3)
    done = merge(spark)
    assert all(m == ([(1997, i) for i in (1, 2, 3, 4)], []) for m in done.values())
    assert_cells_of(spark, layer, root, store.read(SILVER_SCHEMA))
    # old and new cells are in one version: a replayed batch is not added again
    publish_batches(spark, layer, 3)
    assert all(m == ([], []) for m in merge(spark).values())


def test_cells_that_batches_do_not_explain_are_recomputed(spark, tmp_dir):
    layer, root = f"{tmp_dir}/silver", f"{tmp_dir}/sketches"
    silver, bad = faulty(spark)
    store = MonthStore(spark, layer)
    halves = [bad.where(F.pmod(F.xxhash64(*bad.columns), F.lit(2)) == i) for i in (0, 1)]
    for i in (0, 1):
        ingest.write_partitioned(halves[i], f"{layer}/landing/batch={i}")
    publish_batches(spark, layer, 0)
    call = lambda: merge_published(spark, layer, root, PARAMS, QUESTIONS)
    assert all(added == [] and len(again) == 3 for added, again in call().values())  # new months
    publish_batches(spark, layer, 1)
    M.quarantine_months(spark, layer, f"{tmp_dir}/gate", f"{tmp_dir}/rejects")
    # rows were taken from January since
    assert all(m == ([(1997, 2), (1997, 3)], [(1997, 1)]) for m in call().values())
    assert_cells_of(spark, layer, root, silver)
    # written by a batch run: no batch numbers
    store.write(only_months(bad, [(1997, 1)]), months=[(1997, 1)])
    assert all(m == ([], [(1997, 1)]) for m in call().values())
    assert_cells_of(spark, layer, root, bad)
    # an empty layer
    assert merge_published(spark, f"{tmp_dir}/none-yet", f"{tmp_dir}/s2", PARAMS, ()) == {}
