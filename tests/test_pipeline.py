"""End to end: CSV -> bronze -> silver -> gate -> sample -> gold, and the stream."""

import os

from pyspark.sql import functions as F

from tripstats.operators.sketch import SketchParams
from tripstats.plans import trip_carrier as T
from tripstats.plans.pipeline import read_silver, run_pipeline
from tripstats.plans.taxi import Q1
from tripstats.sources.csv_source import write_csv
from tripstats.streaming import start_silver_stream

from .conftest import SF_SMALL


def _raw_csv(spark, path):
    write_csv(T.lineitem_raw_trips(spark, SF_SMALL), path)
    return path


def test_run_pipeline(spark, tmp_dir):
    raw = _raw_csv(spark, os.path.join(tmp_dir, "raw"))
    res = run_pipeline(
        spark, raw, os.path.join(tmp_dir, "out"), sample_size=500,
        params=SketchParams(eps=0.05), date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI,
    )
    assert res.status == "ok"
    assert res.counts["bronze_rows"] == 6000
    silver = read_silver(spark, res.layout.silver)
    assert res.counts["silver_rows"] == silver.count() == T.carrier_silver(spark, SF_SMALL).count()
    assert res.counts["sample_rows"] == 500
    assert [m["query_name"] for m in res.metrics][0] == Q1.name
    assert len(res.metrics) == 6
    assert all(m["exact_time_ms"] is None for m in res.metrics)
    q1 = spark.read.parquet(f"{res.layout.gold}/query1")
    assert q1.columns == ["PULocationID", "exact_trip_count", "sampled_trip_count", "cms_estimated_count"]
    top = silver.groupBy("PULocationID").count().orderBy(F.desc("count"), "PULocationID").limit(20)
    assert sorted(tuple(r) for r in top.collect()) == sorted(
        (r["PULocationID"], r["exact_trip_count"]) for r in q1.collect()
    )
    assert all(r["cms_estimated_count"] >= r["exact_trip_count"] for r in q1.collect())
    q4 = spark.read.parquet(f"{res.layout.gold}/query4")
    assert all(1 <= r["passenger_count"] <= 8 for r in q4.collect())
    metrics = spark.read.json(f"{res.layout.gold}/metrics")
    assert metrics.count() == 6
    # the comparison built from timed parts, from stored sketches and in one plan are the same
    from tripstats.plans.pipeline import build_gold, build_sketches, read_sample
    from tripstats.operators.compare import comparison
    from tripstats.plans.taxi import TAXI_QUERIES

    params = SketchParams(eps=0.05)
    timed = build_gold(spark, res.layout.silver, res.layout.sample, f"{tmp_dir}/timed", params, measure_times=True)
    assert all(m["exact_time_ms"] is not None and m["cms_time_ms"] is not None for m in timed)
    build_sketches(spark, res.layout.silver, f"{tmp_dir}/sketches", params)
    build_gold(spark, res.layout.silver, res.layout.sample, f"{tmp_dir}/again", params, sketch_path=f"{tmp_dir}/sketches")
    sample = read_sample(spark, res.layout.sample)
    for i, q in enumerate(TAXI_QUERIES, start=1):
        direct = sorted(tuple(r) for r in comparison(q, silver, sample, params).collect())
        for root in (res.layout.gold, f"{tmp_dir}/timed", f"{tmp_dir}/again"):
            stored = sorted(tuple(r) for r in spark.read.parquet(f"{root}/query{i}").collect())
            assert stored == direct, (q.name, root)


def test_sample_and_gold_do_not_depend_on_files(spark, tmp_dir):
    """Two roots, other partition counts: the same rows give the same sample and gold."""
    from tripstats.plans.pipeline import build_gold, build_sample
    from tripstats.sources.layers import write_partitioned

    silver = T.carrier_silver(spark, SF_SMALL)
    rows, gold = [], []
    for i, frame in enumerate((silver, silver.repartition(7, "DOLocationID").sortWithinPartitions(F.desc("fare_amount")))):
        root = f"{tmp_dir}/root{i}"
        write_partitioned(frame, f"{root}/silver")
        sample = build_sample(spark, f"{root}/silver", f"{root}/sample", k=400)
        assert sample.size == sample.rows.count() == 400 and sample.population == silver.count()
        rows.append(sorted(map(str, sample.rows.select(*sorted(sample.rows.columns)).collect())))
        build_gold(spark, f"{root}/silver", f"{root}/sample", f"{root}/gold", SketchParams(eps=0.05, hash="xxhash64"))
        gold.append([sorted(map(str, spark.read.parquet(f"{root}/gold/query{q}").collect())) for q in range(1, 7)])
    assert rows[0] == rows[1] and gold[0] == gold[1]


def test_empty_silver_is_insufficient_data(spark, tmp_dir):
    raw = _raw_csv(spark, os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, raw, os.path.join(tmp_dir, "out"), date_lo="1900-01-01", date_hi="1900-01-02")
    assert res.status == "insufficient_data" and res.counts["silver_files"] == 0


def test_stream_refuses_a_swapped_header_and_counts_malformed_lines(spark, tmp_dir):
    import pytest
    from pyspark.errors import StreamingQueryException
    from tripstats.schemas import RAW_TRIP_SCHEMA
    from tripstats.streaming import malformed_rows

    names = RAW_TRIP_SCHEMA.fieldNames()
    good = T.lineitem_raw_trips(spark, SF_SMALL).limit(20)
    kw = dict(date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI)
    good.coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/ok/a")
    os.makedirs(f"{tmp_dir}/ok/b")
    with open(f"{tmp_dir}/ok/b/bad.csv", "w") as f:
        f.write(",".join(names) + "\n" + "A,1997-01-01 00:00:00,1997-01-01 01:00:00,many" + "," * (len(names) - 4) + "\n")
    query = start_silver_stream(spark, f"{tmp_dir}/ok/*", f"{tmp_dir}/silver", f"{tmp_dir}/ck", trigger={"availableNow": True}, **kw)
    query.awaitTermination()
    assert malformed_rows(query) == 1
    swapped = [n for n in names]
    i, j = names.index("fare_amount"), names.index("tip_amount")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    good.select(*swapped).coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/swapped/a")
    with pytest.raises(StreamingQueryException):
        start_silver_stream(spark, f"{tmp_dir}/swapped/*", f"{tmp_dir}/silver2", f"{tmp_dir}/ck2", **kw).awaitTermination()


def test_pipeline_stops_on_too_few_files(spark, tmp_dir):
    raw = _raw_csv(spark, os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, raw, os.path.join(tmp_dir, "out"), sample_size=50, min_files=10**6,
                       date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI, measure_times=False)
    assert res.status == "insufficient_data"
    assert not res.metrics


def test_stream_ingest_is_incremental(spark, tmp_dir):
    from tripstats.operators.clean import clean_trips

    raw_all = T.lineitem_raw_trips(spark, SF_SMALL)
    first_half = raw_all.where(F.col("VendorID") == "A")
    second_half = raw_all.where(F.col("VendorID") != "A")
    raw_dir, silver_dir, ckpt = (os.path.join(tmp_dir, d) for d in ("raw", "silver", "ckpt"))
    kw = dict(date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI)
    first_half.coalesce(1).write.option("header", "true").csv(os.path.join(raw_dir, "part1"))
    src = raw_dir + "/*"
    start_silver_stream(spark, src, silver_dir, ckpt, **kw).awaitTermination()
    first = read_silver(spark, silver_dir).count()
    assert first == clean_trips(first_half, **kw).count()
    # nothing new: a second run processes nothing
    start_silver_stream(spark, src, silver_dir, ckpt, **kw).awaitTermination()
    assert read_silver(spark, silver_dir).count() == first
    # a new file arrives: only it is appended, exactly once
    second_half.coalesce(1).write.option("header", "true").csv(os.path.join(raw_dir, "part2"))
    start_silver_stream(spark, src, silver_dir, ckpt, **kw).awaitTermination()
    assert read_silver(spark, silver_dir).count() == clean_trips(raw_all, **kw).count()


def test_sample_of_many_copies_is_proportional(spark, tmp_dir):
    """A third of silver is one repeated trip; the sample keeps ~a third of copies."""
    from tripstats.plans.pipeline import build_sample
    from tripstats.sources.layers import write_partitioned

    silver = T.carrier_silver(spark, SF_SMALL)
    n = silver.count()
    copy = silver.limit(1)
    rep = copy.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_i")).drop("_i")
    path = tmp_dir + "/silver"
    write_partitioned(silver.unionByName(rep), path)
    s = build_sample(spark, path, tmp_dir + "/sample", k=600)
    first = copy.first()
    same = s.rows.where(
        (F.col("tpep_pickup_datetime") == first["tpep_pickup_datetime"])
        & (F.col("PULocationID") == first["PULocationID"])
        & (F.col("DOLocationID") == first["DOLocationID"])
        & (F.col("fare_amount") == first["fare_amount"])
    ).count()
    share = (n // 2 + 1) / (n + n // 2)
    assert s.size == 600
    assert abs(same / 600 - share) < 0.1


def test_cli_stages(spark, tmp_dir):
    """The four stages as separate jobs, as they would be submitted."""
    import json

    from tripstats import cli

    raw = _raw_csv(spark, os.path.join(tmp_dir, "raw"))
    d = {k: os.path.join(tmp_dir, k) for k in ("bronze", "silver", "sample", "report", "gold", "sketches")}
    window = ["--date-lo", T.CARRIER_DATE_LO, "--date-hi", T.CARRIER_DATE_HI]
    assert cli.main(["ingest", "--raw", raw, "--bronze", d["bronze"]], spark=spark) == 0
    assert cli.main(["clean", "--bronze", d["bronze"], "--silver", d["silver"], "--sample", d["sample"],
                     "--sample-size", "300", *window], spark=spark) == 0
    assert cli.main(["validate", "--silver", d["silver"], "--report", d["report"]], spark=spark) == 0
    assert cli.main(["analytics", "--silver", d["silver"], "--sample", d["sample"], "--gold", d["gold"],
                     "--eps", "0.05", "--no-times"], spark=spark) == 0
    assert cli.main(["sketches", "--silver", d["silver"], "--sketches", d["sketches"], "--eps", "0.05"], spark=spark) == 0
    # a second run finds nothing to recompute; silver published again makes the sketches stale, so gold refuses them
    assert cli.main(["sketches", "--silver", d["silver"], "--sketches", d["sketches"], "--eps", "0.05"], spark=spark) == 0
    with_sketches = ["analytics", "--silver", d["silver"], "--sample", d["sample"], "--gold", d["gold"] + "_s", "--eps", "0.05", "--sketches", d["sketches"]]
    assert cli.main(["clean", "--bronze", d["bronze"], "--silver", d["silver"], "--sample", d["sample"], "--sample-size", "300", *window], spark=spark) == 0
    assert cli.main(with_sketches, spark=spark) == 3
    assert cli.main(["sketches", "--silver", d["silver"], "--sketches", d["sketches"], "--eps", "0.05",
                     "--months", "1997-01-01", "1997-03-31"], spark=spark) == 0
    assert cli.main(with_sketches, spark=spark) == 3  # three months are up to date, the others not
    # a month range: exact counts of the pruned silver only, stored sketches of those months
    assert cli.main(["analytics", "--silver", d["silver"], "--sample", d["sample"], "--gold", d["gold"] + "_m",
                     "--eps", "0.05", "--sketches", d["sketches"], "--months", "1997-01-01", "1997-03-31"], spark=spark) == 0
    q5 = spark.read.parquet(d["gold"] + "_m/query5")
    in_range = read_silver(spark, d["silver"]).where("year = 1997 AND month BETWEEN 1 AND 3").count()
    assert sum(r["exact_trip_count"] for r in q5.collect()) == in_range
    assert q5.count() and all(r["exact_trip_count"] <= r["cms_estimated_count"] <= in_range for r in q5.collect())
    metrics = [json.loads(line) for f in os.listdir(d["gold"] + "/metrics") if f.endswith(".json")
               for line in open(os.path.join(d["gold"], "metrics", f))]
    assert len(metrics) == 6
    # a failing gate exits non-zero
    bad = T.with_faults(read_silver(spark, d["silver"]), T.fault_rows(spark))
    from tripstats.sources.layers import write_partitioned

    write_partitioned(bad, d["silver"] + "_bad")
    assert cli.main(["validate", "--silver", d["silver"] + "_bad", "--report", d["report"] + "_bad"], spark=spark) == 2
