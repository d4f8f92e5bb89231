"""Cleaning, look-ups and the CSV edge (hand-made edge rows)."""

import os

import pytest

from tripstats.functions.lookup import lookup_join, map_lookup, mapping_frame
from tripstats.operators.clean import HALF_OPEN, INCLUSIVE_MIDNIGHT, clean_trips
from tripstats.schemas import PAYMENT_TYPE_MAP, RAW_TRIP_SCHEMA
from tripstats.sources.csv_source import read_raw_csv

HEADER = ",".join(RAW_TRIP_SCHEMA.fieldNames())


def trip_line(pickup="2021-03-04 10:00:00", dropoff="2021-03-04 10:20:00", passengers="1", pu="10", do="20",
              payment="1.0", tip="2.5"):
    vals = ["2", pickup, dropoff, passengers, "3.1", "1", "N", pu, do, payment, "12.0", "0.5", "0.5", tip,
            "0", "0.3", "15.8", "2.5", "0"]
    return ",".join(vals)


def write_csv(dirpath, name, lines, header=HEADER):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")
    return dirpath


def test_payment_codes(spark):
    df = spark.createDataFrame([("1.0",), (" 1.0 ",), ("1",), ("",), (None,), ("6.0",), ("0.0",)], "c string")
    got = [r[0] for r in df.select(map_lookup("c")).collect()]
    assert got == ["Credit card", "Credit card", "Other", "Other", "Other", "Voided trip", "Flex Fare trip"]


def test_lookup_join_same_as_map(spark):
    df = spark.createDataFrame([("1.0",), (" 2.0 ",), ("9",), (None,)], "c string")
    dim = mapping_frame(spark, PAYMENT_TYPE_MAP, "code", "desc")
    a = sorted(lookup_join(df, "c", dim, "code", "desc", "d").collect(), key=str)
    assert a == sorted(lookup_join(df, "c", dim, "code", "desc", "d", broadcast_dim=False).collect(), key=str)
    b = sorted(df.withColumn("d", map_lookup("c")).collect(), key=str)
    assert a == b


def test_lookup_of_a_code_listed_twice_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("1.0",), ("2.0",)], "c string")
    dim = spark.createDataFrame([("1.0", "b"), ("1.0", "a"), (None, "x")], "code string, desc string")
    got = sorted(tuple(r) for r in lookup_join(df, "c", dim, "code", "desc", "d").collect())
    assert got == [("1.0", "a"), ("2.0", "Other")]


def test_large_and_empty_maps(spark):
    df = spark.createDataFrame([("7",), ("99999",)], "c string")
    big = {str(i): f"d{i}" for i in range(12_000)}
    assert [r[0] for r in df.select(map_lookup("c", big)).collect()] == ["d7", "Other"]
    assert [r[0] for r in df.select(map_lookup("c", {})).collect()] == ["Other", "Other"]


def test_timestamp_forms(spark):
    from tripstats.operators.clean import parse_timestamp
    from pyspark.sql import functions as F

    forms = ["2021-01-01 10:00:00", "2021-01-01", "12:34:56", "2021-01-01T00:30:00+05:00", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(forms)], "i int, t string")
    got = [str(r[1]) for r in df.select("i", parse_timestamp(F.col("t"))).orderBy("i").collect()]
    # A bare time is null; a zone offset is dropped, not applied.
    assert got == ["2021-01-01 10:00:00", "2021-01-01 00:00:00", "None", "2021-01-01 00:30:00", "None"]


def test_dedup_on_columns_has_a_defined_survivor(spark):
    rows = [_row(fare_amount=f, tip_amount=t) for f, t in ((10.0, 3.0), (10.0, 1.0), (20.0, 2.0), (20.0, 2.0))]
    raw = _raw(spark, rows)
    kept = clean_trips(raw.repartition(3), dedup=["fare_amount"], dedup_order=["tip_amount"])
    assert sorted((r.fare_amount, r.tip_amount) for r in kept.collect()) == [(10.0, 1.0), (20.0, 2.0)]
    assert kept.columns == clean_trips(raw).columns


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TRIP_SCHEMA)


def _row(**kw):
    base = dict(VendorID="2", tpep_pickup_datetime="2021-03-04 10:00:00", tpep_dropoff_datetime="2021-03-04 10:20:00",
                passenger_count=1.0, trip_distance=1.0, RatecodeID="1", store_and_fwd_flag="N",
                PULocationID="10", DOLocationID="20", payment_type="1.0", fare_amount=10.0, extra=0.0,
                mta_tax=0.5, tip_amount=1.0, tolls_amount=0.0, improvement_surcharge=0.3,
                total_amount=12.0, congestion_surcharge=2.5, airport_fee=0.0)
    base.update(kw)
    return tuple(base[f] for f in RAW_TRIP_SCHEMA.fieldNames())


def test_filters_and_enrichment(spark):
    rows = [
        _row(),
        _row(passenger_count=0.0),
        _row(passenger_count=None),
        _row(PULocationID=None),
        _row(DOLocationID=None),
        _row(tpep_pickup_datetime="not a time"),
        _row(tpep_pickup_datetime="2019-12-31 23:59:59"),
        _row(tpep_pickup_datetime="2020-01-01 00:00:00"),
        _row(tpep_pickup_datetime="2023-12-31 00:00:00"),
        _row(tpep_pickup_datetime="2023-12-31 00:00:01"),
        _row(payment_type=" 2.0 "),
    ]
    out = clean_trips(_raw(spark, rows)).collect()
    picks = sorted(str(r["pickup_datetime"]) for r in out)
    assert picks == ["2020-01-01 00:00:00", "2021-03-04 10:00:00", "2021-03-04 10:00:00", "2023-12-31 00:00:00"]
    assert {r["payment_type_desc"] for r in out} == {"Credit card", "Cash"}
    assert all(r["year"] == r["pickup_datetime"].year and r["month"] == r["pickup_datetime"].month for r in out)


def test_half_open_keeps_whole_last_day(spark):
    rows = [_row(tpep_pickup_datetime=t) for t in ("2023-12-31 00:00:00", "2023-12-31 00:00:01",
                                                   "2023-12-31 23:59:59", "2024-01-01 00:00:00")]
    mid = clean_trips(_raw(spark, rows), range_mode=INCLUSIVE_MIDNIGHT).count()
    half = clean_trips(_raw(spark, rows), range_mode=HALF_OPEN).count()
    assert (mid, half) == (1, 3)


def test_dedup_option(spark):
    rows = [_row(), _row(), _row(tip_amount=3.0)]
    assert clean_trips(_raw(spark, rows)).count() == 3
    assert clean_trips(_raw(spark, rows), dedup=True).count() == 2
    assert clean_trips(_raw(spark, rows), dedup=["PULocationID"]).count() == 1


def test_csv_malformed_number_and_short_line(spark, tmp_dir):
    path = write_csv(tmp_dir, "a.csv", [trip_line(), trip_line(passengers="abc"), "2,2021-03-04 10:00:00"])
    df = read_raw_csv(spark, path)
    rows = df.collect()
    assert len(rows) == 3
    assert rows[1]["passenger_count"] is None
    assert rows[2]["PULocationID"] is None
    assert clean_trips(df).count() == 1


def test_csv_swapped_header_fails(spark, tmp_dir):
    names = RAW_TRIP_SCHEMA.fieldNames()
    swapped = names[:]
    swapped[7], swapped[8] = swapped[8], swapped[7]
    path = write_csv(tmp_dir, "b.csv", [trip_line()], header=",".join(swapped))
    with pytest.raises(Exception):
        read_raw_csv(spark, path).collect()
    # without the check the values silently land in the swapped columns
    assert read_raw_csv(spark, path, verify_header=False).count() == 1


def test_empty_location_text_is_null(spark, tmp_dir):
    path = write_csv(tmp_dir, "c.csv", [trip_line(pu="")])
    assert read_raw_csv(spark, path).first()["PULocationID"] is None


def test_ingest_counts_malformed_rows(spark, tmp_dir):
    from tripstats.plans.pipeline import build_silver, ingest, read_silver

    raw = write_csv(tmp_dir + "/raw", "a.csv", [trip_line(), trip_line(passengers="abc"), trip_line(tip="x1"),
                                                "2,2021-03-04 10:00:00"])
    rows, bad = ingest(spark, raw, tmp_dir + "/bronze")
    # unparseable values and the short line are malformed (all columns are parsed)
    assert (rows, bad) == (4, 3)
    corrupt = spark.read.parquet(tmp_dir + "/bronze").where("_corrupt_record IS NOT NULL").collect()
    assert sorted(r["_corrupt_record"] for r in corrupt) == sorted(
        [trip_line(passengers="abc"), trip_line(tip="x1"), "2,2021-03-04 10:00:00"]
    )
    # silver keeps its 24 columns; the malformed tip row has a null tip but valid keys
    build_silver(spark, tmp_dir + "/bronze", tmp_dir + "/silver")
    silver = read_silver(spark, tmp_dir + "/silver")
    assert "_corrupt_record" not in silver.columns and silver.count() == 2


def test_wall_clock_times_do_not_depend_on_session_zone(spark):
    """2021-03-14 02:30 does not exist in New York (DST gap); trip times keep it."""
    from pyspark.sql import functions as F

    from tripstats.plans.taxi import Q2

    rows = [_row(tpep_pickup_datetime="2021-03-14 02:30:00", tpep_dropoff_datetime="2021-03-15 07:30:00")]

    def observe():
        silver = clean_trips(_raw(spark, rows))
        out = Q2.prepared(silver).select(
            F.col("pickup_datetime").cast("string").alias("p"), F.hour("pickup_datetime").alias("ph"), "hour",
            "day_of_week", "year", "month",
        )
        return [tuple(r) for r in out.collect()]

    old = spark.conf.get("spark.sql.session.timeZone")
    utc = observe()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = observe()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny == [("2021-03-14 02:30:00", 2, 7, 2, 2021, 3)]
