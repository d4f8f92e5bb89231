"""Published months, and state that is kept and refreshed by month."""

import pytest
from pyspark.sql import functions as F

from tripstats.operators.sketch import SketchParams, cms_cells, cms_merge
from tripstats.plans import monthly as M
from tripstats.plans import pipeline as P
from tripstats.plans import trip_carrier as T
from tripstats.plans.taxi import Q1, Q2
from tripstats.schemas import SILVER_SCHEMA
from tripstats.sources import month_store as S
from tripstats.sources.layers import write_partitioned

from .conftest import SF_SMALL

PARAMS = SketchParams(eps=0.05, hash="xxhash64")
MONTH = (1997, 2)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layer") / "silver")
    write_partitioned(T.carrier_silver(spark, SF_SMALL).where("year = 1997"), path)
    return spark.read.schema(SILVER_SCHEMA).parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_write_replace_and_read(spark, silver, tmp_dir):
    store = S.MonthStore(spark, f"{tmp_dir}/s")
    assert not store.exists() and store.entries() == {} and store.read(SILVER_SCHEMA).count() == 0
    assert store.write(silver) == silver.count()
    assert rows(store.read(SILVER_SCHEMA)) == rows(silver)
    first = store.identities()
    assert len(first) == 12 and len(set(first.values())) == 1
    entries = store.entries()
    assert sum(e.row_count for e in entries.values()) == silver.count() and all(e.files >= 1 and e.bytes > 0 for e in entries.values())
    # one month again, with other rows; another one emptied by name
    month = S.only_months(silver, [MONTH])
    store.write(month.unionByName(month), months=[MONTH, (1997, 5)])
    second = store.identities()
    assert {m for m in first if second.get(m) != first[m]} == {MONTH, (1997, 5)} and (1997, 5) not in second
    want = silver.where("month <> 5").unionByName(month)
    assert rows(store.read(SILVER_SCHEMA)) == rows(want)
    got = store.read(SILVER_SCHEMA, ("1997-02-01", "1997-06-30"))
    assert rows(got) == rows(want.where("month BETWEEN 2 AND 6"))
    # only the folders of the range are listed
    assert all(any(f"/month={m}/" in f for m in (2, 3, 4, 6)) for f in got.inputFiles())
    # a whole new layer empties what it does not have
    store.write(month, replace=True)
    assert rows(store.read(SILVER_SCHEMA)) == rows(month)
    store.write(silver.where("false"), replace=True)
    assert store.read(SILVER_SCHEMA).count() == 0 and store.identities() == {}


def test_killed_write_leaves_the_layer(spark, silver, tmp_dir, monkeypatch):
    store = S.MonthStore(spark, f"{tmp_dir}/s")
    store.write(silver)
    before = store.identities()

    def killed(self, rows):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(S.MonthStore, "_append", killed)
        with pytest.raises(KeyboardInterrupt):
            store.write(silver.limit(3), replace=True)
    assert store.identities() == before and rows(store.read(SILVER_SCHEMA)) == rows(silver)
    # its folder goes with the next clean-up, those in use stay; young folders are spared
    assert store.vacuum(min_age_hours=1) == []
    assert len(store.vacuum(min_age_hours=0)) == 1
    assert rows(store.read(SILVER_SCHEMA)) == rows(silver)


def test_build_silver_failure_keeps_the_old_layer(spark, tmp_dir):
    T.lineitem_raw_trips(spark, SF_SMALL).limit(500).write.parquet(f"{tmp_dir}/bronze")
    window = dict(date_lo=T.CARRIER_DATE_LO, date_hi=T.CARRIER_DATE_HI)
    n = P.build_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", **window)
    with pytest.raises(Exception):
        P.build_silver(spark, f"{tmp_dir}/nowhere", f"{tmp_dir}/silver", **window)
    assert P.read_silver(spark, f"{tmp_dir}/silver").count() == n > 0
    one = P.read_silver(spark, f"{tmp_dir}/silver").where("year = 1998")
    T.lineitem_raw_trips(spark, SF_SMALL).limit(500).where("year(tpep_pickup_datetime) = 1998").write.parquet(f"{tmp_dir}/b98")
    assert P.build_silver(spark, f"{tmp_dir}/b98", f"{tmp_dir}/silver", incremental=True, **window) == one.count()
    assert P.read_silver(spark, f"{tmp_dir}/silver").count() == n


def test_null_months_are_a_month(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2020, 1), (2, None, None), (3, None, None)], "x int, year int, month int")
    store = S.MonthStore(spark, f"{tmp_dir}/s")
    store.write(df)
    assert rows(store.read(df.schema)) == rows(df)
    assert store.entries()[(None, None)].row_count == 2
    store.write(df.limit(0), months=[(None, None)])
    assert [r.x for r in store.read(df.schema).collect()] == [1]


def test_one_month_refresh_leaves_the_others(spark, silver, tmp_dir):
    layer, path = f"{tmp_dir}/silver", f"{tmp_dir}/cells"
    store = S.MonthStore(spark, layer)
    store.write(silver)
    cells = lambda df: rows(cms_cells(df, ["PULocationID"], PARAMS))
    assert M.refresh_sketch(spark, layer, path, Q1, PARAMS, ("1997-02-01", "1997-02-28")) == [MONTH]
    with pytest.raises(S.StaleMonths):
        M.merged_sketch(spark, layer, path)
    assert rows(M.merged_sketch(spark, layer, path, ("1997-02-01", "1997-02-28"))) == cells(S.only_months(silver, [MONTH]))
    assert len(M.refresh_sketch(spark, layer, path, Q1, PARAMS)) == 11
    kept = S.MonthStore(spark, path).identities()
    assert M.refresh_sketch(spark, layer, path, Q1, PARAMS) == []
    assert rows(M.merged_sketch(spark, layer, path)) == cells(silver)
    # a month changes: gold would be wrong, so the sketch is refused until that month is recomputed
    month = S.only_months(silver, [MONTH])
    store.write(month.unionByName(month), months=[MONTH])
    with pytest.raises(S.StaleMonths):
        M.merged_sketch(spark, layer, path)
    assert M.refresh_sketch(spark, layer, path, Q1, PARAMS) == [MONTH]
    now = S.MonthStore(spark, path).identities()
    assert {m for m in now if now[m] != kept[m]} == {MONTH}
    assert rows(M.merged_sketch(spark, layer, path)) == cells(silver.unionByName(month))
    # a month goes
    store.write(silver.limit(0), months=[MONTH])
    assert M.refresh_sketch(spark, layer, path, Q1, PARAMS) == [MONTH]
    assert rows(M.merged_sketch(spark, layer, path)) == cells(silver.where("month <> 2"))


def test_plain_layer_is_followed_by_its_files(spark, silver, tmp_dir):
    layer, path = f"{tmp_dir}/silver", f"{tmp_dir}/cells"
    write_partitioned(silver, layer)
    assert len(M.refresh_sketch(spark, layer, path, Q2, PARAMS)) == 12
    assert M.refresh_sketch(spark, layer, path, Q2, PARAMS) == []
    S.only_months(silver, [MONTH]).coalesce(1).write.mode("append").partitionBy("year", "month").parquet(layer)
    with pytest.raises(S.StaleMonths):
        M.merged_sketch(spark, layer, path)
    assert M.refresh_sketch(spark, layer, path, Q2, PARAMS) == [MONTH]
    merged = M.merged_sketch(spark, layer, path)
    grown = silver.unionByName(S.only_months(silver, [MONTH]))
    assert rows(merged) == rows(cms_merge(cms_cells(Q2.domain(grown), Q2.keys, PARAMS)))


def test_month_without_rows_of_the_question_is_covered(spark, silver, tmp_dir):
    """Q2 has no rows in a month: its sketch is empty there, but up to date."""
    layer, path = f"{tmp_dir}/silver", f"{tmp_dir}/cells"
    none = F.lit(None).cast("timestamp_ntz")
    S.MonthStore(spark, layer).write(silver.withColumn("dropoff_datetime", F.when(F.col("month") != 2, F.col("dropoff_datetime")).otherwise(none)))
    assert len(M.refresh_sketch(spark, layer, path, Q2, PARAMS)) == 12
    assert M.refresh_sketch(spark, layer, path, Q2, PARAMS) == []
    assert M.merged_sketch(spark, layer, path, ("1997-02-01", "1997-02-28")).count() == 0


def test_sample_of_months_is_that_of_the_whole(spark, silver, tmp_dir):
    from tripstats.operators.sample import sample_content_k

    layer, states = f"{tmp_dir}/silver", f"{tmp_dir}/states"
    hot = silver.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("col")  # many copies of a row
    store = S.MonthStore(spark, layer)
    store.write(silver.unionByName(hot))
    for method in ("xxhash64", "md5"):
        assert len(M.refresh_sample(spark, layer, states, 150, 7, method)) == 12
        got = M.merged_sample(spark, layer, states, 150, 7, method)
        want = sample_content_k(silver.unionByName(hot), 150, 7, method=method)
        assert (got.population, got.size) == (want.population, want.size) and rows(got.rows) == rows(want.rows)
    part = M.merged_sample(spark, layer, states, 150, 7, "md5", ("1997-02-01", "1997-03-31"))
    want = sample_content_k(silver.unionByName(hot).where("month IN (2, 3)"), 150, 7, method="md5")
    assert part.size == want.size and rows(part.rows) == rows(want.rows)
    month = S.only_months(silver, [MONTH])
    store.write(month.limit(5), months=[MONTH])
    assert M.refresh_sample(spark, layer, states, 150, 7, "md5") == [MONTH]
    grown = silver.unionByName(hot).where("month <> 2").unionByName(month.limit(5))
    assert rows(M.merged_sample(spark, layer, states, 150, 7, "md5").rows) == rows(sample_content_k(grown, 150, 7, method="md5").rows)


def test_too_few_ranks_are_redone(spark, silver, monkeypatch):
    """A threshold that lets too few rows pass: the states are cut again without it."""
    from tripstats.operators import sample as A

    want = rows(A.sample_states(silver, 30, ["year", "month"], 3))
    monkeypatch.setattr(A, "prefilter_threshold", lambda size, n: 1)
    assert rows(A.sample_states(silver, 30, ["year", "month"], 3)) == want
