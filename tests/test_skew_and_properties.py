"""Hot keys and randomized sketch / sample properties."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripstats.operators.compare import GroupCountQuery, comparison
from tripstats.operators.group_count import exact_counts, top_k
from tripstats.operators.sample import sample_bottom_k
from tripstats.operators.sketch import SketchParams, cms_cells, cms_estimate

from .conftest import SF_SMALL


def test_hot_key_holding_a_third_of_rows(spark):
    """One supplier key gets a third of all rows: counts, top-k and comparison stay exact."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    hot = li.withColumn(
        "l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    )
    expected = hot.where(F.col("l_suppkey") == -1).count()
    assert expected > n // 4
    top = top_k(exact_counts(hot, ["l_suppkey"], "n"), "n", ["l_suppkey"], 5).collect()
    assert top[0]["l_suppkey"] == -1 and top[0]["n"] == expected
    q = GroupCountQuery(name="hot", keys=("l_suppkey",), top=5)
    sample = sample_bottom_k(hot, 1000, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"])
    row = comparison(q, hot, sample, SketchParams(eps=0.01)).collect()[0]
    assert row["exact_trip_count"] == expected
    assert row["cms_estimated_count"] >= expected
    assert abs(row["sampled_trip_count"] - expected) < 0.2 * expected


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 40)), min_size=1, max_size=300), st.integers(1, 3))
def test_sketch_guarantees_random_input(spark, keys, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    params = SketchParams(eps=0.2, confidence=0.9, seed=seed)  # width 10: collisions certain
    cells = cms_cells(df, ["k"], params)
    sums = {r["d"]: r["s"] for r in cells.groupBy("d").agg(F.sum("c").alias("s")).collect()}
    assert set(sums) == set(range(params.depth)) and all(v == len(keys) for v in sums.values())
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for r in cms_estimate(counts, ["k"], cells, params).collect():
        assert r["cms_estimated_count"] >= r["n"]


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 60), st.integers(1, 4))
def test_sample_size_random(spark, k, parts):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(50)
    s = sample_bottom_k(ev.repartition(parts), k, ["event_id"])
    assert s.rows.count() == min(k, 50) == s.size
