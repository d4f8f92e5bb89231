"""Count-Min cell table: guarantees, merge, equivalent build paths."""

from pyspark.sql import functions as F

from tripstats.operators.compare import cms_side, exact_side
from tripstats.operators.sketch import (
    SketchParams,
    cms_cells,
    cms_cells_from_counts,
    cms_estimate,
    cms_merge,
    cms_native,
)
from tripstats.plans import carriers as C

from .conftest import SF_SMALL

P = SketchParams(eps=0.05, confidence=0.95, seed=1)


def _cells(df):
    return sorted(tuple(r) for r in df.select("d", "b", "c").collect())


def test_dimensions():
    assert (SketchParams().width, SketchParams().depth) == (20000, 5)
    assert (P.width, P.depth) == (40, 5)


def test_each_row_sums_to_n(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    per_row = cms_cells(li, ["l_suppkey"], P).groupBy("d").agg(F.sum("c").alias("s")).collect()
    assert len(per_row) == P.depth
    assert all(r["s"] == n for r in per_row)


def test_three_build_paths_same_cells(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    rows = _cells(cms_cells(li, ["l_partkey"], P))
    grouped = _cells(cms_cells(li, ["l_partkey"], P, pre_group=True))
    counts = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    from_counts = _cells(cms_cells_from_counts(counts, ["l_partkey"], "n", P))
    assert rows == grouped == from_counts


def test_estimate_never_below_exact(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    counts = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    est = cms_estimate(counts, ["l_partkey"], cms_cells(li, ["l_partkey"], P), P).collect()
    assert est and all(r["cms_estimated_count"] >= r["n"] for r in est)
    n = li.count()
    # error bound eps * N holds for most keys (confidence 0.95 per key)
    within = sum(r["cms_estimated_count"] - r["n"] <= P.eps * n for r in est)
    assert within >= 0.9 * len(est)


def test_unknown_key_estimates_zero_or_collisions(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    wide = SketchParams(eps=0.0001)
    cells = cms_cells(li, ["l_suppkey"], wide)
    probe = spark.createDataFrame([(10**12,)], "l_suppkey bigint")
    assert cms_estimate(probe, ["l_suppkey"], cells, wide).first()["cms_estimated_count"] == 0


def test_merge_of_months_equals_whole(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("y", F.year("l_shipdate"))
    years = [r[0] for r in li.select("y").distinct().collect()]
    parts = [cms_cells(li.where(F.col("y") == y), ["l_suppkey"], P) for y in years]
    assert _cells(cms_merge(*parts)) == _cells(cms_cells(li, ["l_suppkey"], P))


def test_null_and_composite_keys_stay_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("a", None)], "x string, y string")
    counts = df.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    wide = SketchParams(eps=0.001)
    est = cms_estimate(counts, ["x", "y"], cms_cells(df, ["x", "y"], wide), wide).collect()
    # ('a', null), (null, 'a') and ('a', '') are three keys, not one
    assert len(est) == 3
    assert all(r["cms_estimated_count"] == r["n"] for r in est)


def test_gold_modes_agree(spark):
    q = C.C1
    table = C.table_for(spark, SF_SMALL, "q1")
    a = sorted(tuple(r) for r in cms_side(q, table, P, mode="rows").collect())
    b = sorted(tuple(r) for r in cms_side(q, table, P, mode="grouped").collect())
    assert a == b
    assert len(a) == exact_side(q, table).count()


def test_xxhash_cells_keep_the_guarantees(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("k", F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")))
    p = SketchParams(eps=0.05, hash="xxhash64")
    counts = li.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    rows = _cells(cms_cells(li, ["k"], p))
    assert rows == _cells(cms_cells(li, ["k"], p, pre_group=True)) == _cells(cms_cells_from_counts(counts, ["k"], "n", p))
    est = cms_estimate(counts, ["k"], cms_cells(li, ["k"], p), p).collect()
    assert all(r["cms_estimated_count"] >= r["n"] for r in est)
    assert sum(r["cms_estimated_count"] - r["n"] <= p.eps * li.count() for r in est) >= 0.9 * len(est)


def test_sketch_plan_has_no_exact_group_count(spark):
    """The default sketch is built from rows: its only aggregate is over cells."""
    from tripstats.operators.compare import sketch_cells_for

    cells = sketch_cells_for(C.C1, C.table_for(spark, SF_SMALL, "q1"), P)
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_native_sketch_is_binary(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    row = cms_native(li, ["l_quantity"], P).first()
    assert isinstance(row["sketch"], (bytes, bytearray)) and len(row["sketch"]) > 0
    assert row["total_count"] == li.count()


def test_negative_zero_is_one_key(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (-0.0,), (1.5,)], "v double")
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    wide = SketchParams(eps=0.001)
    for cells in (cms_cells(df, ["v"], wide), cms_cells(df, ["v"], wide, pre_group=True),
                  cms_cells_from_counts(counts, ["v"], "n", wide)):
        est = {r["v"]: r["cms_estimated_count"] for r in cms_estimate(counts, ["v"], cells, wide).collect()}
        assert est[0.0] >= 3 and est[1.5] >= 1
