"""Misra-Gries summaries: bounds, merging, proof of the top k."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripstats.operators import heavy_hitters as H
from tripstats.operators.compare import GroupCountQuery
from tripstats.operators.sample import sample_states
from tripstats.operators.stratified import stratified_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """Zipf-like keys: a few heavy ones, thousands of light ones; nulls and -0.0 among them."""
    rng = random.Random(5)
    keys = [min(int(rng.paretovariate(0.7)), 10**6) for _ in range(40_000)]
    data = [(None if k % 11 == 3 else f"k{k}", -0.0 if k % 2 else 0.0, k) for k in keys]
    df = spark.createDataFrame(data, "a string, b double, k int").repartition(8)
    return df, Counter((a, 0.0) for a, _, _ in data), Counter(k for _, _, k in data)


def test_bounds_hold_for_every_key(spark, skewed):
    df, two, one = skewed
    for keys, true, capacity in ((["k"], {(k,): n for k, n in one.items()}, 40), (["a", "b"], two, 25)):
        summary = H.merged(H.summaries(df, keys, capacity), keys)
        assert summary.mass == 40_000
        assert 0 < summary.slack <= summary.mass // (capacity + 1)
        held = {tuple(r[k] for k in keys): r[H.COUNTER] for r in summary.counters.collect()}
        assert len(held) <= 8 * capacity
        for key, n in true.items():
            assert held.get(key, 0) <= n <= held.get(key, 0) + summary.slack


def test_top_k_is_exact_and_proven(spark, skewed):
    df, _, one = skewed
    want = sorted(one.items(), key=lambda x: (-x[1], x[0]))
    for k, capacity in ((1, 20), (5, 60), (20, 300), (20, 10_000)):
        got = H.top_k_by_summary(df, ["k"], k, "n", capacity).collect()
        assert sorted(((r.k, r.n) for r in got), key=lambda x: (-x[1], x[0])) == want[:k]
        assert all(r.lower_bound <= r.n <= r.upper_bound for r in got)
    # more groups asked for than there are
    few = df.where("k < 4")
    got = H.top_k_by_summary(few, ["k"], 50, "n", 2).collect()
    assert sorted((r.k, r.n) for r in got) == sorted((k, n) for k, n in one.items() if k < 4)


def test_even_table_is_counted_in_full(spark):
    df = spark.range(5_000).select((F.col("id") % 2500).alias("k")).repartition(4)
    got = H.top_k_by_summary(df, ["k"], 3, "n", 10).collect()
    assert sorted((r.k, r.n) for r in got) == [(0, 2), (1, 2), (2, 2)]


def test_only_candidates_are_exchanged(spark, skewed):
    """Tasks send their counters, not all groups: far fewer rows than groups."""
    df, _, one = skewed
    parts = H.summaries(df, ["k"], 30)
    assert parts.count() <= 8 * 31 < len(one)


def test_guarantees_are_true(spark, skewed):
    df, _, one = skewed
    summary = H.merged(H.summaries(df, ["k"], 100), ["k"])
    top = H.bounded_top_k(summary, ["k"], 10).collect()
    true = {k for k, _ in sorted(one.items(), key=lambda x: -x[1])[:10]}
    assert any(r.guaranteed for r in top) and all(r.k in true for r in top if r.guaranteed)


def test_groups_weights_and_empty(spark, skewed):
    df, _, one = skewed
    by = df.withColumn("g", F.when(F.col("k") > 2, F.col("k") % 3)).withColumn("w", F.lit(2))
    parts = H.added_up(H.summaries(by, ["k"], 50, weight="w", group_cols=["g"]), ["k"], ["g"])
    sizes = {r.g: r.m for r in parts.groupBy("g").agg(F.sum(H.MASS).alias("m")).collect()}
    want = Counter()
    for k, n in one.items():
        want[k % 3 if k > 2 else None] += 2 * n
    assert sizes == dict(want)
    merged = H.merged(parts.drop("g"), ["k"])
    held = {r.k: r[H.COUNTER] for r in merged.counters.collect()}
    assert merged.mass == 80_000 and all(held.get(k, 0) <= 2 * n <= held.get(k, 0) + merged.slack for k, n in one.items())
    none = df.limit(0)
    assert H.top_k_by_summary(none, ["k"], 5).count() == 0
    with pytest.raises(ValueError):
        H.summaries(df, ["k"], 0)


def test_stratified_intervals_cover(spark, skewed):
    """95 % intervals over many groups and seeds: near that share of true counts inside; a full sample is exact."""
    df, _, one = skewed
    table = df.select(F.monotonically_increasing_id().alias("i"), (F.col("k") % 6).alias("s"), F.least("k", F.lit(6)).alias("key")).cache()
    query = GroupCountQuery(name="t", keys=("key",))
    true = {r["key"]: r["count"] for r in table.groupBy("key").count().collect()}
    inside = total = 0
    for seed in range(6):
        states = sample_states(table, 300, ["s"], seed)
        for r in stratified_counts(states, query, ["s"]).collect():
            total += 1
            inside += r.lower_bound <= true[r["key"]] <= r.upper_bound
    assert total >= 36 and inside >= 0.85 * total
    whole = stratified_counts(sample_states(table, 10**6, ["s"], 1), query, ["s"]).collect()
    assert {r["key"]: r.estimated_count for r in whole} == true and all(r.std_error == 0 for r in whole)
    assert all(r.lower_bound == r.upper_bound == r.estimated_count for r in whole)
    table.unpersist()
