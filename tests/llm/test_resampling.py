import hashlib
import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstats.llm import resampling as R

from .brute import LOWER
from .conftest import document

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def by_hand(rows, target, how):
    """[(doc_id, n_features, weight, score)] in the order of rows, and the ranks' multiset."""
    bucket = lambda f: zlib.crc32(f.encode()) % how.buckets
    split = [(d, *features(t)) for d, t in rows]
    s, t = Counter(bucket(f) for _, _, fs in split for f in fs), Counter(bucket(f) for x in target for f in features(x)[1])
    ss, tt, b = sum(s.values()), sum(t.values()), how.buckets
    gain = {k: math.floor(1000 * math.log((t[k] + 1.0) * (ss + b) / ((s[k] + 1.0) * (tt + b)))) for k in range(b)}
    out, eligible = [], []
    for d, n, fs in split:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(fs), weight, score))
        if n >= how.min_words:
            eligible.append((-score, d is not None, d or 0, len(out) - 1))
    eligible.sort()
    ranks = [None] * len(out)
    for r, (*_, i) in enumerate(eligible[: how.percent * len(eligible) // 100], 1):
        ranks[i] = r
    return [(*row, rank) for row, rank in zip(out, ranks)]


def shown(rows):
    return sorted(map(str, rows))


def drawn(docs, target, how):
    return [tuple(r) for r in R.draws(docs, target, how).select("doc_id", "n_features", "weight", "score", "rank").collect()]


@pytest.mark.parametrize(
    "how",
    [
        R.Resampling(),
        R.Resampling(percent=60, min_words=0),
        R.Resampling(percent=100),
        R.Resampling(percent=0),
        R.Resampling(buckets=7, percent=50, seed=3),
        R.Resampling(percent=40, sketch_k=8, margin=1e-9),  # the bracket must widen
    ],
)
def test_matches_brute_force(spark, edge_rows, edge_docs, how):
    target = ["a0 b1 c2 d3", None, "", "Spam spam SPAM", "é ü ö"] * 3
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert shown(drawn(edge_docs, frame, how)) == shown(by_hand([(r[0], r[1]) for r in edge_rows], target, how))


def test_matches_sql(spark, small_docs):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert shown(drawn(small_docs, bench, R.Resampling())) == shown(con.execute(R.DRAW_SQL).fetchall())


def test_ties_and_repeated_rows(spark):
    """One row a third of all, the same doc_id each time: the draw still has floor(p N / 100) rows, ranks have no gap."""
    rows = [(5, "same words here " * 10)] * 300 + [(None, "no id at all " * 10)] * 60 + [(i, f"word{i} other text " * 10) for i in range(600)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([("same words here",)], "text string")
    for how in (R.Resampling(percent=20), R.Resampling(percent=31, margin=1e-9, sketch_k=8), R.Resampling(percent=77)):
        got = drawn(docs, target, how)
        want = by_hand(rows, ["same words here"], how)
        assert shown(got) == shown(want)
        assert sorted(r[4] for r in got if r[4]) == list(range(1, how.percent * 960 // 100 + 1))


def test_empty_tables(spark, empty_docs, edge_docs, edge_rows):
    none = spark.createDataFrame([], "text string")
    assert R.draws(empty_docs, none).count() == 0
    how = R.Resampling(percent=50)
    assert shown(drawn(edge_docs, none, how)) == shown(by_hand([(r[0], r[1]) for r in edge_rows], [], how))


def test_crc32_spans():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 60_000).astype(np.uint8)
    cuts = np.sort(rng.choice(60_000, 900, replace=False))
    starts, ends = cuts[:-1], cuts[1:] - (rng.integers(0, 2, 899) * (np.diff(cuts) > 1))
    assert (ends - starts).max() > R.LONG_SPAN
    want = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert R.crc32_spans(raw, starts, ends).tolist() == want
    before = rng.integers(0, 2**32, 899, dtype=np.uint32)
    assert R.crc32_spans(raw, starts, ends, before).tolist() == [zlib.crc32(raw[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]
    none = np.zeros(0, np.int64)
    assert R.crc32_spans(raw, none, none).tolist() == []
    assert R.crc32_spans(raw, np.array([3]), np.array([3])).tolist() == [0]


def test_long_word_and_separators():
    text = "A" * 5000 + " b-b\x80cé \U0001f600 9z"
    raw = np.frombuffer(text.encode(), np.uint8)
    found, _, first = R.feature_buckets(raw, np.array([0, len(raw)]), 10_000)
    n, fs = features(text)
    assert first[-1] == n and Counter(found.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in fs)


def test_bracket_proves_the_cutoff(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % 500).alias("score"), F.monotonically_increasing_id().alias("row_no"))
    rows = rows.repartition(5)
    order = sorted(((i * 7919 % 500, i) for i in range(20_000)), key=lambda x: (-x[0], x[1]))
    how = R.Resampling()
    for k in (1, 2, 777, 5_000, 19_999, 20_000):
        low, high, above = R.bracket(rows, k, 20_000, how)
        inside = sum(low <= s <= high for s, _ in order)
        assert above < k <= above + inside and inside < 2_000
        cut = R.cutoff(rows, k, 20_000, how)
        assert (cut["score"], cut["doc_id"]) == order[k - 1]
        tight = replace(how, sketch_k=8, margin=1e-12)
        cut = R.cutoff(rows, k, 20_000, tight)
        assert (cut["score"], cut["doc_id"]) == order[k - 1]


def test_ranked_over_ranges(spark):
    rows = spark.range(5_000).select((F.col("id") * 31 % 97).alias("a"), "id").repartition(9)
    got = R.ranked(rows, [F.col("a").desc(), F.col("id").asc()], "ranked-test").collect()
    want = sorted(((i * 31 % 97, i) for i in range(5_000)), key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5_001))


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(*document(i, f"word{i} " * 30)[:2], i, "x", 1.5) for i in range(40)], "doc_id long, text string, score long, rank string, row_no double")
    bench = spark.createDataFrame([("word1", 3)], "text string, bucket long")
    assert R.draw(docs, bench).count() == 10
