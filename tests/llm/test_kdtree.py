import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tripstats.llm import kdtree as K
from tripstats.llm import queries

TREES = [
    K.KdTree(),
    K.KdTree(shards=1),
    K.KdTree(shards=7, dimensions=("source", "n_chars")),
]


def in_sql(docs, tree):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    return sorted(map(str, con.execute(K.kd_shards_sql(tree)).fetchall()))


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("tree", TREES)
def test_matches_sql(spark, edge_rows, small_docs, tree):
    rows = [(*r[:2], *r[2:5]) for r in edge_rows if len(r[1] or "") < 3000]  # SQL sums a CRC byte by byte
    edge = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    for docs in (edge, small_docs) if tree == K.KdTree() else (edge,):
        got = K.kd_shards(docs, tree).collect()
        assert sorted(map(str, map(tuple, got))) == in_sql(docs, tree)
        assert gapless(got)


def test_sizes_and_sums_of_whole_texts(edge_docs, edge_rows):
    got = sorted(str((r.doc_id, r.size, r.text_crc32)) for r in K.kd_shards(edge_docs).collect())
    want = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in edge_rows]
    assert got == sorted(map(str, want))


def test_bytes_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = K.kd_shards(docs).collect()
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    assert sorted(size) == list(range(16))
    longest = max(r.size for r in rows)
    mean = sum(size.values()) / 16
    assert all(abs(s - mean) <= longest for s in size.values())


def test_hot_value_and_repeated_rows_are_cut(spark):
    """A third of the rows is one row, another third has one source and length: shards stay even, order of files does not matter."""
    rows = [(1, "same text", "en", "hot", 9)] * 400 + [(i, f"text {i:04d}", "en", "hot", 9) for i in range(2, 402)]
    rows += [(i, "w" * (i % 37), "de", f"src{i % 7}", i % 37) for i in range(1000, 1400)] + [(None, None, None, None, None)] * 40
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).repartition(6)
    tree = K.KdTree(shards=8)
    got = K.kd_shards(docs, tree).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    mean = sum(size.values()) / 8
    assert len(size) == 8 and all(abs(s - mean) < 60 for s in size.values()) and gapless(got)
    random.Random(3).shuffle(rows)
    again = K.kd_shards(spark.createDataFrame(rows, schema).repartition(2), tree).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted(map(str, map(tuple, got))) == in_sql(docs, tree)


def test_copies_are_numbered_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK_BITS", 2)
    rows = spark.createDataFrame([(f"n{i % 5 if i < 60 else i}", i) for i in range(75)], "name string, row_no long").withColumn("x", K.F.col("name"))
    got = defaultdict(list)
    for r in K.numbered_copies(rows).collect():
        got[r.x].append(r["copy"])
    assert len(got) == 20 and all(sorted(v) == list(range(len(v))) for v in got.values())


def test_splits_the_widest_dimension(spark):
    """Two far lengths and one name: the first cut is by length."""
    rows = [(i, "x" * (4 if i < 50 else 4), "en", "s", 1 if i < 50 else 10_000) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = K.kd_shards(docs, K.KdTree(shards=2)).collect()
    assert {(r.doc_id < 50, r.shard) for r in got} == {(True, 0), (False, 1)}


def test_empty_few_and_extra_columns(spark, empty_docs, edge_docs):
    assert K.kd_shards(empty_docs).count() == 0
    one = spark.createDataFrame([(1, "a", 2.5, float("nan"), "z")], "doc_id long, text string, lang double, source double, tie string")
    r = K.kd_shards(one, K.KdTree(dimensions=("lang", "source"))).first()
    assert (r.size, r.slot, r.law, r.grown_shard) == (2, 0, "bytes", None)
    names = edge_docs.withColumnRenamed("block", "shard").withColumnRenamed("h1", "first").withColumnRenamed("h2", "n")
    assert K.kd_shards(names).count() == edge_docs.count()
    assert K.shards_for(100, 30) == 4 and K.shards_for(0, 30) == 1


def test_no_python_in_the_plan(spark):
    plan = queries.op12_kd_tree_shards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ScalaUDF"))
