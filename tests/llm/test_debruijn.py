import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstats.llm import debruijn as B

from . import brute
from .conftest import make_words


def check(docs, rows):
    found = B.removal_digests(docs).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute.repeats_removed(rows)))


def test_edges(edge_docs, edge_rows, empty_docs):
    check(edge_docs, [r[:2] for r in edge_rows])
    assert B.removal_digests(empty_docs).count() == 0 and B.remove_repeats(empty_docs).count() == 0


def test_small_documents(small_docs):
    check(small_docs, [(r.doc_id, r.text) for r in small_docs.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_passages_that_branch(spark, seed):
    """Overlapping passages in changing company, runs of one word, and repeats inside a document."""
    rng = np.random.default_rng(seed)
    pool = make_words(150, seed)
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.integers(1, 6)):
            a = rng.integers(0, 120)
            words += pool[a : a + rng.integers(5, 60)]
            if rng.random() < 0.3:
                words += [f"w{rng.integers(10**6)}"] * int(rng.integers(1, 30))
        rows.append((int(rng.integers(-5, 200)) if rng.random() < 0.95 else None, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_rows_of_one_id_with_different_texts(spark):
    words = make_words(60, 4)
    rows = [(1, " ".join(words)), (1, " ".join(words[10:])), (2, " ".join(words[5:45])), (2, " ".join(words[5:45]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_remove_repeats_keeps_columns(edge_docs, edge_rows):
    out = B.remove_repeats(edge_docs)
    assert out.columns == edge_docs.columns
    shas = sorted((str(r.doc_id), brute.sha(" ".join(brute.words(r.text)))) for r in out.collect())
    assert shas == sorted((str(d), s) for d, _, _, s in brute.repeats_removed([r[:2] for r in edge_rows]))


def test_spans(spark):
    words = make_words(80, 9)
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[20:60]) + " y")]
    found = B.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, [tuple(s) for s in r.spans]) for r in found] == [(2, [(1, 41)])]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 20))
def test_sliding_argmin(values, width):
    got = B._sliding_argmin(np.array(values, np.int64), width).tolist() if len(values) >= width else []
    assert got == [min(range(i, i + width), key=lambda j: (values[j], j)) for i in range(max(0, len(values) - width + 1))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 10)), min_size=1, max_size=10))
def test_merge(parts):
    start, end = (np.array(x, np.int64) for x in zip(*((a, a + n) for a, n in parts)))
    s, e = B.merge(start, end)
    covered = {i for a, n in parts for i in range(a, a + n)}
    assert {i for a, b in zip(s, e) for i in range(a, b)} == covered
    assert all(e[i] < s[i + 1] for i in range(len(s) - 1))


def test_repeated_rows_are_worked_on_once(spark):
    """One text under id 1 and 20,000 equal rows of id 9: the list of spans is that of one row, and all rows get it."""
    words = make_words(200, 11)
    text = " ".join(words)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").unionByName(
        spark.range(20_000).selectExpr("9L AS doc_id", f"'{text}' AS text").repartition(6)
    )
    rows, kinds, repeated = B._rows(docs)
    assert repeated and kinds.count() == 2
    spans = B._spans(kinds, repeated).collect()
    assert [(r.doc, r.copy != 0) for r in spans] == [(9, True)] and len(spans[0].parts) <= 200 - B.WINDOW + 1
    found = B.removal_digests(docs).groupBy("doc_id", "n_words", "n_removed", "kept_sha256").count().collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(1, 200, 0, brute.sha(text), 1), (9, 200, 200, brute.sha(""), 20_000)]))
    one = B.repeated_spans(docs).collect()
    assert [(r.doc_id, [tuple(s) for s in r.spans]) for r in one] == [(9, [(0, 200)])]
