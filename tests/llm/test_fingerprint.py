import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstats.llm import fingerprint as G
from tripstats.llm import text as T

from .brute import id_order


def state(texts):
    return G.states(*T.string_buffer(pa.array(texts, pa.string())))


def edited_rows(rows):
    order = id_order([(r[0], r[1] or "") for r in rows])
    out = []
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        k = len(t) // 4
        out.append((d, t, t[: len(t) - k] + following[:k], following))
    return out


def check(found, rows):
    expected = edited_rows(rows)
    prints = G.hex_lanes(state([t for _, t, _, _ in expected])[0])
    edited = G.hex_lanes(state([e for _, _, e, _ in expected])[0])
    want = sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest(), p, q) for (d, t, e, _), p, q in zip(expected, prints, edited))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in found) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_edge_rows(edge_docs, edge_rows):
    check(G.edit_fingerprints(edge_docs, rows_per_bucket=5).collect(), edge_rows)


def test_small_documents(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    found = G.edit_fingerprints(small_docs, rows_per_bucket=7).collect()
    check(found, rows)
    long = [r for r in found if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > 0.65 and np.mean([r.near_next for r in long]) < 0.15


def test_one_and_no_document(spark, empty_docs):
    assert G.edit_fingerprints(empty_docs).count() == 0
    one = spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")
    check(G.edit_fingerprints(one).collect(), [(4, "abcd efgh")])


def test_fingerprints_keep_all_columns(edge_docs, edge_rows):
    found = G.fingerprints(edge_docs)
    assert found.columns == [*edge_docs.columns, "fingerprint", "identity", "likeness"]
    by_text = {}
    for r in found.collect():
        by_text.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values())
    assert len(set.union(*by_text.values())) == len(by_text)  # no two of these texts have the same paragraphs


paragraphs = st.lists(st.text(alphabet="ab cé", max_size=12), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(paragraphs, paragraphs, st.randoms())
def test_homomorphism(a, b, random):
    mixed = [*a, *b]
    random.shuffle(mixed)
    whole, x, y = (state(["\n".join(p)]) for p in (mixed, a, b))
    added = G.add(x, y)
    assert (added[0] == whole[0]).all() and (added[1] == whole[1]).all()
    taken = G.subtract(whole, y)
    assert (taken[0] == x[0]).all() and (taken[1] == x[1]).all()
    assert (sorted(a) == sorted(b)) == bool((x[0] == y[0]).all())


def test_likeness_follows_shared_paragraphs():
    rng = np.random.default_rng(3)
    lines = [" ".join(f"w{rng.integers(1000)}" for _ in range(20)) for _ in range(80)]
    base, half, none = "\n".join(lines[:40]), "\n".join(lines[20:60]), "\n".join(lines[40:])
    s = state([base, half, none])
    pick = lambda i: (s[0][[i]], s[1][[i]])
    assert abs(G.likeness(pick(0), pick(1))[0] - 0.5) < 0.12
    assert G.likeness(pick(0), pick(2))[0] < 0.12
    assert G.likeness(pick(0), pick(0))[0] == 1.0


def test_buckets(spark):
    from pyspark.sql import functions as F

    for cuts in ([], [5], [2, 3, 7, 8, 9, 20, 21, 50, 51, 52, 60]):
        bucket, begins = G._bucket_of(F.col("k"), cuts)
        rows = spark.createDataFrame([(k,) for k in [None, *range(-2, 65)]], "k long").select("k", bucket.alias("b"), begins.alias("s")).collect()
        for r in rows:
            assert r.b == (0 if r.k is None else sum(c <= r.k for c in cuts)) and r.s == (r.k in cuts)
