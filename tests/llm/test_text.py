import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstats.llm import text as T

from . import brute

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab Aé\n\t\x0b\U0001f600", max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_lines_and_hashes(values):
    raw, offsets = T.string_buffer(pa.array(values, pa.string()))
    start, end, first = T.word_spans(raw, offsets)
    expected = [brute.words(v) for v in values]
    found = [bytes(raw[a:b]).decode() for a, b in zip(start, end)]
    assert found == [w for ws in expected for w in ws]
    assert np.diff(first).tolist() == [len(ws) for ws in expected]
    h = T.span_hashes(raw, start, end)
    for i, a in enumerate(found):
        for j, b in enumerate(found):
            assert (h[i] == h[j]) == (a == b)
    ls, le, lf = T.line_spans(raw, offsets)
    lines = [(v or "").split("\n") for v in values]
    assert [bytes(raw[a:b]).decode() for a, b in zip(ls, le)] == [x for y in lines for x in y]
    lh = T.span_hashes(raw, ls, le)
    flat = [x for y in lines for x in y]
    assert all((lh[i] == lh[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 4))
def test_windows(values, size):
    raw, offsets = T.string_buffer(pa.array(values, pa.string()))
    start, end, first = T.word_spans(raw, offsets)
    starts = T.window_starts(first, size)
    expected = [tuple(w[i : i + size]) for w in map(brute.words, values) for i in range(len(w) - size + 1)]
    hashes = T.window_hashes(T.span_hashes(raw, start, end), size)[starts] if len(starts) else np.zeros(0)
    assert len(hashes) == len(expected)
    for i, a in enumerate(expected):
        for j, b in enumerate(expected):
            assert (hashes[i] == hashes[j]) == (a == b)


def test_sliced_arrow_and_slices():
    column = pa.array(["x y", "é", None, "zz", "last one"]).slice(1, 3)
    raw, offsets = T.string_buffer(column)
    assert bytes(raw).decode() == "ézz" and offsets.tolist() == [0, 2, 2, 4]
    assert [list(r) for r in T.slices(np.array([0, 5, 6, 7, 20, 20]), 4)] == [[0, 1], [1, 3], [3, 4], [4, 5]]
    assert list(T.slices(np.array([0]), 4)) == []


def test_span_hash_does_not_depend_on_slices(monkeypatch):
    raw, offsets = T.string_buffer(pa.array(["some words of a text that is longer", "", "than a slice"]))
    start, end, _ = T.word_spans(raw, offsets)
    whole = T.span_hashes(raw, start, end)
    monkeypatch.setattr(T, "SLICE_BYTES", 3)
    assert (T.span_hashes(raw, start, end) == whole).all()


def test_freed_memory_goes_back_between_batches():
    import psutil
    import pytest

    if T._trim() is None:
        pytest.skip("another C library")
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["i"]) for i in range(3)]
    seen, held, pins = [], [], []
    me = psutil.Process()
    for batch in T.tidied(iter(batches)):
        if seen:
            held.append(me.memory_info().rss)
        seen.append(batch)
        small = []
        for _ in range(2500):  # below the size that malloc maps apart; what stays in between keeps the heap from shrinking by itself
            small.append(np.ones(60_000, np.uint8))
            pins.append(np.ones(3_000, np.uint8))
        full = me.memory_info().rss
        del small
    assert [b.column(0).to_pylist() for b in seen] == [[0], [1], [2]]
    assert full - me.memory_info().rss > 100 << 20
