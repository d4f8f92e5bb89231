import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstats.llm import packing as K
from tripstats.llm import text as T
from tripstats.llm.queries import vocabulary
from tripstats.llm.shared import stored


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


def check(found, rows, tokenizer, max_tokens):
    """Every id in one piece, right checksums, sequences without gaps or overlaps."""
    texts = defaultdict(list)
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        texts[d].append(ids)
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for d, own in pieces.items():
        covered = defaultdict(int)
        for r in own:
            match = [x for x in texts[d] if len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32]
            assert match
            covered[r.doc_tokens] += r.length
        for n, total in covered.items():
            assert total == n * sum(len(x) == n for x in texts[d])
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= max_tokens
    used = [sum(n for _, n in p) for p in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else max_tokens - n for n in used)
    return padding / (padding + sum(used))


def test_edge_rows(edge_docs, edge_rows, tokenizer):
    found = K.pack(edge_docs, vocabulary("word_bpe_49k.json")).collect()
    assert check(found, [r[:2] for r in edge_rows], tokenizer, 4096) <= 0.01


def test_small_sequences(small_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    found = K.pack(small_docs, vocabulary("word_bpe_49k.json"), max_tokens=256, max_gap=2).collect()
    assert check(found, rows, tokenizer, 256) <= 0.01


def test_empty_table(empty_docs):
    assert K.pack(empty_docs, vocabulary("word_bpe_49k.json")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 50), max_size=12))
def test_patterns_use_every_length_once(histogram):
    patterns = K.shortest_pack_first(histogram, 64)
    used = defaultdict(int)
    for p in patterns:
        assert p.count > 0 and p.used <= 64
        for length, many in p.runs:
            used[length] += many * p.count
    assert dict(used) == {n: c for n, c in histogram.items() if c}


def test_shortest_pack_first_places_longest_first():
    assert [(p.count, p.runs) for p in K.shortest_pack_first({6: 2, 4: 3, 2: 1}, 10)] == [(2, [(6, 1), (4, 1)]), (1, [(4, 1), (2, 1)])]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 32), st.integers(1, 30), max_size=8))
def test_layout_gives_every_rank_one_place(histogram):
    plan = K.layout(histogram, 32, 1)
    held = defaultdict(list)
    for length, count in histogram.items():
        for rank in range(count if length else 0):
            at = np.searchsorted(plan.key, length << 44 | rank, side="right") - 1
            local = rank - (plan.key[at] & ((1 << 44) - 1))
            pack, slot = divmod(int(local), int(plan.per_pack[at]))
            where = int(plan.offset[at]) + slot * length
            if plan.dissolved[at]:
                held["stream"].append((int(plan.base[at]) + pack * int(plan.step[at]) + where, length))
            else:
                held[int(plan.base[at]) + pack].append((where, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert sum(n for _, n in held["stream"]) == plan.stream == plan.stream_cuts[-1]


def test_words_give_the_ids_of_whole_texts(tokenizer):
    from tripstats.llm import text as T
    import pyarrow as pa

    rng = random.Random(5)
    alphabet = "abcXYZ  \n\t'sé̈ß  ﬁΣς1234.,!#\U0001f600\x85中"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    encoder = K.WordTokenizer(vocabulary("word_bpe_49k.json"))
    ids, first = encoder.encode(*T.string_buffer(pa.array(texts)), 2)
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_sequences_hold_the_ids_of_their_pieces(edge_docs, small_docs, tokenizer):
    path = vocabulary("word_bpe_49k.json")
    for docs in (edge_docs, small_docs):
        pieces = stored(K.pack(docs, path, max_tokens=512), "test-pieces")
        found = {r.sequence_id: r.ids for r in K.sequences(docs, pieces, path).collect()}
        texts = {(r.doc_id, r.text_key): r.text for r in K._keyed(docs).collect()}
        ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for k, t in texts.items()}
        want = {}
        for r in pieces.orderBy("sequence_id", "offset").collect():
            want.setdefault(r.sequence_id, []).extend(ids[r.doc_id, r.text_key][r.start : r.start + r.length])
        assert found == want


def test_learning_words_takes_memory_by_blocks():
    """New words are encoded a block at a time: beside the arrays that stay, no list of all their ids is held."""
    import tracemalloc

    encoder = K.WordTokenizer(vocabulary("word_bpe_49k.json"))
    words = [f"{i * 7919 % 1000003:06d}{'xyz'[i % 3]}q" for i in range(40_000)]
    raw, offsets = T.string_buffer(pa.array([" ".join(words)]))
    encoder.encode(raw[:100], np.array([0, 100]), 2)
    encoder.clear()
    tracemalloc.start()
    ids, first = encoder.encode(raw, offsets, 2)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tolist() == [*encoder.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, 2]
    print("peak", held, flush=True)
    assert held < 17 << 20
