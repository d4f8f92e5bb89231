import math
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstats.llm import lattice as L
from tripstats.llm.queries import vocabulary
from tripstats.llm.toxicity import held_out_fold

from .brute import LOWER, words


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces.of(vocabulary("piece_bpe_32k.model"))


def brute_word(word, table):
    """Probability of a word: the sum over every way to cut it."""
    data = b" " + word

    @cache
    def rest(i):
        if i == len(data):
            return 1.0
        return sum(table.get(data[i:j], 0.0) * rest(j) for j in range(i + 1, len(data) + 1))

    return rest(0)


def test_forward_is_the_sum_over_segmentations(pieces):
    table = dict(zip(pieces.bytes_of, np.exp(pieces.start)))
    sample = ["the", "a", "sttible", "élève", "中文", "x" * 30, "don't", "1234", "&&&", "z"]
    got = L.word_log_p([w.encode() for w in sample], pieces, pieces.start[None])[:, 0]
    assert got == pytest.approx([math.log(brute_word(w.encode(), table)) for w in sample], rel=1e-9)


def test_expected_counts_are_the_gradient_of_the_likelihood(pieces):
    found = [w.encode() for w in ("the", "thenthe", "tion")]
    times = np.array([3.0, 1.0, 2.0])
    total = np.zeros(len(pieces.start))
    for rows, matrix in L._matrices(found):
        total += L.expected_counts(pieces.arcs(matrix), pieces.start, times[rows])[0]
    value = lambda p: float(times @ L.word_log_p(found, pieces, p[None])[:, 0])
    for i in np.flatnonzero(total)[:8]:
        step = pieces.start.copy()
        step[i] += 1e-5
        assert (value(step) - value(pieces.start)) / 1e-5 == pytest.approx(total[i], rel=1e-3, abs=1e-6)


def test_plain_products_are_the_log_recursion(pieces, monkeypatch):
    found = [w.encode() for w in ("the", "thenthe", "tion", "élève", "internationalisation")]
    times, own = np.array([[3.0], [1.0], [2.0], [1.0], [5.0]]), pieces.start[None]
    plain = L.word_counts(found, times, pieces, own)
    monkeypatch.setattr(L, "LOWEST", 0.0)
    logs = L.word_counts(found, times, pieces, own)
    assert np.allclose(plain[0], logs[0], rtol=1e-10, atol=0) and plain[1] == pytest.approx(logs[1], rel=1e-12)


def base_rows(rows, held):
    tokens = [[*(w.translate(LOWER) for w in words(t)), None] for _, t in rows]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(len(t), sum(w in c for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for t in tokens]


def held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def check(docs, rows):
    found = L.score_texts(docs, held_out_fold(F.col("doc_id"), 7, 2), vocabulary("piece_bpe_32k.model")).collect()
    assert len(found) == len(rows)
    held = [held_out(d) for d, _ in rows]
    want = sorted(zip([str(d) for d, _ in rows], held, base_rows(rows, held)), key=str)
    got = sorted([(str(r.doc_id), r.held_out, (r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in found], key=str)
    for (d, h, (n, k, total, base)), (d2, h2, (n2, k2, total2, base2)) in zip(sorted(want, key=lambda x: (x[0], x[2][0])), sorted(got, key=lambda x: (x[0], x[2][0]))):
        assert (d, h, n, k, total) == (d2, h2, n2, k2, total2)
        assert base2 == pytest.approx(base, rel=1e-9)
    assert all(r.score < 0 for r in found)
    return found


def test_edges(edge_docs, edge_rows, empty_docs):
    found = check(edge_docs, [r[:2] for r in edge_rows])
    same = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(same) == 1
    assert len({round(r.score, 6) for r in found if r.doc_id in (6, 7)}) == 1  # equal texts
    nothing = L.score_texts(empty_docs, held_out_fold(F.col("doc_id"), 7, 2), vocabulary("piece_bpe_32k.model"))
    assert nothing.count() == 0


def test_language_is_no_input_of_a_score(small_docs):
    rows = small_docs.limit(20).collect()
    twice = [(r.doc_id * 7, r.text, r.lang) for r in rows] + [(r.doc_id * 7 + 1, r.text, "zz") for r in rows]
    docs = small_docs.sparkSession.createDataFrame(twice, "doc_id long, text string, lang string")
    found = {r.doc_id: r.score for r in L.score_texts(docs, F.lit(False), vocabulary("piece_bpe_32k.model")).collect()}
    assert all(found[r.doc_id * 7] == pytest.approx(found[r.doc_id * 7 + 1], rel=1e-9) for r in rows)


def test_training_helps_on_held_out_texts(spark):
    """More EM steps, and languages of their own, give held-out texts a higher probability."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = held_out_fold(F.col("doc_id"), 7, 2)
    total = {}
    for name, frame, steps in (("start", docs, 0), ("one", docs.withColumn("lang", F.lit("x")), 2), ("all", docs, 2)):
        total[name] = L.score_texts(frame, held, vocabulary("piece_bpe_32k.model"), steps).where("held_out").agg(F.sum("score")).first()[0]
    assert total["start"] < total["one"] < total["all"] < 0


def test_small_documents(small_docs, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 50_000)
    check(small_docs, [(r.doc_id, r.text) for r in small_docs.collect()])


def test_nothing_to_learn_from(edge_docs, edge_rows):
    found = L.score_texts(edge_docs, F.lit(True), vocabulary("piece_bpe_32k.model")).collect()
    assert len(found) == len(edge_rows)
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) and np.isfinite(r.base_score) for r in found)


@pytest.mark.parametrize("word", [b"a" * 500, bytes(97 + i * i % 26 for i in range(333)), "中文字符".encode() * 30, b"x" * 96, b"y" * 31, b"z" * 95 + b"q"])
def test_blocks_of_a_long_word_are_the_plain_recursion(pieces, monkeypatch, word):
    from tripstats.llm import longwords as W

    want = L.word_counts([word], np.array([[2.0, 1.0]]), pieces, np.stack([pieces.start, pieces.start]))
    monkeypatch.setattr(W, "STEPS", 32)
    monkeypatch.setattr(W, "SIDE", 3)
    monkeypatch.setattr(L, "LONG", 10)
    got = L.word_counts([word], np.array([[2.0, 1.0]]), pieces, np.stack([pieces.start, pieces.start]))
    assert got[1] == pytest.approx(want[1], rel=1e-12) and np.allclose(got[0], want[0], rtol=1e-8, atol=1e-10)
    assert L.word_log_p([word], pieces, pieces.start[None])[0, 0] * 3 == pytest.approx(want[1], rel=1e-12)


def test_a_megabyte_without_spaces(pieces):
    import resource
    import time

    rng = np.random.default_rng(2)
    before, begin = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    lp = L.word_log_p([(rng.integers(97, 123, 1_000_000).astype(np.uint8)).tobytes()], pieces, pieces.start[None])
    assert np.isfinite(lp).all() and lp[0, 0] < -1e6
    assert time.perf_counter() - begin < 30
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200 << 10  # kB


def plain_model(rows, held, pieces, min_share):
    """The mixture by plain loops: EM with expected counts of every piece, then log10 probabilities of all texts."""
    texts = [[w.translate(LOWER).encode() for w in words(t)] for _, t, _ in rows]
    langs = Counter(lang for (_, _, lang), h in zip(rows, held) if not h)
    total = sum(langs.values())
    own = sorted((x for x in langs if x is not None and langs[x] >= min_share * total), key=lambda x: (-langs[x], x))
    groups = [[i for i, (r, h) in enumerate(zip(rows, held)) if not h and r[2] == x] for x in own]
    rest = [i for i, (r, h) in enumerate(zip(rows, held)) if not h and r[2] not in own]
    groups += [rest] if rest or not groups else []

    def lattice(word, table):
        data = b" " + word
        alpha, beta = [1.0] + [0.0] * len(data), [0.0] * len(data) + [1.0]
        arcs = [(i, j, data[i:j]) for i in range(len(data)) for j in range(i + 1, min(i + pieces.longest, len(data)) + 1) if data[i:j] in table]
        for i, j, p in sorted(arcs):
            alpha[j] += alpha[i] * table[p]
        for i, j, p in sorted(arcs, reverse=True):
            beta[i] += beta[j] * table[p]
        return alpha, beta, arcs

    tables = [dict(zip(pieces.bytes_of, np.exp(pieces.start))) for _ in groups]
    counted = [Counter(w for i in g for w in texts[i]) for g in groups]
    before = -math.inf
    while True:
        likelihood, found = 0.0, []
        for table, words_in in zip(tables, counted):
            e = Counter()
            for w, n in words_in.items():
                alpha, beta, arcs = lattice(w, table)
                likelihood += n * math.log(alpha[-1])
                for i, j, p in arcs:
                    e[p] += n * alpha[i] * table[p] * beta[j] / alpha[-1]
            found.append(e)
        totals = [sum(e.values()) + 1e-3 * len(pieces.bytes_of) for e in found]
        tables = [{p: (e[p] + 1e-3) / t for p in pieces.bytes_of} for e, t in zip(found, totals)]
        if likelihood - before <= L.SETTLED * abs(likelihood):
            break
        before = likelihood
    out = []
    sizes = [len(g) + 0.5 for g in groups]
    for text in texts:
        parts = []
        for table, g, t, size in zip(tables, groups, totals, sizes):
            end = (len(g) + 1e-3) / (t + len(g) + 2e-3)
            # The end takes its share from every piece.
            own_table = {p: v * (1 - end) for p, v in table.items()}
            lp = sum(math.log(lattice(w, own_table)[0][-1]) for w in text)
            parts.append(math.log(size / sum(sizes)) + math.log(end) + lp)
        top = max(parts)
        out.append((top + math.log(sum(math.exp(x - top) for x in parts))) / math.log(10))
    return out


def test_score_is_the_plain_mixture(spark, pieces, monkeypatch):
    rng = np.random.default_rng(4)
    pool = {"en": "the cat and then a thing".split(), "de": "die katze und das ding".split(), "xx": "lorem ipsum".split(), None: ["zzz"]}
    langs = ["en"] * 30 + ["de"] * 20 + ["xx"] * 2 + [None] * 2
    rows = [(i, " ".join(rng.choice(pool[x], 6)) + (" Spam" * (i % 3)), x) for i, x in enumerate(langs)] + [(99, None, "en"), (98, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    held = [held_out(d) for d, _, _ in rows]
    monkeypatch.setattr(L, "MIN_SHARE", 0.1)
    monkeypatch.setattr(L.language_groups, "__defaults__", (0.1,))
    want = dict(zip([r[0] for r in rows], plain_model(rows, held, pieces, 0.1)))
    got = {r.doc_id: r.score for r in L.score_texts(docs, held_out_fold(F.col("doc_id"), 7, 2), vocabulary("piece_bpe_32k.model")).collect()}
    assert got.keys() == want.keys()
    assert all(got[d] == pytest.approx(want[d], rel=1e-5) for d in want)  # words' logarithms are 32-bit floats


def test_repeated_rows_are_scored_once(spark):
    """A third of the rows is one row: its block holds it once, all its rows get the score."""
    rows = [(5, "same words here", "en")] * 200 + [(5, "other text", "en")] + [(None, "no id", None)] * 30 + [(1000 + i, f"word{i} here", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    keyed = docs.select(F.coalesce("doc_id", F.lit(L.NULL_ID)).alias("id"), "text", F.lit(True).alias("learn"))
    kinds, repeated = L._kinds(keyed)
    assert repeated and kinds.count() == 400 + 2 + 1
    found = L.score_texts(docs, F.lit(False), vocabulary("piece_bpe_32k.model")).collect()
    assert len(found) == len(rows) and Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert len({r.score for r in found if r.doc_id == 5}) == 2 and len({r.score for r in found if r.doc_id is None}) == 1
    assert {r.train_tokens for r in found} == {sum(len(t.split()) + 1 for _, t, _ in rows)}
