import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tripstats.llm import quality as Q
from tripstats.llm import text as T

from . import brute


def counts_of(texts):
    f = Q.features(*T.string_buffer(pa.array(texts, pa.string())))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return [tuple(int(f[n][i]) for n in names) for i in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é#|\n\t ", max_size=60), min_size=1, max_size=5))
def test_counts_match_brute_force(texts):
    assert counts_of(texts) == [brute.quality_counts(t) for t in texts]


def test_judge_edges(edge_docs, edge_rows):
    found = Q.judge(edge_docs).collect()
    assert len(found) == len(edge_rows)
    want = sorted(map(str, ((r[0], *brute.quality_counts(r[1])) for r in edge_rows)))
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.p_good <= 1


def test_keep_good_agrees_with_judge_and_keeps_columns(edge_docs, small_docs, empty_docs):
    for docs in (edge_docs, small_docs):
        kept = Q.keep_good(docs)
        assert kept.schema == docs.schema
        judged = sorted(str(r.doc_id) for r in Q.judge(docs).where("kept").collect())
        assert sorted(str(r.doc_id) for r in kept.collect()) == judged
    assert Q.judge(empty_docs).count() == 0 and Q.keep_good(empty_docs).count() == 0


def test_em_finds_accuracies_and_classes():
    rng = np.random.default_rng(0)
    n, rules = 20_000, len(Q.RULES)
    bad = rng.random(n) < 0.2
    hit, wrong = rng.uniform(0.3, 0.9, rules), rng.uniform(0.01, 0.05, rules)
    said = rng.random((n, rules)) < np.where(bad[:, None], hit, wrong)
    v = np.where(rng.random((n, rules)) < 0.2, Q.ABSTAIN, np.where(said, Q.BAD, Q.GOOD))
    codes, counts = np.unique(Q.patterns(v), return_counts=True)
    model = Q.fit(codes, counts)
    assert abs(float(model["prior_bad"]) - 0.2) < 0.02
    assert np.abs(model["bad_if_bad"] - hit).max() < 0.06 and np.abs(model["bad_if_good"] - wrong).max() < 0.03
    p_bad = Q._posterior(codes, model)[np.searchsorted(codes, Q.patterns(v))]
    assert ((p_bad > 0.5) == bad).mean() > 0.97


def test_labelled_documents(spark):
    """On the labelled rows that pass the base rules, the verdict is the label, learned without it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.judge(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.98
    assert all(r.kept for r in rows if r.quality == 1)


def plain_em(histogram, steps=200):
    """The two-class model by loops over patterns and rules: {pattern: posterior of good}."""
    prior, bad, good = 0.1, [0.34] * len(Q.RULES), [0.02] * len(Q.RULES)
    shown = {code: [code // 3**i % 3 for i in range(len(Q.RULES))] for code in histogram}

    def p_bad(votes):
        a, b = prior, 1 - prior
        for v, x, y in zip(votes, bad, good):
            if v != Q.ABSTAIN:
                a, b = (a * x, b * y) if v == Q.BAD else (a * (1 - x), b * (1 - y))
        return a / (a + b)

    for _ in range(steps):
        p = {code: p_bad(v) for code, v in shown.items()}
        total = sum(histogram.values())
        new = (sum(n * p[c] for c, n in histogram.items()) + 0.2) / (total + 2)
        for i in range(len(Q.RULES)):
            for rates, weight, extra in ((bad, lambda c: p[c], 0.68), (good, lambda c: 1 - p[c], 0.04)):
                said = sum(n * weight(c) for c, n in histogram.items() if shown[c][i] != Q.ABSTAIN)
                voted = sum(n * weight(c) for c, n in histogram.items() if shown[c][i] == Q.BAD)
                rates[i] = min(max((voted + extra) / (said + 2), Q.RULE_ERROR), 1 - Q.RULE_ERROR)
        if abs(new - prior) < 1e-10:
            break
        prior = new
    return {code: 1 - p_bad(v) for code, v in shown.items()}


def test_posterior_is_the_plain_em(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = Q.features_frame(docs).where("n_words > 0").groupBy("pattern").count().collect()
    want = plain_em({r["pattern"]: r["count"] for r in rows})
    codes, good, _ = Q.fit_frame(Q.features_frame(docs))
    got = dict(zip(codes.tolist(), good.tolist()))
    assert len(want) > 10 and all(abs(got[c] - g) < 1e-9 for c, g in want.items())
    judged = Q.judge(docs).select("doc_id", "p_good", "kept", "base_failed").collect()
    pattern = {r.doc_id: r.pattern for r in Q.features_frame(docs).select("doc_id", "pattern").collect()}
    for r in judged:
        if pattern[r.doc_id] in want:
            assert abs(r.p_good - want[pattern[r.doc_id]]) < 1e-9
            assert r.kept == (not r.base_failed and r.p_good >= Q.KEEP_AT)
