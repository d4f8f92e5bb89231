import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripstats.llm import queries
from tripstats.llm import text as T
from tripstats.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_documents(spark):
    found = queries.op5_toxicity_cnn(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in toxic]) > 0.9
    assert np.mean([r.predicted for r in clean]) < 0.03
    for r in found.limit(200).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_score_depends_on_the_text_alone(spark, small_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = X.held_out_fold(F.col("doc_id"), 4, 2)
    model = X.fit(small_docs, labels, held)
    a = {r.doc_id: r.score for r in X.score_frame(small_docs, model).collect()}
    other = small_docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("q").alias("source"))
    b = {r.doc_id - 1000: r.score for r in X.score_frame(other.repartition(5), model).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_edges(spark, edge_docs, edge_rows, empty_docs):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 24)] + [(None, 1, 1), (3, None, None), (4, 1, 1)], LABELS)
    found = X.toxicity(edge_docs, labels).collect()
    assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert not any(r.held_out for r in found if r.doc_id is None)
    no_labels = spark.createDataFrame([], LABELS)
    assert {r.score for r in X.toxicity(edge_docs, no_labels).collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 1, 0) for i in range(1, 20)], LABELS)
    assert all(r.score < 0.01 for r in X.toxicity(edge_docs, one_kind).collect())
    assert X.toxicity(empty_docs, labels).count() == 0


def test_best_threshold():
    assert X.best_threshold(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) == pytest.approx(0.55)
    assert X.best_threshold(np.array([0.5, 0.5, 0.1]), np.array([1, 0, 0])) == pytest.approx(0.3)


def test_words_lose_case_and_outer_punctuation():
    import pyarrow as pa

    from tripstats.llm import text as T

    ids, first = X.word_features(*T.string_buffer(pa.array(["Idiot!! (idiot) idiot \"IDIOT...", "", "..."])))
    assert (ids[:4] == ids[0]).all() and first.tolist() == [0, 4, 4, 5]


def _ids(*texts):
    import pyarrow as pa

    from tripstats.llm import text as T

    ids, first = X.word_features(*T.string_buffer(pa.array(texts)))
    return [[tuple(w) for w in ids[a:b].tolist()] for a, b in zip(first[:-1], first[1:])]


@pytest.mark.parametrize("text", ["absolute-idiot", "really,idiot", "see_this/idiot", "*" * 15 + "Idiot" + "!" * 9, "это—idiot", "«idiot»", "idiot　x", "你idiot好"])
def test_words_are_split_at_inner_punctuation(text):
    (idiot,), words = _ids("idiot", text)
    assert idiot in words


def test_whole_words_are_read():
    a, b, c, d = _ids("incomprehensible", "incomprehensibly", "программист", "программа")
    assert a != b and c != d
    assert a[0][1:] == b[0][1:]  # prefixes are further features


@pytest.mark.parametrize("text, inner", [("这个人真是一个大笨蛋而且他不知道", "笨蛋"), ("あの人はほんとうにばかだとおもう", "ばか"), ("เขาเป็นคนโง่มากที่สุด", "โง่")])
def test_runs_without_spaces_are_read_to_their_end(text, inner):
    (run,), (part,) = ([w] for w in _ids(text, inner))
    assert len(run) == len(text)
    assert part[0][: len(inner)] in {w[: len(inner)] for w in run}
    ends = _ids("好笨", "好", "笨")  # n-grams stay within a text
    assert ends[1][0][0] == ends[0][0][0] and ends[1][0] != ends[0][0] and ends[2][0] == ends[0][1]


@pytest.mark.parametrize("toxic", ["good-dolt", "wonderful_dolt", "!!!!!!!!!!!!!!!dolt", "incomprehensibilis", "прогнозист", "今天天气非常好大笨蛋而且我们走"])
def test_learns_toxic_words_wherever_they_stand(spark, toxic):
    clean = {"incomprehensibilis": "incomprehensible", "прогнозист": "прогноз"}.get(toxic, toxic.replace("dolt", "friend").replace("笨蛋", "朋友"))
    texts = [(i, f"some words {toxic if i % 2 else clean} and others", "en") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], LABELS)
    model = X.fit(docs, labels, X.held_out_fold(F.col("doc_id"), 4, 2))
    scores = [r.score for r in X.score_frame(docs.where("doc_id < 2").orderBy("doc_id"), model).collect()]
    assert scores[1] > 0.7 and scores[0] < 0.3


def tiny_corpus():
    texts = ["you are a bad bad idiot", "", "a nice day", "idiot", "the bad weather and the good one", "so nice", "one two three four", "bad idiot you"]
    raw, offsets = T.string_buffer(pa.array(texts))
    ids, first = X.word_features(raw, offsets)
    return ids, first, np.array([1, 0, 0, 1, 0, 0, 0, 1])


def plain_score(model, ids, first):
    """Convolution over embedded words, rectified max pooling and the logistic layer, by loops."""
    out = []
    for d in range(len(first) - 1):
        x = [model.embedding[row].astype(float).sum(axis=0) for row in ids[first[d] : first[d + 1]]]
        z = float(model.intercept)
        for i, weights in enumerate(model.filters):
            for f in range(X.FILTERS):
                k = i * X.FILTERS + f
                best = 0.0
                for at in range(len(x)):
                    inside = range(min(len(weights), len(x) - at))
                    best = max(best, model.bias[k] + sum(float(x[at + j] @ weights[j][:, f].astype(float)) for j in inside))
                z += best * model.top[k]
        out.append(1 / (1 + math.exp(-z)))
    return np.array(out)


def test_score_is_the_plain_network():
    ids, first, labels = tiny_corpus()
    for model in (X._start(ids, first, labels, np.random.default_rng(3)), X.train(ids, first, labels, epochs=3, batch=3)):
        assert np.allclose(X.score(model, ids, first), plain_score(model, ids, first), atol=1e-5)


def test_step_follows_the_numeric_gradient():
    """One Adagrad step from the start tells the gradient that was used; it is that of the mean logistic loss."""
    ids, first, labels = tiny_corpus()
    rate, memory = 0.05, 1e-3
    before = X._start(ids, first, labels, np.random.default_rng(X.SEED))
    after = X.train(ids, first, labels, epochs=1, batch=64, rate=rate)

    def loss(model):
        p = plain_score(model, ids, first)
        return -float(np.mean(np.where(labels == 1, np.log(p), np.log(1 - p))))

    def used(a, b):
        u = (np.asarray(a, float) - np.asarray(b, float)) / rate  # d / sqrt(memory + d * d)
        return u * math.sqrt(memory) / np.sqrt(np.maximum(1 - u * u, 1e-12))

    def check(array, place, got):
        old, h = array[place], 1e-3
        array[place] = old + h
        up = loss(before)
        array[place] = old - h
        down = loss(before)
        array[place] = old
        assert (up - down) / (2 * h) == pytest.approx(got, rel=0.05, abs=2e-4)

    for k in range(len(before.top)):
        check(before.top, k, used(before.top[k], after.top[k]))
        check(before.bias, k, used(before.bias[k], after.bias[k]))
    for i, w in enumerate(before.filters):
        for place in ((0, 0, 0), (len(w) - 1, 1, 1), (0, 2, 3)):
            check(w, place, used(w[place], after.filters[i][place]))
    for row in (ids[0, 0], ids[5, 0], ids[5, 2]):
        for dim in (0, 3):
            check(before.embedding, (row, dim), used(before.embedding[row, dim], after.embedding[row, dim]))


def test_learns_from_the_ends_of_long_texts(spark):
    filler = "plain words of a long text " * 8000
    texts = [(i, f"{filler} {'dolt' if i % 2 else 'friend'}", "en") for i in range(40)]
    assert all(len(t) > 200_000 for _, t, _ in texts)
    docs = spark.createDataFrame([*texts, (1001, "dolt", "en"), (1000, "friend", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], LABELS)
    model = X.fit(docs, labels, X.held_out_fold(F.col("doc_id"), 4, 2))
    scores = {r.doc_id: r.score for r in X.score_frame(docs.where("doc_id >= 1000"), model).collect()}
    assert scores[1001] > scores[1000] + 0.3


def many_rows(spark, n=6800):
    """More rows than a sample of 6000; a third word tells every label."""
    texts = [(i, f"words {'dolt' if i % 2 else 'friend'}{i % 40} others {i}", ("en", "de", None)[i % 3]) for i in range(n)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    return docs, spark.createDataFrame([(i, 1, i % 2) for i in range(n)], LABELS)


def test_every_labelled_row_counts(spark):
    docs, labels = many_rows(spark)
    held = X.held_out_fold(F.col("doc_id"), 4, 2)
    rows, in_shard, share = X.labelled_rows(docs, labels, held, shard_rows=1000)
    want = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    got = rows.collect()
    assert sorted((r.text, r.toxic) for r in got) == sorted((r.text, r.doc_id % 2) for r in want)
    assert in_shard <= 1000 and share == pytest.approx(np.mean([r.doc_id % 2 for r in want]))
    ids, first = X.word_features(*T.string_buffer(pa.array([r.text for r in got])))
    plain = np.zeros((2, X.FEATURES * X.BUCKETS), np.int64)
    for d, r in enumerate(got):
        plain[r.toxic, list(set(ids[first[d] : first[d + 1]].ravel().tolist()))] += 1
    assert (X._bucket_hits(rows) == plain).all()


def test_a_round_averages_the_passes_of_all_shards(spark):
    """Against the same passes made one after the other, for one shard and for several."""
    docs, labels = many_rows(spark, 400)
    for shard_rows in (1000, 100):
        rows, _, _ = X.labelled_rows(docs, labels, F.lit(False), shard_rows)
        rows = rows.persist()
        start = X._start_from(X._bucket_hits(rows), [200, 200], np.random.default_rng(1))
        shards = [p for p in rows.rdd.glom().collect() if p]
        assert sum(len(p) for p in shards) == 400 and (len(shards) > 1) == (shard_rows == 100)
        own = []
        for part in shards:
            model, memory = X.copy.deepcopy((start, X._memory_of(start)))
            ids, first = X.word_features(*T.string_buffer(pa.array([r.text for r in part])))
            keys = list(X._pass(model, memory, ids, first, np.array([r.toxic for r in part]), np.random.default_rng([X.SEED, 0]), X.BATCH, X.RATE))
            own.append((len(part), set(np.concatenate(keys).tolist()), model, memory))
        model, memory = X.copy.deepcopy(start), X._memory_of(start)
        X._round(rows, model, memory, 0)
        rows.unpersist()
        weights = [n for n, *_ in own]
        assert model.intercept == pytest.approx(np.average([m.intercept for _, _, m, _ in own], weights=weights), abs=1e-5)
        assert np.allclose(memory.top, np.average([m.top for *_, m in own], axis=0, weights=weights), atol=1e-5)
        for i in range(len(X.WIDTHS)):
            assert np.allclose(model.filters[i], np.average([m.filters[i] for _, _, m, _ in own], axis=0, weights=weights), atol=1e-5)
        changed = set().union(*(k for _, k, *_ in own))
        for key in sorted(changed)[::7]:
            mine = [(n, m.embedding[key]) for n, k, m, _ in own if key in k]
            assert np.allclose(model.embedding[key], np.average([e for _, e in mine], axis=0, weights=[n for n, _ in mine]), atol=1e-5)
        rest = np.ones(len(start.embedding), bool)
        rest[list(changed)] = False
        assert (model.embedding[rest] == start.embedding[rest]).all()


def test_thresholds_are_those_of_all_rows(spark):
    docs, labels = many_rows(spark, 900)
    labels = labels.withColumn("toxic", F.when(F.col("doc_id") % 11 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    rows, _, _ = X.labelled_rows(docs, labels, F.lit(False), shard_rows=200)
    got = rows.collect()
    ids, first = X.word_features(*T.string_buffer(pa.array([r.text for r in got])))
    toxic, langs = np.array([r.toxic for r in got]), np.array([r.lang for r in got])
    model = X.train(ids, first, toxic, epochs=1)
    scores = np.round(X.score(model, ids, first), X.SCORE_DIGITS)
    found = X._thresholds(rows, model)
    assert set(found) == {None, "", "de", "en"}
    for lang, threshold in found.items():
        own = np.full(len(got), True) if lang is None else langs == lang
        assert threshold == pytest.approx(X.best_threshold(scores[own], toxic[own]), abs=2e-4)
