"""Toxicity: a convolutional text classifier trained in numpy, applied by Spark.

A text is cut into words (A-Z lower-cased) at white space and at punctuation,
inside a run of characters as well as at its ends; a run of nothing but
punctuation is one word.  A word is embedded as the sum of four hashed
embeddings: of all its bytes, whatever their number, and of its first 4, 5 and
8 bytes.  In scripts written without spaces (Han, kana, Thai, Lao, Khmer,
Burmese and others; also emoji) every code point is a word of its own, whose
four embeddings are those of the 1, 2, 3 and 4 code points that begin there, so
the n-grams of the whole run are read.  Filters of widths 1, 2 and 3 run over
the word vectors, each filter's largest response in the text (at least 0) is
kept, and a logistic layer gives the score.

Training reads every labelled row outside the held-out fold, whole.  The rows
meet their labels once and stay where they are, dealt by doc_id into shards of
about ``SHARD_ROWS``.  The start is the log odds of every bucket, counted over
all rows.  In each round every shard takes minibatch steps over all its rows
from the common weights; the weights that shards have changed are averaged by
Spark (weighted by rows; an embedding over the shards that touched it) and are
the next round's start.  One threshold for each language is the best one of
the scores of all these rows.  Language only picks a threshold; it, source,
labels and doc_id are no inputs of the score.  Scoring is a narrow map over all
whole texts.

An empty or null text has no word; all its responses are 0, so its score is
the model's intercept.  Without labelled rows of both kinds the score is the
share of label 1 (0.5 without any row), for every text.
"""

from __future__ import annotations

import copy
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import stored

WIDTHS = (1, 2, 3)
FILTERS = 4  # of each width
DIM = 6
BUCKETS = 1 << 18  # of each of the four embeddings
PREFIXES = (4, 5, 8)
FEATURES = 1 + len(PREFIXES)  # the whole word and its prefixes, or the 1 to 4 code points from here on
SHARD_ROWS = 8192  # rows that one task learns from between two averages
STEP_WORDS = 1 << 17  # words whose responses a step holds at once; a longer text is alone
BATCH = 64
RATE = 0.05
EPOCHS = 6
SHARD_VISITS = 24_000  # row visits of a shard that suffice; LEAST_EPOCHS to EPOCHS rounds are made
LEAST_EPOCHS = 3
SCORE_DIGITS = 4  # of the histogram from which thresholds are read
SEED = 11

# Kinds of characters: a word ends at white space and punctuation; a lone code point is a word.
_BLANK, _PUNCT, _LETTER, _LONE = range(4)
_ASCII = np.full(256, _LETTER, np.uint8)
_ASCII[[b for b in range(128) if not chr(b).isalnum()]] = _PUNCT
_ASCII[T.SPACE] = _BLANK
# Scripts without spaces between words.
_UNSPACED = (
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F),
    (0x31A0, 0x9FFF), (0xA980, 0xA9FF), (0xAA00, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x1F000, 0x1FAFF), (0x20000, 0x3FFFF),
)


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.full(0x110000, _LETTER, np.uint8)
    for lo, hi in _UNSPACED:
        out[lo : hi + 1] = _LONE
    for c in range(128, 0x10000):
        category = unicodedata.category(chr(c))
        if category[0] in "PZ" or category in ("Cc", "Cf") and c not in (0x200C, 0x200D):  # joiners are within words
            out[c] = _PUNCT
        elif category == "So":
            out[c] = _LONE
    return out


def _kind_of_bytes(raw: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to."""
    out = _ASCII[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        size = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
        code = (raw[lead] & (0x7F >> size)).astype(np.int64)
        for k in (1, 2, 3):
            more = size > k
            code[more] = code[more] << 6 | raw[np.minimum(lead[more] + k, len(raw) - 1)] & 0x3F
        kind = _kinds()[np.minimum(code, 0x10FFFF)]
        out[lead] = kind
        for k in (1, 2, 3):
            at = lead + k
            own = (size > k) & (at < len(raw))
            own[own] = (raw[at[own]] & 0xC0) == 0x80
            out[at[own]] = kind[own]
    return out


def token_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, whether it is a lone code point) of every word, and the number of words before each text."""
    run_start, run_end, _ = T.word_spans(raw, offsets)
    if len(run_start) == 0:
        return run_start, run_end, np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    kind = _kind_of_bytes(raw)
    new = np.zeros(len(raw) + 1, bool)  # a character that does not go on with the word before it
    new[offsets] = True
    new[1:-1] |= kind[1:] != kind[:-1]
    new[:-1] |= (kind == _LONE) & ((raw & 0xC0) != 0x80)
    new[-1] = True
    edge = np.flatnonzero(new)
    start, end = edge[:-1], edge[1:]
    word = kind[start] >= _LETTER
    start, end = start[word], end[word]
    # A run without any word is one itself.
    bare = np.searchsorted(start, run_start) == np.searchsorted(start, run_end)
    if bare.any():
        start, end = np.concatenate([start, run_start[bare]]), np.concatenate([end, run_end[bare]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    return start, end, kind[start] == _LONE, np.searchsorted(start, offsets)


def word_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, FEATURES) rows of the embedding table, and the number of words before each text."""
    start, end, lone, first = token_spans(raw, offsets)
    if len(start) == 0:
        return np.zeros((0, FEATURES), np.int32), first
    raw = T.LOWER_ASCII[raw]
    codes = np.empty((FEATURES, len(start)), np.uint64)
    codes[0] = T.span_hashes(raw, start, end, seed=5)
    code = np.zeros(len(start), np.uint64)
    done = 0
    for i, size in enumerate(PREFIXES):
        for k in range(done, size):
            at = start + k
            inside = at < end
            byte = np.zeros(len(start), np.uint64)
            byte[inside] = raw[at[inside]]
            code |= byte << np.uint64(8 * k)
        done = size
        codes[i + 1] = code
    at = np.flatnonzero(lone)
    if len(at):
        # Lone code points that follow each other within a text are a run.
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (start[at[1:]] != end[at[:-1]])
        head = np.zeros(len(start) + 1, bool)
        head[first] = True
        new |= head[at]
        run = np.cumsum(new)
        own = codes[0, at]
        gram = own.copy()
        for n in range(1, FEATURES):
            goes_on = np.flatnonzero(run[n:] == run[:-n])
            gram[goes_on] = T.mix64(gram[goes_on] * np.uint64(0xD1342543DE82EF95) + own[goes_on + n])
            codes[n, at] = gram
    out = np.empty((len(start), FEATURES), np.int32)
    for i, size in enumerate((0, *PREFIXES)):
        hashed = T.mix64(codes[i] + np.uint64(size * 0x9E3779B9)) % np.uint64(BUCKETS)
        out[:, i] = hashed.astype(np.int32) + i * BUCKETS
    return out, first


@dataclass
class Model:
    embedding: np.ndarray  # (FEATURES * BUCKETS, DIM)
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    top: np.ndarray  # (len(WIDTHS) * FILTERS,)
    intercept: float
    thresholds: dict[str | None, float] = field(default_factory=dict)
    default_threshold: float = 0.5


def _responses(model: Model, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors and all filters' responses at every word (a window may reach past a text's end: zeros there)."""
    x = model.embedding[ids].sum(axis=1)
    n = len(x)
    out = np.empty((n, len(model.bias)), np.float32)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the text's end
    for i, weights in enumerate(model.filters):
        part = x @ weights[0]
        for j in range(1, len(weights)):
            ahead = np.zeros_like(x)
            ahead[:-j or None] = x[j:]
            ahead[left <= j] = 0
            part += ahead @ weights[j]
        out[:, i * FILTERS : (i + 1) * FILTERS] = part
    return x, out + model.bias


def _pooled(responses: np.ndarray, first: np.ndarray) -> np.ndarray:
    pooled = np.zeros((len(first) - 1, responses.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        pooled[full] = np.maximum.reduceat(responses, first[full], axis=0)
    return np.maximum(pooled, 0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def score(model: Model, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    if len(ids) == 0:
        return np.full(len(first) - 1, _sigmoid(np.array(model.intercept)))
    _, responses = _responses(model, ids, first)
    return _sigmoid(_pooled(responses, first).astype(np.float64) @ model.top + model.intercept)


def _count_hits(hits: np.ndarray, ids: np.ndarray, first: np.ndarray, labels: np.ndarray) -> None:
    """Add to ``hits`` (label, bucket) the texts that hold a bucket, each text once."""
    for d, label in enumerate(labels.tolist()):
        hits[label, np.unique(ids[first[d] : first[d + 1]])] += 1


def _start_from(hits: np.ndarray, total: list[int], rng: np.random.Generator) -> Model:
    """Initial weights: the first embedding dimension holds shrunken log odds of a bucket's presence."""
    n_filters = len(WIDTHS) * FILTERS
    embedding = rng.normal(0, 0.05, (FEATURES * BUCKETS, DIM)).astype(np.float32)
    odds = np.log((hits[1] + 0.5) / (total[1] + 1)) - np.log((hits[0] + 0.5) / (total[0] + 1))
    sure = (hits[0] + hits[1]) / (hits[0] + hits[1] + 10)
    embedding[:, 0] = np.clip(odds * sure, -4, 4) / 4
    filters = []
    for width in WIDTHS:
        w = rng.normal(0, 0.1, (width, DIM, FILTERS)).astype(np.float32)
        w[0, 0, 0] = 1.0
        filters.append(w)
    top = np.where(np.arange(n_filters) % FILTERS == 0, 1.0, 0.1).astype(np.float64)
    return Model(embedding, filters, np.zeros(n_filters, np.float32), top, -1.0)


def _start(ids: np.ndarray, first: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> Model:
    hits = np.zeros((2, FEATURES * BUCKETS), np.int64)
    _count_hits(hits, ids, first, labels)
    return _start_from(hits, [max(1, int((labels == c).sum())) for c in (0, 1)], rng)


def _memory_of(model: Model) -> Model:
    """Adagrad's sums of squared gradients, in the shapes of the model's weights, before the first step."""
    few = 1e-3
    return Model(np.full_like(model.embedding, few), [np.full_like(w, few) for w in model.filters], np.full_like(model.bias, few), np.full_like(model.top, few), few)


def _best_windows(model: Model, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every filter's largest response in every text (at least 0), and the word where it begins."""
    counts = np.diff(first)
    pooled = np.zeros((len(counts), len(model.bias)), np.float32)
    best = np.zeros((len(counts), len(model.bias)), np.int64)
    for a, b in T.slices(first, STEP_WORDS):
        own = first[a : b + 1] - first[a]
        if own[-1] == 0:
            continue
        _, responses = _responses(model, ids[first[a] : first[b]], own)
        pooled[a:b] = _pooled(responses, own)
        for d in range(a, b):
            if counts[d]:
                best[d] = first[d] + responses[own[d - a] : own[d - a + 1]].argmax(axis=0)
    return pooled, best


def _step(model: Model, memory: Model, ids: np.ndarray, first: np.ndarray, labels: np.ndarray, step: float) -> np.ndarray:
    """One Adagrad step, in place, on the mean logistic loss of a minibatch; the embeddings it has changed.

    Gradients flow only through each filter's best window.
    """
    n_filters = len(model.bias)
    widths = np.repeat(WIDTHS, FILTERS)
    pooled, best = _best_windows(model, ids, first)
    error = (_sigmoid(pooled.astype(np.float64) @ model.top + model.intercept) - labels) / len(labels)
    d_pooled = error[:, None] * model.top[None, :] * (pooled > 0)
    d_top, d_intercept = pooled.T.astype(np.float64) @ error, error.sum()
    doc, f = np.nonzero(d_pooled)
    at = best[doc, f]
    grad = d_pooled[doc, f].astype(np.float32)
    d_bias = np.bincount(f, grad, n_filters)
    d_filters = [np.zeros_like(w) for w in model.filters]
    keys = np.zeros(0, ids.dtype)
    touched, d_rows = [], []
    for j in range(max(WIDTHS)):
        used = (widths[f] > j) & (at + j < first[doc + 1])
        pos, fu, g = at[used] + j, f[used], grad[used]
        x = model.embedding[ids[pos]].sum(axis=1)
        for i in range(len(WIDTHS)):
            sel = fu // FILTERS == i
            if sel.any():
                w = model.filters[i][j]
                np.add.at(d_filters[i][j].T, fu[sel] % FILTERS, x[sel] * g[sel, None])
                touched.append(ids[pos[sel]])
                d_rows.append(w[:, fu[sel] % FILTERS].T * g[sel, None])
    if touched:
        ids_t, d_t = np.concatenate(touched), np.concatenate(d_rows)
        keys, inverse = np.unique(ids_t.ravel(), return_inverse=True)
        d_e = np.zeros((len(keys), DIM), np.float32)
        np.add.at(d_e, inverse, np.repeat(d_t, ids_t.shape[1], axis=0))
        memory.embedding[keys] += d_e**2
        model.embedding[keys] -= step * d_e / np.sqrt(memory.embedding[keys])
    for i, d in enumerate(d_filters):
        memory.filters[i] += d**2
        model.filters[i] -= step * d / np.sqrt(memory.filters[i])
    for name, d in (("bias", d_bias), ("top", d_top)):
        squares, value = getattr(memory, name) + d**2, getattr(model, name)
        setattr(memory, name, squares)
        setattr(model, name, (value - step * d / np.sqrt(squares)).astype(value.dtype))
    memory.intercept += d_intercept**2
    model.intercept -= step * d_intercept / np.sqrt(memory.intercept)
    return keys


def _pass(model: Model, memory: Model, ids: np.ndarray, first: np.ndarray, labels: np.ndarray, rng: np.random.Generator, batch: int, step: float) -> Iterator[np.ndarray]:
    """Steps over all texts once, in minibatches in random order; the embeddings that each has changed."""
    order = rng.permutation(len(labels))
    for at in range(0, len(order), batch):
        rows = order[at : at + batch]
        counts = first[rows + 1] - first[rows]
        yield _step(model, memory, ids[T.ragged(first[rows], counts)], np.concatenate([[0], np.cumsum(counts)]), labels[rows], step)


def _rate_of(rate: float, epoch: int) -> float:
    return rate / (1 + 0.3 * epoch)


def train(ids: np.ndarray, first: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> Model:
    """Fit to the texts of one array; what :func:`fit` does in every shard of its table."""
    rng = np.random.default_rng(SEED)
    model = _start(ids, first, labels, rng)
    memory = _memory_of(model)
    for epoch in range(epochs):
        for _ in _pass(model, memory, ids, first, labels, rng, batch, _rate_of(rate, epoch)):
            pass
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The threshold of the largest F1, halfway between the scores that it separates.

    With ``counts``, a score stands for so many rows, ``labels`` of which have label 1.
    """
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.cumsum(np.ones(len(s)) if counts is None else counts[order]) + labels.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores fall on one side
    at = int(np.argmax(f1))
    return float((s[at] + s[at + 1]) / 2) if at + 1 < len(s) else float(s[at])


def labelled_rows(docs: DataFrame, labels: DataFrame, held_out: Column, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int, float | None]:
    """(toxic, lang, text) of every row to learn from, a shard in each partition; rows of a shard; share of label 1 among the labels."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else None
    shards = max(1, -(-total // shard_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    texts = texts.where(F.col("doc_id").isNotNull() & ~held_out)
    joined = texts.repartition(shards, "doc_id").join(usable.repartition(shards, "doc_id"), "doc_id")
    # A join has the session's number of partitions at least; coalesce() makes them shards where they lie.
    rows = joined.coalesce(shards).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).select("toxic", "lang", "text")
    return rows, -(-total // shards), share


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """(features, words before each text, labels, languages) of slices of a partition of :func:`labelled_rows`."""
    for batch in T.tidied(batches):
        raw, offsets = T.string_buffer(batch.column(2))
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in T.slices(offsets):
            ids, first = word_features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield ids, first, labels[a:b], batch.column(1).slice(a, b - a)


def _bucket_hits(rows: DataFrame) -> np.ndarray:
    """(label, bucket): the texts that hold a bucket, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((2, FEATURES * BUCKETS), np.int64)
        for ids, first, labels, _ in _features_of(batches):
            _count_hits(hits, ids, first, labels)
        bucket = np.flatnonzero(hits.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *(pa.array(h[bucket]) for h in hits)], names=["bucket", "clean", "toxic"])

    found = rows.mapInArrow(run, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    hits = np.zeros((2, FEATURES * BUCKETS), np.int64)
    for i, name in enumerate(("clean", "toxic")):
        hits[i, found["bucket"].to_numpy()] = found[name].to_numpy()
    return hits


def _dense(model: Model) -> np.ndarray:
    """All weights but the embedding, in rows of ``DIM``."""
    flat = np.concatenate([*(w.ravel() for w in model.filters), model.bias, model.top, [model.intercept]]).astype(np.float32)
    return np.append(flat, np.zeros(-len(flat) % DIM, np.float32)).reshape(-1, DIM)


def _set_dense(model: Model, rows: np.ndarray) -> None:
    flat, at = rows.ravel(), 0
    for w in (*model.filters, model.bias, model.top):
        w[...] = flat[at : at + w.size].reshape(w.shape)
        at += w.size
    model.intercept = float(flat[at])


WEIGHTS = [*(f"w{i}" for i in range(DIM)), *(f"m{i}" for i in range(DIM))]  # of a row of the model, and of Adagrad's memory
ROUND_SCHEMA = ", ".join(["row int", "n long", *(f"{w} float" for w in WEIGHTS)])


def _round(rows: DataFrame, model: Model, memory: Model, epoch: int, batch: int = BATCH, rate: float = RATE) -> None:
    """One pass over all rows: every shard steps from the same weights, and the weights it changed are averaged."""
    shared = rows.sparkSession.sparkContext.broadcast((model, memory))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_memory = copy.deepcopy(shared.value)
        changed = np.zeros(len(own.embedding), bool)
        rng = np.random.default_rng([SEED, epoch])
        n = 0
        for ids, first, labels, _ in _features_of(batches):
            for keys in _pass(own, own_memory, ids, first, labels, rng, batch, _rate_of(rate, epoch)):
                changed[keys] = True
            n += len(labels)
        if n:
            at = np.flatnonzero(changed)
            values = np.hstack([np.vstack([m.embedding[at], _dense(m)]) for m in (own, own_memory)])
            row = np.append(at, len(changed) + np.arange(len(values) - len(at))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.full(len(row), n)), *(pa.array(v) for v in np.ascontiguousarray(values.T))], names=["row", "n", *WEIGHTS])

    means = [(F.sum(F.col(w).cast("double") * F.col("n")) / F.sum("n")).cast("float").alias(w) for w in WEIGHTS]
    found = rows.mapInArrow(run, ROUND_SCHEMA).groupBy("row").agg(*means).toArrow().sort_by("row")  # at most the model's rows
    shared.destroy()
    row = found["row"].to_numpy()
    dense = row >= len(model.embedding)
    for target, names in ((model, WEIGHTS[:DIM]), (memory, WEIGHTS[DIM:])):
        values = np.stack([found[w].to_numpy() for w in names], axis=1)
        target.embedding[row[~dense]] = values[~dense]
        _set_dense(target, values[dense])


def _thresholds(rows: DataFrame, model: Model) -> dict[str | None, float]:
    """The best threshold of every language with 5 rows of label 1, and of all rows (None), from their scores' histograms."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, first, labels, langs in _features_of(batches):
            yield pa.RecordBatch.from_arrays([langs, pa.array(labels), pa.array(score(shared.value, ids, first))], names=["lang", "toxic", "score"])

    def best(table: pa.Table) -> pa.Table:
        s, hits, n = (table[c].to_numpy() for c in ("bin", "hits", "n"))
        return pa.table({"lang": table["lang"][:1], "toxic": [int(hits.sum())], "threshold": [best_threshold(s, hits, n)]})

    scored = rows.mapInArrow(run, "lang string, toxic int, score double")
    bins = scored.groupBy("lang", F.round("score", SCORE_DIGITS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    bins = stored(bins, "toxicity-scores")
    whole = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).withColumn("lang", F.lit(None).cast("string"))
    found = bins.unionByName(whole).groupBy("lang").applyInArrow(best, "lang string, toxic long, threshold double").collect()  # 10 ** SCORE_DIGITS bins a group at most
    shared.destroy()
    return {r["lang"]: r["threshold"] for r in found if r["toxic"] >= 5 or r["lang"] is None}


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, shard_rows: int = SHARD_ROWS, epochs: int | None = None) -> Model:
    """The model of all labelled rows that are not ``held_out``."""
    rows, in_shard, share = labelled_rows(docs, labels, held_out, shard_rows)
    rows = rows.persist()  # read in every round, from the partitions that are the shards
    try:
        total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(total) < 2:
            p = min(max(0.5 if share is None else share, 1e-6), 1 - 1e-6)
            n = len(WIDTHS) * FILTERS
            blank = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
            return Model(np.zeros((FEATURES * BUCKETS, DIM), np.float32), blank, np.zeros(n, np.float32), np.zeros(n), float(np.log(p / (1 - p))))
        model = _start_from(_bucket_hits(rows), [total[0], total[1]], np.random.default_rng(SEED))
        memory = _memory_of(model)
        for epoch in range(epochs or min(EPOCHS, max(LEAST_EPOCHS, -(-SHARD_VISITS // in_shard)))):
            _round(rows, model, memory, epoch)
        found = _thresholds(rows, model)
        model.default_threshold = found.pop(None)
        model.thresholds = found
        return model
    finally:
        rows.unpersist()


def score_frame(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, score, lang_threshold) of every row; a narrow map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: BUCKETS * FEATURES * DIM numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                ids, first = word_features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                langs = batch.column(1).slice(a, b - a)
                limits = [fitted.thresholds.get(x or "", fitted.default_threshold) for x in langs.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), langs, pa.array(score(fitted, ids, first)), pa.array(limits, pa.float64())],
                    names=["doc_id", "lang", "score", "lang_threshold"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang string, score double, lang_threshold double")


def held_out_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` is ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, lang_threshold, toxic_by_language) of every row."""
    held_out = held_out_fold(F.col("doc_id"), folds, fold)
    scored = score_frame(docs, fit(docs, labels, held_out))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
        "lang_threshold",
        (F.col("score") >= F.col("lang_threshold")).alias("toxic_by_language"),
    )
