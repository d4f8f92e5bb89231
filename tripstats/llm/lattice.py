"""Language-model scoring by subword lattice likelihood.

The model is a unigram model over the pieces of an existing subword
vocabulary: a text is a sequence of pieces drawn independently, then an end
piece.  A word's probability is the sum over all its segmentations into
pieces, by a forward recursion in log space; since no piece crosses white
space, a text's marginal probability is the product over its words and its
end.  Words are lower-cased (A-Z) and begin with the vocabulary's word mark;
single-byte pieces give every word at least one segmentation.

The corpus holds several languages, so the model is a mixture: one unigram
distribution for each value of ``lang`` that at least ``MIN_SHARE`` of the
training rows have and one for the rest, weighted by their shares of rows.  A
text is scored by the mixture, summed over all its components; its own
``lang`` is no input of its score.

The vocabulary file at hand is a BPE one, whose scores are merge ranks and no
log probabilities.  They start the estimate (a piece's share falls with its
rank), and expectation-maximisation over the counted words of all training
texts, until their likelihood settles, makes them unigram scores; the set of
pieces stays as it is.

Work is by distinct word.  One pass counts words; the word table grows with
the corpus and stays in Spark.  Texts are then scored in blocks of bounded
size: a block asks the word table for each of its distinct words once, and the
answers meet the block's texts again.  So a frequent word costs a row for each
block, not for each text.  Words are keyed by 64-bit hashes there.  Rows with
equal id and text are scored once.  A word above ``LONG`` bytes (text without
spaces) goes through the recursion in blocks, see :mod:`.longwords`.

Null text is an empty one, with the end as its only token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .longwords import LongWord
from .shared import shuffle_partitions, stored

BLOCK_BYTES = 16 << 20  # text in a block, on average
SETTLED = 0.002  # EM ends when a step raises the log likelihood of the training words by a smaller share
MIN_SHARE = 0.01  # of the training rows: a language above it has a distribution of its own, so there are at most 100
LONG = 2048
LOWEST = -600.0  # natural log of what a product of probabilities may come down to
CHUNK_WORDS = 40_000
CHUNK_BYTES = 8 << 20
_MARK = 0x20  # stands for the vocabulary's word mark; no word holds a space
_TABLE_BITS = 18


class Pieces:
    """A vocabulary's pieces as bytes, found by the hash of a substring."""

    _by_path: dict[str, Pieces] = {}  # one in each Python worker
    base = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        ranks: list[float] = []
        for i in range(model.get_piece_size()):
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if "▁" in piece[1:]:
                continue  # only the beginning of a word is marked
            self.bytes_of.append(piece.replace("▁", chr(_MARK)).encode())
            ranks.append(-model.get_score(i))
        # Every byte is a piece too, so that any word can be spelled.
        known = set(self.bytes_of)
        extra = [bytes([b]) for b in range(256) if bytes([b]) not in known]
        self.bytes_of += extra
        ranks += [max(ranks, default=0.0) + 1.0] * len(extra)
        self.longest = max(map(len, self.bytes_of))
        start = 1.0 / (np.array(ranks) + 2.0)
        self.start = np.log(start / start.sum())
        self.symbols = T.mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x51ED270B))
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, self.base)]))
        keys = np.zeros(len(self.bytes_of), np.uint64)
        for i, piece in enumerate(self.bytes_of):
            h = np.zeros(1, np.uint64)
            for b in piece:
                h = h * self.base + self.symbols[b]
            keys[i] = h[0]
        self.keys = keys
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a hash")
        # A table by some bits of the hash, and further ones for the pieces whose slot another piece took.
        self.tables = []
        rest = np.arange(len(self.keys), dtype=np.int32)
        while len(rest):
            table = np.full(1 << _TABLE_BITS, -1, np.int32)
            slot = self._slot(self.keys[rest], len(self.tables))
            table[slot] = rest
            self.tables.append(table)
            rest = rest[table[slot] != rest]

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    @staticmethod
    def _slot(keys: np.ndarray, level: int) -> np.ndarray:
        odd = np.uint64(0xD6E8FEB86659FD93 + 2 * level)
        return (keys * odd >> np.uint64(64 - _TABLE_BITS)).view(np.int64)

    def find(self, keys: np.ndarray, level: int = 0) -> np.ndarray:
        """Piece numbers of substring hashes, -1 for none."""
        out = self.tables[level][self._slot(keys, level)]
        taken = np.flatnonzero(out >= 0)
        other = taken[self.keys[out[taken]] != keys[taken]]  # the slot is another piece's
        if len(other):
            out[other] = self.find(keys[other], level + 1) if level + 1 < len(self.tables) else -1
        return out

    def arcs(self, words: np.ndarray) -> np.ndarray:
        """(length, most, words): the piece that ends at a position and has a length up to ``most``, or -1.

        ``words`` is a matrix of bytes, a row a word, all of one length.
        """
        n, length = words.shape
        most = min(length, self.longest)
        symbols = self.symbols[words.T]
        prefix = np.zeros((length + 1, n), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * self.base + symbols[j]
        out = np.full((length, most, n), -1, np.int32)
        for size in range(1, most + 1):
            h = prefix[size:] - prefix[: length + 1 - size] * self.powers[size]
            out[size - 1 :, size - 1] = self.find(h.ravel()).reshape(h.shape)
        return out[:, : most - int((out.max(axis=(0, 2)) >= 0)[::-1].argmax())]  # up to the longest piece there is


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the first axis; one term at least is finite (any byte is a piece)."""
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _weights(arcs: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    return np.append(log_p, -np.inf)[arcs]


def forward(weights: np.ndarray) -> np.ndarray:
    """(length + 1, words): log probability of all segmentations of every prefix."""
    length, most, n = weights.shape
    alpha = np.zeros((length + 1, n))
    for j in range(1, length + 1):
        k = min(j, most)
        alpha[j] = _log_sum(alpha[j - k : j][::-1] + weights[j - 1, :k])
    return alpha


def backward(weights: np.ndarray) -> np.ndarray:
    """(length + 1, words): log probability of all segmentations of every suffix."""
    length, most, n = weights.shape
    beta = np.zeros((length + 1, n))
    for i in range(length - 1, -1, -1):
        sizes = np.arange(min(length - i, most))
        beta[i] = _log_sum(beta[i + 1 : i + 1 + len(sizes)] + weights[i + sizes, sizes])
    return beta


def expected_counts(arcs: np.ndarray, log_p: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected number of every piece in the words, each counted ``times``, and the words' log probabilities."""
    last, size, word = np.nonzero(arcs >= 0)  # byte that a piece ends with, its length less one
    found = arcs[last, size, word]
    if len(arcs) * log_p.min() > LOWEST:
        p = np.append(np.exp(log_p), 0.0)
        alpha, beta = _products(p[arcs])
        share = alpha[last - size, word] * p[found] * beta[last + 1, word] / alpha[-1, word]
        return np.bincount(found, share * times[word], len(log_p)), np.log(alpha[-1])
    weights = _weights(arcs, log_p)
    alpha, beta = forward(weights), backward(weights)
    share = alpha[last - size, word] + log_p[found] + beta[last + 1, word] - alpha[-1, word]
    return np.bincount(found, np.exp(share) * times[word], len(log_p)), alpha[-1]


def _products(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`forward` and :func:`backward` of plain probabilities, for words too short to underflow."""
    length, most, n = p.shape
    alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
    alpha[0] = beta[length] = 1.0
    for j in range(1, length + 1):
        k = min(j, most)
        np.einsum("kn,kn->n", alpha[j - k : j][::-1], p[j - 1, :k], out=alpha[j])
    for i in range(length - 1, -1, -1):
        sizes = np.arange(min(length - i, most))
        np.einsum("kn,kn->n", beta[i + 1 : i + 1 + len(sizes)], p[i + sizes, sizes], out=beta[i])
    return alpha, beta


def _matrices(words: list[bytes], budget: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, byte matrix with the word mark) of words of equal length up to :data:`LONG`, in bounded pieces."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths[lengths <= LONG]):
        rows = np.flatnonzero(lengths == length)
        step = max(1, budget // int((length + 1) * 24))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            body = np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), length)
            yield part, np.concatenate([np.full((len(part), 1), _MARK, np.uint8), body], axis=1)


def _long(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, bytes with the word mark) of every longer word."""
    for row, word in enumerate(words):
        if len(word) > LONG:
            yield row, np.concatenate([np.full(1, _MARK, np.uint8), np.frombuffer(word, np.uint8)])


def word_log_p(words: list[bytes], pieces: Pieces, log_p: np.ndarray) -> np.ndarray:
    """(words, groups): natural-log probability of every word, over all its segmentations, by each row of ``log_p``."""
    out = np.zeros((len(words), len(log_p)))
    for rows, matrix in _matrices(words):
        arcs = pieces.arcs(matrix)
        for k, own in enumerate(log_p):
            out[rows, k] = forward(_weights(arcs, own))[-1]
    for row, data in _long(words):
        out[row] = [LongWord(data, pieces, own).log_probability() for own in log_p]
    return out


def word_counts(words: list[bytes], times: np.ndarray, pieces: Pieces, log_p: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected number of every piece by group, each word counted ``times[word, group]``, and the words' log likelihood."""
    counts, likelihood = np.zeros(log_p.shape), 0.0
    for rows, matrix in _matrices(words):
        arcs, own = pieces.arcs(matrix), times[rows]
        for k in range(len(log_p)):
            if (used := own[:, k] > 0).any():
                found, log_total = expected_counts(arcs[:, :, used], log_p[k], own[used, k])
                counts[k] += found
                likelihood += float(own[used, k] @ log_total)
    for row, data in _long(words):
        for k in np.flatnonzero(times[row]):
            likelihood += times[row, k] * LongWord(data, pieces, log_p[k]).expected_counts(counts[k], times[row, k])
    return counts, likelihood


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, hashes, words before each text)."""
    lower = T.LOWER_ASCII[raw]
    start, end, first = T.word_spans(lower, offsets)
    return lower, start, end, T.span_hashes(lower, start, end, seed=9), first


def count_words(docs: DataFrame, groups: int) -> DataFrame:
    """(h, word, c): every distinct word and how often the rows to learn from hold it, an array by group (maybe all 0).

    ``docs`` has ``text``, ``learn`` and ``group`` (0 to groups - 1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(0))
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            group = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in T.slices(offsets, BLOCK_BYTES // 4):
                lower, start, end, hashes, first = words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                kinds, at, which = np.unique(hashes, return_index=True, return_inverse=True)
                each = np.repeat(learn[a:b], np.diff(first))
                cell = which * groups + np.repeat(group[a:b], np.diff(first))
                counts = np.bincount(cell[each], minlength=len(kinds) * groups).astype(np.int64).reshape(-1, groups)
                counts[counts.sum(axis=1) == 0, 0] = -1  # not learnt from, but there
                row, col = np.nonzero(counts)
                data = lower.tobytes()
                spelled = pa.array([data[s:e] for s, e in zip(start[at].tolist(), end[at].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds.view(np.int64)[row]), spelled.take(pa.array(row)), pa.array(col, pa.int32()), pa.array(np.maximum(counts[row, col], 0))],
                    names=["h", "word", "group", "n"],
                )

    rows = docs.select("text", "learn", "group").mapInArrow(run, "h long, word binary, group int, n long")
    sums = [F.sum(F.when(F.col("group") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(groups)]
    counted = rows.groupBy("h", "word").agg(*sums)
    return counted.select("h", "word", F.array(*[F.col(f"c{k}") for k in range(groups)]).alias("c"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about :data:`CHUNK_WORDS` rows or :data:`CHUNK_BYTES`: numpy works on many words of a length at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_WORDS):
            held.append(batch.slice(at, CHUNK_WORDS))
            if sum(b.num_rows for b in held) >= CHUNK_WORDS or sum(b.nbytes for b in held) >= CHUNK_BYTES:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def _counts_of(column: pa.Array, groups: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, groups).astype(np.float64)


def fit(words: DataFrame, n_ends: np.ndarray, vocabulary: str, steps: int | None = None) -> np.ndarray:
    """(groups, pieces + 1) log probabilities of the vocabulary's pieces, the end piece last.

    Each step is one pass over the word table; a number for each piece and
    group (their number does not depend on the corpus) comes to the driver.
    Steps go on until the likelihood settles, or are as many as ``steps``.
    """
    pieces = Pieces.of(vocabulary)
    groups = len(n_ends)
    log_p = np.tile(pieces.start, (groups, 1))
    total = np.zeros(groups)
    done, before = 0, -np.inf
    while steps is None or done < steps:

        def run(batches: Iterator[pa.RecordBatch], log_p=log_p) -> Iterator[pa.RecordBatch]:
            own = Pieces.of(vocabulary)
            counts, likelihood = np.zeros(log_p.shape), 0.0
            for part in _chunks(batches):
                c = _counts_of(part.column(1), groups)
                learnt = np.flatnonzero(c.sum(axis=1))
                found, log_total = word_counts(part.column(0).take(pa.array(learnt)).to_pylist(), c[learnt], own, log_p)
                counts += found
                likelihood += log_total
            group, piece = np.nonzero(counts)
            # Piece -1 carries the log likelihood.
            columns = [np.append(group, 0).astype(np.int32), np.append(piece, -1).astype(np.int32), np.append(counts[group, piece], likelihood)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["group", "piece", "e"])

        rows = words.select("word", "c").mapInArrow(run, "group int, piece int, e double").groupBy("group", "piece").agg(F.sum("e").alias("e")).collect()
        counts = np.full(log_p.shape, 1e-3)  # a piece that was not seen keeps a little
        likelihood = 0.0
        for r in rows:
            if r["piece"] < 0:
                likelihood = r["e"]
            else:
                counts[r["group"], r["piece"]] += r["e"]
        total = counts.sum(axis=1)
        log_p = np.log(counts / total[:, None])
        done += 1
        if steps is None and likelihood - before <= SETTLED * abs(likelihood):
            break
        before = likelihood
    p_end = (n_ends + 1e-3) / (total + n_ends + 2e-3)
    return np.concatenate([log_p + np.log1p(-p_end)[:, None], np.log(p_end)[:, None]], axis=1)


def word_table(words: DataFrame, log_p: np.ndarray, vocabulary: str) -> DataFrame:
    """(h, c, lp): counts and log10 probabilities of all words, in training or not; ``lp`` holds a float for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces.of(vocabulary)
        for part in _chunks(batches):
            lp = (word_log_p(part.column(1).to_pylist(), own, log_p[:, :-1]) / np.log(10)).astype("<f4")
            c = _counts_of(part.column(2), len(log_p)).sum(axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(c), pa.array([x.tobytes() for x in lp], pa.binary())], names=["h", "c", "lp"])

    return words.select("h", "word", "c").mapInArrow(run, "h long, c long, lp binary")


def language_groups(rows: DataFrame, min_share: float = MIN_SHARE) -> tuple[Column, np.ndarray]:
    """(column of a row's group, training rows of each group).

    A language with at least ``min_share`` of the training rows is a group of
    its own; the last group is that of all others, if any training row has one.
    """
    found = rows.where("learn").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = found.agg(F.sum("n").alias("n")).first()["n"] or 0
    top = found.where(F.col("lang").isNotNull() & (F.col("n") >= min_share * total)).orderBy(F.desc("n"), "lang").collect()  # at most 1 / min_share
    counts = [r["n"] for r in top]
    rest = total - sum(counts)
    if rest or not counts:
        counts.append(rest)
    group = F.lit(len(counts) - 1)
    for i, r in enumerate(top):
        group = F.when(F.col("lang") == r["lang"], F.lit(i)).otherwise(group)
    return group, np.array(counts, dtype=np.float64)


def _kinds(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(id, key, text, learn) of every kind of row and whether ids are repeated: rows of equal id and text are one kind.

    Where ids are unique, every row is a kind, known by its id alone.
    """
    rows = rows.select("id", "text", "learn")
    repeated = stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "lattice-ids")
    if repeated.isEmpty():
        return rows.select("id", F.lit(0).cast("long").alias("key"), "text", "learn"), False
    rows = rows.select("id", F.xxhash64("text").alias("key"), "text", "learn")
    again = rows.join(repeated, "id", "left_semi").groupBy("id", "key").agg(F.min("text").alias("text"), F.max("learn").alias("learn"))
    return stored(rows.join(repeated, "id", "left_anti").unionByName(again), "lattice-kinds"), True


def _floats(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` floats from a column of their bytes, without a Python object a row."""
    parts = [np.zeros((0, width), "<f4")]
    for chunk in column.chunks:
        if len(chunk):
            begin = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset]
            data = np.frombuffer(chunk.buffers()[2], np.uint8)[begin : begin + len(chunk) * width * 4]
            parts.append(data.view("<f4").reshape(-1, width))
    return np.concatenate(parts)


NULL_ID = -(1 << 63)
SCORE_SCHEMA = "id long, key long, learn boolean, n_tokens long, n_known long, base_score double, score double"


def score_texts(docs: DataFrame, held_out: Column, vocabulary: str, steps: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Learns from the rows that are not ``held_out``.  ``base_score`` is the
    add-one unigram model over whole words, ``score`` the lattice model; both
    are log10 probabilities of the text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("lang").cast("string").alias("lang"), (~held_out).alias("learn"))
    size = int(rows.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()["bytes"] or 0)
    group, group_ends = language_groups(rows)
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text", "learn", group.alias("group"))
    n_ends = int(group_ends.sum())
    blocks = max(shuffle_partitions(spark), size // BLOCK_BYTES + 1)

    words = stored(count_words(rows, len(group_ends)), "lattice-words")
    count = F.aggregate("c", F.lit(0).cast("long"), lambda acc, x: acc + x)
    known = words.select(count.alias("c")).where("c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens = int(known["n"] or 0) + n_ends
    kinds = int(known["v"]) + (n_ends > 0)
    log_p = fit(words, group_ends, vocabulary, steps)
    table = word_table(words, log_p, vocabulary)

    kinds_of, repeated = _kinds(rows)
    blocked = kinds_of.select("id", "key", "learn", "text", F.pmod(F.xxhash64("id", "key"), F.lit(blocks)).alias("block"))

    def ask(group: pa.Table) -> pa.Table:
        found = []
        raw, offsets = T.string_buffer(group.column("text"))
        for a, b in T.slices(offsets):
            found.append(np.unique(words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[3]))
        hashes = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        block = group.column("block")[0].as_py()
        return pa.table({"block": pa.array(np.full(len(hashes), block), pa.int64()), "h": pa.array(hashes.view(np.int64), pa.int64())})

    asked = blocked.groupBy("block").applyInArrow(ask, "block long, h long")
    answers = asked.join(table, "h").select("block", "h", "c", "lp")
    log_total = np.log10(train_tokens + kinds + 1)
    prior = (group_ends + 0.5) / (group_ends + 0.5).sum()
    start_lp = log_p[:, -1] / np.log(10) + np.log10(prior)  # of the component, and of the text's end

    def judge(group: pa.Table, told: pa.Table) -> pa.Table:
        keys = told.column("h").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        c = told.column("c").to_numpy()[order]
        by_group = np.ascontiguousarray(_floats(told.column("lp"), len(start_lp))[order].T.astype(np.float64))
        base = np.log10(c + 1) - log_total
        raw, offsets = T.string_buffer(group.column("text"))
        tokens, knowns, bases, scores = [], [], [], []
        for a, b in T.slices(offsets):
            *_, hashes, first = words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            at, doc, n = np.searchsorted(keys, hashes), T.doc_of(first), b - a
            tokens.append(np.diff(first) + 1)
            knowns.append(np.bincount(doc, c[at] > 0, n).astype(np.int64) + (n_ends > 0))
            bases.append(np.bincount(doc, base[at], n) + np.log10(n_ends + 1) - log_total)
            parts = np.stack([np.bincount(doc, lp[at], n) + start for lp, start in zip(by_group, start_lp)])
            scores.append(_log_sum(parts * np.log(10)) / np.log(10))
        columns = [group.column("id"), group.column("key"), group.column("learn"), *(np.concatenate(x) for x in (tokens, knowns, bases, scores))]
        return pa.table(columns, names=[p.split()[0] for p in SCORE_SCHEMA.split(", ")])

    scored = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, SCORE_SCHEMA)
    if repeated:
        key = F.xxhash64("text").alias("key")
        # Written, so that the join can be split at a row that is there very often.
        scored = rows.select("doc_id", "id", "learn", key).join(stored(scored.drop("learn"), "lattice-scores"), ["id", "key"])
    else:
        scored = scored.withColumn("doc_id", F.when(F.col("id") != NULL_ID, F.col("id")))
    return scored.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
