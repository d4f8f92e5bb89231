"""Weak supervision of document quality: rules vote or abstain, EM weighs them.

Each rule votes ``good`` or ``bad`` on a document or abstains.  A two-class
model (a document is good or bad; rules vote independently given the class,
each with its own accuracy on either class) is fitted to the counts of vote
patterns by expectation-maximisation, without labels.  A document is kept when
its posterior probability of being good is at least ``keep_at``.

Counts cover all documents: one narrow pass gives each document's features and
votes, a grouped count gives the pattern histogram (at most 3 ** rules rows,
whatever the corpus), and the fit on it is a few numbers.  No text is shuffled.

Null text has no words; a text without words has all counts 0 and only
abstentions, so its posterior is the prior.  Columns beside ``doc_id`` and
``text`` do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from . import text as T
from .shared import free_name, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_AT = 0.5
RULE_ERROR = 0.01  # no rule is taken to be surer than this, so one rule alone seldom rejects a document

BAD, GOOD, ABSTAIN = 0, 1, 2

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_marks", "n_ends", "n_runs", "n_distinct", "n_bare",
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True
_TEXTUAL = _LETTER.copy()  # letters, digits, and whatever is not ASCII
_TEXTUAL[ord("0") : ord("9") + 1] = True
_TEXTUAL[128:] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key: is it found at least twice, and is it the first one of its kind?"""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    last = np.ones(len(keys), dtype=bool)
    last[:-1] = fresh[1:]
    twice = np.empty(len(keys), dtype=bool)
    first = np.empty(len(keys), dtype=bool)
    twice[order] = ~(fresh & last)
    first[order] = fresh
    return twice, first


def features(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of :data:`COUNTS` for every text of a buffer."""
    n = len(offsets) - 1
    start, end, first = T.word_spans(raw, offsets)
    doc = T.doc_of(first)
    words = T.span_hashes(raw, start, end)
    salt = T.mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(0x51ED2701))

    def per_byte(mask: np.ndarray) -> np.ndarray:
        return T.segment_sums(mask.astype(np.int64), offsets)

    textual = np.concatenate([[0], np.cumsum(_TEXTUAL[raw])])
    ends_of_points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    line_start, line_end, line_first = T.line_spans(raw, offsets)
    line_doc = T.doc_of(line_first)
    worded = np.flatnonzero(np.searchsorted(start, line_end) > np.searchsorted(start, line_start))
    line_keys = T.mix64(T.span_hashes(raw, line_start, line_end)[worded] ^ salt[line_doc[worded]])
    _, line_is_first = _repeats(line_keys)

    windows = T.window_starts(first, 3)
    twice, _ = _repeats(T.mix64(T.window_hashes(words, 3)[windows] ^ salt[doc[windows]]))
    covered = np.zeros(len(words) + 2, dtype=bool)
    for shift in range(3):
        covered[windows[twice] + shift] = True
    _, word_is_first = _repeats(T.mix64(words ^ salt[doc]))

    punct = _PUNCT[raw]
    run = np.zeros(len(raw), dtype=bool)
    run[1:] = punct[1:] & (raw[1:] == raw[:-1])
    return {
        "n_words": np.diff(first),
        "word_chars": T.segment_sums(ends_of_points[end] - ends_of_points[start], first),
        "n_symbols": per_byte(_SYMBOL[raw]),
        "n_dup_lines": np.bincount(line_doc[worded][~line_is_first], minlength=n),
        "n_repeat_words": T.segment_sums(covered[: len(words)].astype(np.int64), first),
        "n_lines": np.bincount(line_doc[worded], minlength=n),
        "n_upper": per_byte(_UPPER[raw]),
        "n_letters": per_byte(_LETTER[raw]),
        "n_marks": per_byte(raw == ord("!")),
        "n_ends": T.segment_sums(punct[end - 1].astype(np.int64), first) if len(end) else np.zeros(n, np.int64),
        "n_runs": per_byte(run),
        "n_bare": T.segment_sums((textual[end] == textual[start]).astype(np.int64), first),
        "n_distinct": T.segment_sums(word_is_first.astype(np.int64), first),
    }


# name, numerator, denominator, smallest denominator to vote on, good below, bad from
SHARE_RULES = (
    ("symbols", "n_symbols", "n_words", 10, 0.05, 0.2),
    ("capitals", "n_upper", "n_letters", 20, 0.2, 0.5),
    ("marks", "n_marks", "n_words", 10, 0.1, 0.3),
    ("repeated_words", "n_repeat_words", "n_words", 10, 0.15, 0.4),
    ("repeated_lines", "n_dup_lines", "n_lines", 3, 0.1, 0.4),
    ("punctuated_words", "n_ends", "n_words", 10, 0.35, 0.7),
    ("bare_punctuation", "n_bare", "n_words", 10, 0.05, 0.2),
    ("punctuation_runs", "n_runs", "n_words", 10, 0.1, 0.3),
)
RULES = tuple(r[0] for r in SHARE_RULES) + ("word_length", "word_variety")


def votes(f: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, rules) of votes."""
    out = []
    for _, top, below, least, good, bad in SHARE_RULES:
        share = f[top] / np.maximum(f[below], 1)
        vote = np.where(share >= bad, BAD, np.where(share < good, GOOD, ABSTAIN))
        out.append(np.where(f[below] >= least, vote, ABSTAIN))
    n = np.maximum(f["n_words"], 1)
    mean = f["word_chars"] / n
    vote = np.where((mean < 2) | (mean > 14), BAD, np.where((mean > 3) & (mean < 10), GOOD, ABSTAIN))
    out.append(np.where(f["n_words"] >= 10, vote, ABSTAIN))
    # Distinct words grow slower than the text, so the share is held against the root of its length.
    variety = f["n_distinct"] / np.sqrt(n)
    vote = np.where(variety < 2, BAD, np.where(variety > 4, GOOD, ABSTAIN))
    out.append(np.where(f["n_words"] >= 40, vote, ABSTAIN))
    return np.stack(out, axis=1)


def patterns(v: np.ndarray) -> np.ndarray:
    """One number for each row of votes, base 3."""
    return (v * 3 ** np.arange(v.shape[1])).sum(1)


def pattern_votes(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(RULES)) % 3


def features_frame(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, pattern) of every document; a narrow map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(1))
            for a, b in T.slices(offsets):
                f = features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                columns = [batch.column(0).slice(a, b - a), *(pa.array(f[c], pa.int64()) for c in COUNTS)]
                columns.append(pa.array(patterns(votes(f)), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "pattern"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", pattern long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def fit(codes: np.ndarray, counts: np.ndarray, steps: int = 200, prior_bad: float = 0.1) -> dict[str, np.ndarray]:
    """EM on a pattern histogram: the class prior and each rule's chance of a bad vote by class.

    The start (bad documents get a bad vote from a third of the rules, good
    ones from a fiftieth) names the classes; pseudo-counts in the same
    proportions keep a rule that never votes, or an empty table, defined.
    """
    v = pattern_votes(codes)
    said_bad, said = (v == BAD).astype(float), (v != ABSTAIN).astype(float)
    bad_if_bad, bad_if_good = np.full(v.shape[1], 0.34), np.full(v.shape[1], 0.02)
    prior = prior_bad
    weight = counts.astype(float)
    for _ in range(steps):
        p = posterior_bad(said_bad, said, prior, bad_if_bad, bad_if_good)
        w_bad, w_good = weight * p, weight * (1 - p)
        new_prior = (w_bad.sum() + 2 * prior_bad) / (weight.sum() + 2)
        bad_if_bad = (w_bad @ said_bad + 0.68) / (w_bad @ said + 2)
        bad_if_good = (w_good @ said_bad + 0.04) / (w_good @ said + 2)
        bad_if_bad = np.clip(bad_if_bad, RULE_ERROR, 1 - RULE_ERROR)
        bad_if_good = np.clip(bad_if_good, RULE_ERROR, 1 - RULE_ERROR)
        if abs(new_prior - prior) < 1e-10:
            break
        prior = new_prior
    return {"prior_bad": np.array(prior), "bad_if_bad": bad_if_bad, "bad_if_good": bad_if_good}


def posterior_bad(said_bad, said, prior, bad_if_bad, bad_if_good) -> np.ndarray:
    log_odds = np.log(prior / (1 - prior))
    log_odds = log_odds + said_bad @ np.log(bad_if_bad / bad_if_good)
    log_odds = log_odds + (said - said_bad) @ np.log((1 - bad_if_bad) / (1 - bad_if_good))
    return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def fit_frame(feature_rows: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(pattern codes, their posterior of good, model) over all rows; rows without words do not count.

    The histogram has at most 3 ** len(RULES) rows, so it comes to the driver.
    """
    rows = feature_rows.where(F.col("n_words") > 0).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    codes = np.array(sorted(r["pattern"] for r in rows), dtype=np.int64)
    by_code = {r["pattern"]: r["n"] for r in rows}
    model = fit(codes, np.array([by_code[c] for c in codes.tolist()], dtype=np.int64))
    # A text without words has only abstentions and needs a posterior too.
    silent = int(patterns(np.full((1, len(RULES)), ABSTAIN))[0])
    codes = np.union1d(codes, [silent]).astype(np.int64)
    return codes, 1 - _posterior(codes, model), model


def _posterior(codes: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    v = pattern_votes(codes)
    said_bad, said = (v == BAD).astype(float), (v != ABSTAIN).astype(float)
    return posterior_bad(said_bad, said, float(model["prior_bad"]), model["bad_if_bad"], model["bad_if_good"])


def base_failed() -> Column:
    """The base rules: too few words, or too many words in repeated three-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, counts, base_failed, p_good, kept) of every row of ``docs``."""
    rows = stored(features_frame(docs), "quality-features")
    codes, good, _ = fit_frame(rows)
    spark = docs.sparkSession
    verdicts = spark.createDataFrame([(int(c), float(g)) for c, g in zip(codes, good)], "pattern long, p_good double")
    return (
        rows.join(F.broadcast(verdicts), "pattern")  # at most 3 ** rules rows
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_at))
    )


def keep_good(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns as they are.

    One narrow pass over the texts, which are written with their vote patterns
    (reading them again costs less than counting again), and no shuffle of them.
    """
    columns = docs.columns
    at = columns.index("text")
    pattern, words, failed = (free_name(columns, n) for n in ("pattern", "n_words", "base_failed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(at))
            for a, b in T.slices(offsets):
                f = features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                fails = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])
                added = [pa.array(patterns(votes(f)), pa.int64()), pa.array(f["n_words"], pa.int64()), pa.array(fails)]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *added], names=[*columns, pattern, words, failed])

    schema = StructType([*docs.schema.fields, StructField(pattern, LongType()), StructField(words, LongType()), StructField(failed, BooleanType())])
    marked = stored(docs.mapInArrow(run, schema), "quality-marked")
    codes, good, _ = fit_frame(marked.select(F.col(f"`{pattern}`").alias("pattern"), F.col(f"`{words}`").alias("n_words")))
    kept = docs.sparkSession.createDataFrame([(int(c),) for c in codes[good >= keep_at]], "code long")
    # At most 3 ** rules rows are broadcast.
    passed = marked.where(~F.col(f"`{failed}`")).join(F.broadcast(kept), F.col(f"`{pattern}`") == F.col("code"), "left_semi")
    return passed.select(*[F.col(f"`{c}`") for c in columns])
