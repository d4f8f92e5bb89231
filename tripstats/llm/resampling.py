"""Importance resampling to a target distribution: hashed n-gram gains, Gumbel scores, a bracketed cutoff.

A document's features are its runs of 1 to 2 words, hashed into buckets.  The
counts of all documents and of all target texts give every bucket a gain (a
log ratio in thousandths); the gains are one array of ``buckets`` numbers,
which scores the documents in one narrow pass.  A document's weight is the mean
gain of its features; with Gumbel noise from a hash of its doc_id added, the k
highest scores are a draw without replacement in proportion to exp(weight).

The cutoff is found without sorting the corpus.  Mergeable quantile sketches
(KLL), one a task, merged in two levels, name a bracket around the k-th score;
exact counts above and inside it prove that the cutoff lies there, else the
bracket widens (its last width is everything).  Only the bracket's rows are
sorted, by ranges.  The drawn rows then get their ranks from a sort by ranges
too: position in the range plus the rows of the ranges before.

Defined results: null text has no words; a text without words has weight 0 and
a score; null doc_id is hashed as an empty name and stands before all others
among equal scores; rows of equal score and doc_id (repeated rows) have ranks
in the order of the scored table; an empty table, on either side, gives
defined gains (all counts 0).  Other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import stored

# Bytes that are no part of a word: ASCII but for digits and letters (capitals are lower-cased first).
APART = np.zeros(256, dtype=bool)
APART[:128] = True
APART[ord("0") : ord("9") + 1] = False
APART[ord("a") : ord("z") + 1] = False

LONG_SPAN = 48  # bytes; longer spans are hashed one by one
LEAST_ID = -(1 << 63)


@dataclass(frozen=True)
class Resampling:
    """Hash buckets, percent of the eligible documents drawn, words that make one eligible, seed; sketch parameters."""

    buckets: int = 10_000
    percent: int = 25
    min_words: int = 20
    seed: int = 7
    sketch_k: int = 1024  # KLL: rank error about 0.3 %
    margin: float = 0.005  # half the bracket's first width, as a share of all rows


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table.astype(np.uint32)


_CRC = _crc_table()


def crc32_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of every byte span, carried on from the CRC-32s ``before`` if given.

    All spans advance by a byte at a time, those that are over drop out; spans
    above :data:`LONG_SPAN` bytes are hashed by zlib.
    """
    out = np.zeros(len(starts), dtype=np.uint32) if before is None else before.astype(np.uint32, copy=True)
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG_SPAN):
        out[i] = zlib.crc32(raw[starts[i] : ends[i]], int(out[i]))
    short = np.flatnonzero((lengths > 0) & (lengths <= LONG_SPAN))
    short = short[np.argsort(-lengths[short], kind="stable")]
    falling, at = -lengths[short], starts[short]
    state = ~out[short]
    for p in range(-int(falling[0]) if len(short) else 0):
        live = int(np.searchsorted(falling, -p))  # spans longer than p
        part = state[:live]
        state[:live] = _CRC[(part ^ raw[at[:live] + p]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out[short] = ~state
    return out


def feature_buckets(raw: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every feature, and the number of words before each text."""
    raw = T.LOWER_ASCII[raw]
    starts, ends, first = T.word_spans(raw, offsets, APART)
    one = crc32_spans(raw, starts, ends)
    doc = T.doc_of(first)
    pair = np.flatnonzero(doc[1:] == doc[:-1])  # words with a word behind them in their text
    spaced = ~one[pair]
    spaced = ~(_CRC[(spaced ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (spaced >> np.uint32(8)))
    two = crc32_spans(raw, starts[pair + 1], ends[pair + 1], spaced)
    return np.concatenate([one, two]) % np.uint32(buckets), np.concatenate([doc, doc[pair]]), first


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts (column ``text``) by bucket.  A task sends its counts once; ``buckets`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(0))
            for a, b in T.slices(offsets):
                found, _, _ = feature_buckets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], buckets)
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket, in doubles; B buckets."""
    s, t, b = corpus.astype(np.float64), target.astype(np.float64), float(len(corpus))
    ratio = (t + 1) * (float(corpus.sum()) + b) / ((s + 1) * (float(target.sum()) + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; a narrow pass with the array of gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(1))
            for a, b in T.slices(offsets):
                found, doc, first = feature_buckets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], len(gain))
                features = np.bincount(doc, minlength=b - a)
                # Sums of integers in doubles: exact, a text's gains stay far below 2 ** 53.
                total = np.bincount(doc, weights=gain[found], minlength=b - a).astype(np.int64)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                columns = [batch.column(0).slice(a, b - a), *(pa.array(x, pa.int64()) for x in (np.diff(first), features, weight))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 8 hex digits of sha256 of ``seed:doc_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, target: DataFrame, how: Resampling) -> DataFrame:
    """:func:`weighted` with ``score``, and ``row_no``, which tells repeated rows apart; written once."""
    gain = gains(bucket_counts(docs, how.buckets), bucket_counts(target, how.buckets))
    rows = weighted(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), how.seed))
    return stored(rows.withColumn("row_no", F.monotonically_increasing_id()), "resample-scores")


# Highest score first, then the smaller doc_id (null before all), then the row.
def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row_no").asc()]


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 … in ``order``, which leaves no two rows equal.

    Ranges of the order are sorted apart; a row's rank is its position in the
    range and the sizes of the ranges before (a table of as many rows as ranges).
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = placed.select(*rows.columns, F.shiftright("at", 33).alias("range_no"), F.col("at").bitwiseAND((1 << 33) - 1).alias("range_at"))
    placed = stored(placed, name)
    sizes = placed.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range_no", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("rows_before"))
    joined = placed.join(F.broadcast(sizes), "range_no")  # as many rows as there are shuffle partitions
    return joined.select(*rows.columns, (F.col("rows_before") + F.col("range_at") + 1).alias("rank"))


def score_sketch(rows: DataFrame, sketch_k: int) -> DataFrame:
    """One KLL sketch of ``score``: tasks' sketches are merged in groups, then the groups (at most 256)."""
    group = F.shiftright("row_no", 33) % 256  # the task that wrote the row
    parts = rows.groupBy(group.alias("part")).agg(F.kll_sketch_agg_bigint("score", sketch_k).alias("sketch"))
    return parts.agg(F.kll_merge_agg_bigint("sketch", sketch_k).alias("sketch"))


def bracket(rows: DataFrame, k: int, total: int, how: Resampling) -> tuple[int | None, int | None, int]:
    """(low, high, rows above high) with the k-th highest score in [low, high]; None is no bound.

    The sketch only proposes: ``above < k <= above + inside``, counted exactly,
    decides, and the next bracket has four times the width.
    """
    widths = [how.margin * 4**i for i in range(20) if how.margin * 4**i < 1]
    middle = 1 - k / total
    places = [min(max(middle + sign * w, 0.0), 1.0) for w in widths for sign in (-1, 1)]
    quantiles = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(p) for p in places]))
    found = score_sketch(rows, how.sketch_k).select(quantiles.alias("q")).first()["q"]
    for i in range(len(widths)):
        low, high = found[2 * i], found[2 * i + 1]
        counts = rows.agg(
            F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score").between(low, high)).alias("inside")
        ).first()
        if counts["above"] < k <= counts["above"] + counts["inside"]:
            return low, high, counts["above"]
    return None, None, 0


def cutoff(rows: DataFrame, k: int, total: int, how: Resampling) -> dict:
    """The k-th row of ``rows`` (score, doc_id, row_no) in order, 1 <= k <= total; only the bracket is sorted."""
    low, high, above = bracket(rows, k, total, how)
    inside = rows if low is None else rows.where(F.col("score").between(low, high))
    inside = inside.select("score", "doc_id", "row_no")
    return ranked(inside, _order(), "resample-bracket").where(F.col("rank") == k - above).first().asDict()


def _upto(cut: dict) -> Column:
    """Rows that do not stand behind ``cut``."""
    doc_id = F.coalesce(F.col("doc_id"), F.lit(LEAST_ID))
    at = LEAST_ID if cut["doc_id"] is None else cut["doc_id"]
    null_first = F.col("doc_id").isNotNull().cast("int"), int(cut["doc_id"] is not None)
    here = F.struct((-F.col("score")).alias("a"), null_first[0].alias("b"), doc_id.alias("c"), F.col("row_no").alias("d"))
    there = F.struct(
        F.lit(-cut["score"]).cast("long").alias("a"), F.lit(null_first[1]).alias("b"), F.lit(at).cast("long").alias("c"), F.lit(cut["row_no"]).cast("long").alias("d")
    )
    return here <= there


def draws(docs: DataFrame, target: DataFrame, how: Resampling | None = None) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``; rank is null where it is not drawn.

    ``target`` has the texts whose distribution is aimed at, in ``text``.
    """
    how = how or Resampling()
    rows = scored(docs, target, how)
    columns = [c for c in rows.columns if c != "row_no"]
    eligible = F.col("n_words") >= how.min_words
    total = rows.where(eligible).count()
    k = how.percent * total // 100
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return rows.select(*columns, none)
    cut = cutoff(rows.where(eligible), k, total, how)
    drawn = eligible & _upto(cut)
    taken = ranked(rows.where(drawn), _order(), "resample-drawn")
    return taken.select(*columns, "rank").unionByName(rows.where(~drawn).select(*columns, none))


def draw(docs: DataFrame, target: DataFrame, how: Resampling | None = None) -> DataFrame:
    """The drawn rows of :func:`draws`, by rank."""
    return draws(docs, target, how).where(F.col("rank").isNotNull())


DRAW_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), w AS (
  SELECT 'd' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), f AS (
  SELECT side, doc_id, unnest(ws) AS f FROM w
  UNION ALL
  SELECT side, doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
), x AS (
  SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)
), y AS (
  SELECT f, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT) AS bytes FROM x
), z AS (
  SELECT f, xor(4294967295, list_reduce([4294967295::BIGINT] || bytes, lambda c, k: xor(tab[(xor(c, k) & 255) + 1], c >> 8))) % 10000 AS bucket FROM y, crc
), n AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f JOIN z USING (f) GROUP BY bucket
), t AS (
  SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM n
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain FROM n, t
), m AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM f JOIN z USING (f) JOIN g USING (bucket) WHERE side = 'd' GROUP BY doc_id
), d AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::BIGINT AS h
  FROM w LEFT JOIN m USING (doc_id) WHERE side = 'd'
), s AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM d
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS total FROM s WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * total // 100 THEN r END::BIGINT AS rank FROM s LEFT JOIN r USING (doc_id)
"""
