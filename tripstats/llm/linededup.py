"""Exact line dedup over a range-partitioned, sorted stream of line hashes.

1. A narrow pass hashes every line's key (128 bits) and drops short keys.
2. The rows (hash, doc_id, line number) are range-partitioned on all of these
   columns and sorted within partitions.  A very common line spans as many
   partitions as its rows fill, since document and position are range keys too.
3. Each partition is streamed once: a hash's first row opens a run, the run's
   documents are counted, and lines of all but its largest document are marked.
   A run that touches a partition's edge cannot be judged alone (nor one longer
   than ``HOLD`` rows be held); it is given out unjudged with a small summary
   for every partition, and judged in a second step from those summaries.
4. The marks of a document become a bitmap of the lines to keep, compressed;
   no text moves until a caller applies the bitmaps.

Null or empty text is one empty line, whose key is too short to be dropped.
Rows that share a doc_id count as one document; lines are marked by
(doc_id, text hash), so equal rows lose the same lines.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import free_name, shuffle_partitions, stored

MIN_KEY_CHARS = 20
MIN_DOCS = 3
HOLD = 1_000_000  # rows of one run that a task holds before it hands them on unjudged

LINE_SCHEMA = "h1 long, h2 long, doc_id long, text_key long, line int"


def line_keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, line number, two hashes) of every line whose key is long enough.

    Also used on a buffer of any texts; ends are stripped of white space, A-Z lower-cased.
    """
    start, end, first = T.line_spans(raw, offsets)
    doc = T.doc_of(first)
    number = np.arange(len(start)) - first[doc]
    word_start, word_end, _ = T.word_spans(raw, offsets)
    # A key runs from its line's first word to its last one.
    lo, hi = np.searchsorted(word_start, start), np.searchsorted(word_start, end)
    full = np.flatnonzero(hi > lo)
    key_start, key_end = word_start[lo[full]], word_end[hi[full] - 1]
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    long = points[key_end] - points[key_start] >= MIN_KEY_CHARS
    full, key_start, key_end = full[long], key_start[long], key_end[long]
    lower = T.LOWER_ASCII[raw]
    h1, h2 = (T.span_hashes(lower, key_start, key_end, seed).view(np.int64) for seed in (1, 2))
    return doc[full], number[full], h1, h2


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def lines_frame(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, text_key, line) of every line with a long enough key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                doc, number, h1, h2 = line_keys(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                take = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), batch.column(0).take(take), batch.column(1).take(take), pa.array(number, pa.int32())],
                    names=["h1", "h2", "doc_id", "text_key", "line"],
                )

    return _keyed(docs).mapInArrow(run, LINE_SCHEMA)


# A row is a marked line (kind 0), an unjudged one (1) or the summary of a part of a run (2),
# whose ``n_docs`` documents go from ``doc_id`` to ``last_doc``.
MARK_SCHEMA = f"kind int, {LINE_SCHEMA}, n_docs long, last_doc long"
_NAMES = [p.split()[0] for p in MARK_SCHEMA.split(", ")]


def _out(kind, h1, h2, doc, null_doc, key, line, n_docs=None, last=None) -> pa.RecordBatch:
    n = len(h1)
    zeros = np.zeros(n, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind), pa.int32()),
            pa.array(h1, pa.int64()),
            pa.array(h2, pa.int64()),
            pa.array(doc, pa.int64(), mask=null_doc),
            pa.array(key, pa.int64()),
            pa.array(line, pa.int32()),
            pa.array(zeros if n_docs is None else n_docs, pa.int64()),
            pa.array(zeros if last is None else last, pa.int64()),
        ],
        names=_NAMES,
    )


# Null ids sort first in Spark; as numbers they are below every other id.
_NULL_ID = np.iinfo(np.int64).min


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []  # rows of the run that is still open: (5, n) arrays
    held_rows, at_edge = 0, True  # the open run may have begun in the partition before

    def unjudged(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, key, line = rows
        yield _out(1, h1, h2, doc, doc == _NULL_ID, key, line)
        n_docs = 1 + np.count_nonzero(doc[1:] != doc[:-1])
        yield _out(2, h1[:1], h2[:1], doc[:1], doc[:1] == _NULL_ID, key[:1], line[:1], np.array([n_docs]), doc[-1:])

    for batch in T.tidied(batches):
        if batch.num_rows == 0:
            continue
        doc = batch.column(2).fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)
        rows = np.stack([c if c is doc else c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (batch.column(0), batch.column(1), doc, batch.column(3), batch.column(4))])
        if held:
            rows = np.concatenate([*held, rows], axis=1)
        h1, h2, doc, key, line = rows
        new_run = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
        if len(new_run) == 0:
            held, held_rows = [rows], rows.shape[1]
            if held_rows >= HOLD:
                yield from unjudged(rows)
                held, held_rows, at_edge = [], 0, True
            continue
        begin = np.concatenate([[0], new_run[:-1]])
        if at_edge:
            yield from unjudged(rows[:, : new_run[0]])
            begin = begin[1:]
        at_edge = False
        if len(begin):
            lo, hi = begin[0], new_run[-1]
            run_of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, hi)))
            d = doc[lo:hi]
            fresh = np.ones(hi - lo, np.int64)
            fresh[1:] = (d[1:] != d[:-1]) | (run_of[1:] != run_of[:-1])
            n_docs = np.add.reduceat(fresh, begin - lo)
            last = d[np.append(begin[1:], hi) - 1 - lo]
            marked = np.flatnonzero((n_docs[run_of] >= MIN_DOCS) & (d != last[run_of])) + lo
            if len(marked):
                yield _out(0, h1[marked], h2[marked], doc[marked], doc[marked] == _NULL_ID, key[marked], line[marked])
        held, held_rows = [rows[:, new_run[-1] :]], rows.shape[1] - new_run[-1]
    if held:
        yield from unjudged(held[0])


def marked_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line) of every line to drop."""
    lines = stored(lines_frame(docs), "line-hashes")
    order = ["h1", "h2", "doc_id", "text_key", "line"]
    spread = lines.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    marks = stored(spread.mapInArrow(_stream, MARK_SCHEMA), "line-marks")
    names = ["doc_id", "text_key", "line"]
    # Parts of one run follow each other, so a document in two parts is the last of one and the first of the next.
    first = F.coalesce(F.col("doc_id"), F.lit(int(_NULL_ID)))
    parts = marks.where("kind = 2").select("h1", "h2", first.alias("lo"), F.col("last_doc").alias("hi"), "n_docs")
    # One row for every partition edge, and for every HOLD rows of a run: few beside the lines.
    runs = parts.groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "n_docs"))).alias("parts"), F.max("hi").alias("top")
    )
    overlaps = F.size(
        F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: (i > 1) & (F.get("parts", i - 1)["lo"] == F.get("parts", i - 2)["hi"]))
    )
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p["n_docs"]) - overlaps
    judged = runs.where(total >= MIN_DOCS).select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "top")
    # Judged runs are those at a partition's edges, two for each, and those longer than HOLD rows: a size that
    # follows the number of partitions, not of rows.
    late = marks.where("kind = 1").join(F.broadcast(judged), (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")))
    late = late.where(F.coalesce(F.col("doc_id"), F.lit(int(_NULL_ID))) != F.col("top"))
    return marks.where("kind = 0").select(*names).unionByName(late.select(*names))


BITMAP_SCHEMA = "doc_id long, text_key long, n_lines long, n_dropped long, keep binary"


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, keep) of every document that loses a line.

    ``keep`` is a zlib-compressed bitmap, a bit for each line up to the last
    dropped one (least significant bit first); lines after it are kept, and
    so is every line of a document without a row here.
    """
    dropped = marked_lines(docs).groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            bitmaps = []
            for lines in batch.column(2):
                at = lines.values.to_numpy(zero_copy_only=False)
                bits = np.ones(int(at.max()) // 8 * 8 + 8, dtype=np.uint8)  # whole bytes; what is padded is kept
                bits[at] = 0
                bitmaps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            counts = pa.array([len(x) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), counts, pa.array(bitmaps, pa.binary())], names=["doc_id", "text_key", "n_dropped", "keep"]
            )

    return dropped.mapInArrow(run, "doc_id long, text_key long, n_dropped long, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> bytes:
    """``text`` without the lines that a bitmap drops."""
    if keep is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    stay = np.ones(max(len(lines), len(bits)), dtype=bool)
    stay[: len(bits)] = bits
    return b"\n".join([lines[i] for i in np.flatnonzero(stay[: len(lines)]).tolist()])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, keep: str = "_keep", n_dropped: str = "_n_dropped") -> DataFrame:
    """``docs`` with the columns ``keep`` (null: all lines) and ``n_dropped``; one shuffle of the texts."""
    left = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"),
    )
    found = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("text_key").alias("b_key"), "keep", "n_dropped")
    joined = left.join(found, F.col("key").eqNullSafe(F.col("b_key")) & F.col("id").eqNullSafe(F.col("b_id")), "left")
    own = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return joined.select(*own, F.col("keep").alias(keep), F.col("n_dropped").alias(n_dropped))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its repeated lines gone from ``text``; other columns as they are, but
    ``n_chars``, if there is one, counts the new text.  A document whose lines are all dropped stays, empty."""
    columns = docs.columns
    at = columns.index("text")
    keep = free_name(columns, "keep")
    joined = with_bitmaps(docs, keep_bitmaps(docs), keep, free_name(columns, "n_dropped"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            keeps = batch.column(batch.num_columns - 1)
            texts = [
                t if k is None or t is None else kept_lines(t.encode(), k).decode()
                for t, k in zip(batch.column(at).to_pylist(), keeps.to_pylist())
            ]
            arrays = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    out = joined.select(*[F.col(f"`{c}`") for c in columns], keep).mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


DIGEST_SCHEMA = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def line_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row, its bitmap applied."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = with_bitmaps(base, keep_bitmaps(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            kept = [hashlib.sha256(kept_lines(t, k)).hexdigest() for t, k in zip(texts, batch.column(2).to_pylist())]
            n_lines = pa.array([t.count(b"\n") + 1 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_lines, batch.column(3).fill_null(0), pa.array(kept, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.select("doc_id", "text", "_keep", "_n_dropped").mapInArrow(run, DIGEST_SCHEMA)
