"""Repeated long passages by word windows, the edges of a De Bruijn graph, in minimizer runs.

Runs of windows with one anchor stand in for the graph's compaction: there are
no nodes, no degrees, and runs of different anchors are not joined.

An edge of the graph is a window of ``WINDOW`` consecutive words.  A window is
repeated when an equal one starts earlier (smaller doc_id, or same document
and earlier start), and the words under repeated windows are removed.

1. Every window names the smallest of its ``ANCHOR``-word hashes its anchor.
   Consecutive windows with one anchor are a path, of at most
   ``WINDOW - ANCHOR + 1`` edges; equal windows have the same anchor at the
   same place, so windows are only ever equal between paths of one anchor.
2. Anchors are counted; a path whose anchor occurs once holds no repeat and
   is gone.  If all paths of an anchor are equal, the path does not branch: it
   stays one compact edge, its first occurrence stays and all others are
   repeated as a whole.  Both steps are grouped counts (combined before the
   shuffle) and equi-joins, which AQE splits at a passage that many share.
3. Where the paths of an anchor differ, equal paths are still one compact
   edge; the first occurrence of each is laid out window by window from its
   source coordinates, and windows are compared between those few.
4. A document's repeated spans are put together, and its words outside stay.

Windows are told apart by two 64-bit hashes (anchor, and path or window).
Words are maximal runs of other characters than space, \\t, \\n, \\v, \\f, \\r,
unchanged; null text has none.  Rows with one doc_id are one document: an equal
window at the same start in another row of that id is not earlier.  A null id
comes before all others.  Rows with equal id and text are worked on once, and
all get the result, so a list of spans is never longer than a text's windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import free_name, stored

WINDOW = 20
ANCHOR = 6
_NULL_ID = -(1 << 63)

PATH_SCHEMA = "anchor long, path long, doc long, copy long, start int, edges int"


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest of every ``width`` consecutive values."""
    at = np.arange(len(values))
    best, span = values, 1
    while span < width:
        step = min(span, width - span)
        n = len(best) - step
        later = best[step:] < best[:n]
        at = np.where(later, at[step:], at[:n])
        best = np.where(later, best[step:], best[:n])
        span += step
    return at


def paths(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, edges, anchor hash, path hash) of every path."""
    starts = T.window_starts(first, WINDOW)
    none = np.zeros(0, np.int64)
    if len(starts) == 0:
        return none, none, none, none, none
    grams = T.window_hashes(words, ANCHOR, seed=3)
    anchor = _sliding_argmin(grams, WINDOW - ANCHOR + 1)[starts]
    doc = T.doc_of(np.searchsorted(starts, first))
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    edges = np.diff(np.append(head, len(starts)))
    begin, at = starts[head], anchor[head]
    # Hash of the path's words and of the anchor's place in it.
    w = T.mix64(words + np.uint64(5))
    base = 0xD6E8FEB86659FD93
    powers = np.cumprod(np.full(len(w), base, dtype=np.uint64))
    inverse = np.cumprod(np.full(len(w), pow(base, -1, 1 << 64), dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * powers)])
    body = (sums[begin + edges + WINDOW - 1] - sums[begin]) * inverse[begin]
    path = T.mix64(body + ((at - begin) * 64 + edges).astype(np.uint64))
    return doc[head], begin - first[doc[head]], edges, grams[at].view(np.int64), path.view(np.int64)


def _rows(docs: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """(doc, copy, text) of every row and of every kind of row, and whether any id is repeated.

    Ids are without null; ``copy`` is a hash of the text where ids are
    repeated, else 0.  Of the rows with equal id and text there is one kind;
    only texts of repeated ids are shuffled for it, combined in each task first.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc")
    rows = docs.select(doc, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    repeated = stored(docs.select(doc).groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "graph-ids")
    if repeated.isEmpty():
        rows = rows.select("doc", F.lit(0).cast("long").alias("copy"), "text")
        return rows, rows, False
    rows = rows.select("doc", F.xxhash64("text").alias("copy"), "text")
    again = rows.join(repeated, "doc", "left_semi").groupBy("doc", "copy").agg(F.min("text").alias("text"))
    kinds = rows.join(repeated, "doc", "left_anti").unionByName(again)
    return rows, stored(kinds, "graph-kinds"), True


def paths_frame(rows: DataFrame) -> DataFrame:
    """The paths of every text; a narrow map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                own, own_offsets = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, first = T.word_spans(own, own_offsets)
                doc, begin, edges, anchor, path = paths(T.span_hashes(own, start, end), first)
                take = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor),
                        pa.array(path),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(begin, pa.int32()),
                        pa.array(edges, pa.int32()),
                    ],
                    names=[p.split()[0] for p in PATH_SCHEMA.split(", ")],
                )

    return rows.mapInArrow(run, PATH_SCHEMA)


def _window_frame(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """(anchor, window, doc, copy, start): every window of the chosen paths, from their texts."""
    wanted = chosen.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "edges", "anchor")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(2))
            parts = batch.column(3)
            for a, b in T.slices(offsets):
                own, own_offsets = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, first = T.word_spans(own, own_offsets)
                windows = T.window_hashes(T.span_hashes(own, start, end), WINDOW, seed=7)
                mine = parts.slice(a, b - a)
                flat = mine.flatten()
                begin, edges, anchor = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
                doc = np.repeat(np.arange(b - a), mine.value_lengths().to_numpy(zero_copy_only=False))
                at = T.ragged(first[doc] + begin, edges)
                owner = np.repeat(np.arange(len(begin)), edges)
                take = pa.array(doc[owner] + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[owner]),
                        pa.array(windows[at].view(np.int64)),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(at - first[doc[owner]], pa.int32()),
                    ],
                    names=["anchor", "window", "doc", "copy", "start"],
                )

    joined = rows.join(wanted, ["doc", "copy"]).select("doc", "copy", "text", "parts")
    return joined.mapInArrow(run, "anchor long, window long, doc long, copy long, start int")


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in ("doc", "start", "copy")])


def repeated_parts(rows: DataFrame) -> DataFrame:
    """(doc, copy, start, end): word ranges under repeated windows; they may overlap."""
    found = paths_frame(rows)
    counted = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("lo"), F.max("path").alias("hi"))
    # Written, so that both sides of the join are plain shuffles by anchor: AQE can then split an anchor that a
    # large share of the paths have (a run of one word), or broadcast a small table.
    repeated = stored(counted.where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("branches")), "graph-anchors")
    shared = stored(found.join(repeated, "anchor"), "graph-paths")
    compact = stored(
        shared.groupBy("anchor", "path").agg(
            F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"), F.max("branches").alias("branches"), F.max("edges").alias("edges")
        ),
        "graph-edges",
    )
    # All occurrences of a compact edge but its first are repeated.
    first = compact.where("n > 1").select("anchor", "path", "first")
    later = shared.join(first, ["anchor", "path"])
    same = (F.col("doc") == F.col("first.doc")) & (F.col("start") == F.col("first.start"))
    whole = later.where(~same).select("doc", "copy", "start", (F.col("start") + F.col("edges") + WINDOW - 1).alias("end"))
    # Where an anchor's paths branch, the windows of the firsts are compared.
    chosen = compact.where("branches").select("anchor", F.col("first.doc").alias("doc"), F.col("first.copy").alias("copy"), F.col("first.start").alias("start"), "edges")
    windows = stored(_window_frame(rows, chosen), "graph-windows")
    heads = windows.groupBy("anchor", "window").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = stored(heads, "graph-heads")
    single = windows.join(heads.select("anchor", "window", "first"), ["anchor", "window"]).where(~same)
    return whole.unionByName(single.select("doc", "copy", "start", (F.col("start") + WINDOW).alias("end")))


def _spans(kinds: DataFrame, repeated: bool) -> DataFrame:
    """(doc, copy, parts): the ranges of :func:`repeated_parts`, a list for each kind of row."""
    parts = stored(repeated_parts(kinds), "graph-parts")
    spans = parts.groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "end")).alias("parts"))
    # Written where rows repeat, so that the join with them can be split at a row that is there very often.
    return stored(spans, "graph-spans") if repeated else spans


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the union of word ranges."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)] if len(end) else end


def _merged(parts: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    values = parts.values
    if values is None or len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merge(*(values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2)))


def kept_words(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """(words outside the spans joined by one space, words, words removed); spans do not overlap."""
    words = text.split()  # bytes split at exactly the separators of words
    if len(start) == 0:
        return b" ".join(words), len(words), 0
    change = np.zeros(len(words) + 1, np.int8)
    change[start] += 1
    change[end] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join(compress(words, keep.tolist())), len(words), int((end - start).sum())


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): the maximal repeated word ranges [start, end) of every text that has any; equal rows are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in _merged(p)))] for p in batch.column(1)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    doc = F.when(F.col("doc") != _NULL_ID, F.col("doc"))
    _, kinds, repeated = _rows(docs)
    return _spans(kinds, repeated).select(doc.alias("doc_id"), "parts").mapInArrow(run, "doc_id long, spans array<struct<start: long, end: long>>")


DIGEST_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def removal_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, its repeated spans taken out."""
    rows, kinds, repeated = _rows(docs)
    joined = rows.join(_spans(kinds, repeated), ["doc", "copy"], "left").select("doc", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = [kept_words(t, *_merged(p)) for t, p in zip(texts, batch.column(2))]
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, mask=doc == _NULL_ID),
                    pa.array([n for _, n, _ in found], pa.int64()),
                    pa.array([r for _, _, r in found], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in found], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return joined.mapInArrow(run, DIGEST_SCHEMA)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its repeated passages gone from ``text`` (kept words joined by one space where any went);
    other columns as they are."""
    columns = docs.columns
    at = columns.index("text")
    extra = free_name(columns, "parts")
    _, kinds, repeated = _rows(docs)
    copy = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) if repeated else F.lit(0).cast("long")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"), copy.alias("copy")
    )
    joined = keyed.join(_spans(kinds, repeated), ["doc", "copy"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, p in enumerate(batch.column(len(columns))):
                spans = _merged(p)
                if len(spans[0]):
                    texts[i] = kept_words(texts[i].encode(), *spans)[0].decode()
            arrays = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    own = [F.col("row").getField(c).alias(c) for c in columns]
    return joined.select(*own, F.col("parts").alias(extra)).mapInArrow(run, docs.schema)
