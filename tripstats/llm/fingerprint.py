"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph (a line between ``\\n``) is hashed to a wide vector; a text's
state is the sum of its paragraphs' vectors, lane by lane, modulo a power of
two.  So the state does not depend on the order of paragraphs, and a paragraph
is inserted or deleted by adding or subtracting its vector.  Two groups of
lanes are summed alike:

* ``IDENTITY_LANES`` lanes modulo 2**64 from BLAKE2b of the paragraph's bytes.
  Their hex digits are the fingerprint: equal multisets of paragraphs give
  equal fingerprints, other texts differ but for a chance of about 2**-1000.
* ``LIKENESS_LANES`` lanes modulo 2**32: each five-word shingle of the
  paragraph (a shorter paragraph is one shingle) adds +1 or -1 to one lane.
  The cosine of two such vectors estimates the cosine of the two shingle
  multisets (standard error about 1 / sqrt(lanes)); it is the likeness.

Null text is an empty text, which is one empty paragraph.  Likeness of equal
fingerprints is 1; of different ones, if either text has no word, 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .shared import shuffle_partitions

IDENTITY_LANES = 16
LIKENESS_LANES = 512
SHINGLE = 5

STATE_SCHEMA = "identity binary, likeness binary"


def paragraph_states(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Identity vectors of the paragraphs, and (paragraph, lane, sign) of every shingle."""
    data = raw.tobytes()
    blake = hashlib.blake2b
    digests = b"".join(
        blake(data[s:e], person=b"lanes-a").digest() + blake(data[s:e], person=b"lanes-b").digest()
        for s, e in zip(starts.tolist(), ends.tolist())
    )
    identity = np.frombuffer(digests, dtype="<u8").reshape(-1, IDENTITY_LANES)
    bounds = np.append(starts, len(raw)) if len(starts) else np.zeros(1, np.int64)
    word_start, word_end, first = T.word_spans(raw, bounds)
    shingles, first = T.shingle_hashes(T.span_hashes(raw, word_start, word_end), first, SHINGLE)
    lane = (shingles >> np.uint64(32)).astype(np.int64) % LIKENESS_LANES
    sign = np.where(shingles & np.uint64(1), 1.0, -1.0)
    return identity, T.doc_of(first), lane, sign


def _sums(n: int, group: np.ndarray, identity: np.ndarray, shingle_group: np.ndarray, lane: np.ndarray, sign: np.ndarray):
    """Sum paragraphs into ``n`` states; items whose group is below 0 are left out."""
    total = np.zeros((n, IDENTITY_LANES), dtype=np.uint64)
    used = group >= 0
    np.add.at(total, group[used], identity[used])
    used = shingle_group >= 0
    flat = np.bincount(shingle_group[used] * LIKENESS_LANES + lane[used], sign[used], n * LIKENESS_LANES)
    return total, flat.astype(np.int64).astype(np.uint32).reshape(n, LIKENESS_LANES)


def states(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identity and likeness lanes of every text of a buffer."""
    starts, ends, first = T.line_spans(raw, offsets)
    identity, owner, lane, sign = paragraph_states(raw, starts, ends)
    doc = T.doc_of(first)
    return _sums(len(offsets) - 1, doc, identity, doc[owner], lane, sign)


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Insert: the state of both multisets together."""
    return a[0] + b[0], a[1] + b[1]


def subtract(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Delete: the state of ``a`` without the paragraphs of ``b``."""
    return a[0] - b[0], a[1] - b[1]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row likeness, 0 to 1."""
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), norm, out=np.zeros(len(x)), where=norm > 0)
    return np.where((a[0] == b[0]).all(1), 1.0, np.clip(cosine, 0.0, 1.0))


def hex_lanes(identity: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.ascontiguousarray(identity)]


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with ``fingerprint`` (hex) and the binary lanes ``identity`` and ``likeness``.

    A narrow map: no shuffle.  Existing columns of those names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("fingerprint", "identity", "likeness")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = T.string_buffer(batch.column(at))
            for a, b in T.slices(offsets):
                found = states(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(hex_lanes(found[0]), pa.string()),
                        pa.array([x.tobytes() for x in found[0]], pa.binary()),
                        pa.array([x.tobytes() for x in found[1]], pa.binary()),
                    ],
                    names=[*kept, "fingerprint", "identity", "likeness"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, fingerprint string, {STATE_SCHEMA}")


EDIT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _edit_rows(table: pa.Table) -> pa.RecordBatch | None:
    """Rows 0 .. n-2 of an ordered table, each compared with its edit and with the row after it."""
    ids, bucket, extra = (table.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "bucket", "extra"))
    emit = np.flatnonzero((bucket[:-1] == bucket[1:]) & (extra[:-1] == 0))
    if len(emit) == 0:
        return None
    raw, offsets = T.string_buffer(table.column("text"))
    n = len(offsets) - 1
    starts, ends, first = T.line_spans(raw, offsets)
    identity, owner, lane, sign = paragraph_states(raw, starts, ends)
    doc = T.doc_of(first)
    full = _sums(n, doc, identity, doc[owner], lane, sign)

    points = np.append(T.code_point_starts(raw), len(raw))
    before = np.searchsorted(points, offsets)  # code points before each text
    chars = np.diff(before)
    swapped = chars[emit] // 4
    cut = points[before[emit] + chars[emit] - swapped]
    head_end = points[before[emit + 1] + np.minimum(swapped, chars[emit + 1])]

    # The edit deletes the paragraphs from the one that holds the cut, and inserts the new ones.
    cut_of = np.full(n, -1, np.int64)
    cut_of[emit] = cut
    # ``cut <= end``: a cut just before a newline changes that paragraph; with nothing swapped none changes.
    cut_of[emit[swapped == 0]] = len(raw) + 1
    deleted_line = ends >= cut_of[doc]
    group = np.where(deleted_line, doc, -1)
    gone = _sums(n, group, identity, group[owner], lane, sign)
    first_gone = np.searchsorted(np.flatnonzero(deleted_line), first[:-1][emit])
    gone_lines = np.append(np.flatnonzero(deleted_line), 0)
    data = raw.tobytes()
    tails, digests = [], []
    for i, (row, c, h) in enumerate(zip(emit.tolist(), cut.tolist(), head_end.tolist())):
        head = data[offsets[row + 1] : h]
        if swapped[i]:
            tails.append(data[starts[gone_lines[first_gone[i]]] : c] + head)
            digests.append(hashlib.sha256(data[offsets[row] : c] + head).hexdigest())
        else:
            digests.append(hashlib.sha256(data[offsets[row] : offsets[row + 1]]).hexdigest())
    state = (full[0][emit], full[1][emit])
    edited = subtract(state, (gone[0][emit], gone[1][emit]))
    if tails:
        tail_offsets = np.concatenate([[0], np.cumsum([len(x) for x in tails])])
        new = states(np.frombuffer(b"".join(tails), dtype=np.uint8), tail_offsets)
        rows = np.flatnonzero(swapped > 0)
        edited[0][rows] += new[0]
        edited[1][rows] += new[1]
    following = (full[0][emit + 1], full[1][emit + 1])
    return pa.RecordBatch.from_arrays(
        [
            table.column("doc_id").combine_chunks().take(pa.array(emit)),
            pa.array(chars[emit], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(hex_lanes(state[0]), pa.string()),
            pa.array(hex_lanes(edited[0]), pa.string()),
            pa.array(likeness(state, edited)),
            pa.array(likeness(state, following)),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _edit_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    carry: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        _, offsets = T.string_buffer(table.column("text"))
        for a, b in T.slices(offsets):
            part = table.slice(a, b - a + 1)  # one row more: the next document
            if (rows := _edit_rows(part)) is not None:
                yield rows
        carry = table.slice(table.num_rows - 1)


def _bucket_of(key: Column, cuts: list[int]) -> tuple[Column, Column]:
    """(number of cuts up to ``key``, is ``key`` a cut), in about 2 * sqrt(cuts) comparisons a row."""
    if not cuts:
        return F.lit(0), F.lit(False)
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    table = F.array(*[F.array(*[F.lit(c).cast("long") for c in g]) for g in groups])
    group = F.coalesce(F.size(F.filter(heads, lambda b: b <= key)), F.lit(0)) - 1  # -1: before all cuts, or null
    own = F.get(table, F.greatest(group, F.lit(0)))
    inside = F.coalesce(F.size(F.filter(own, lambda b: b <= key)), F.lit(0))
    return F.when(group < 0, F.lit(0)).otherwise(group * width + inside), F.coalesce(F.array_contains(own, key), F.lit(False))


def edit_fingerprints(docs: DataFrame, rows_per_bucket: int = 20_000) -> DataFrame:
    """Fingerprint every text, its edit with the next document's head, and the likenesses.

    Order is ascending (doc_id, text), null ids first; the last document's
    next is the first.  The ids are cut into buckets at quantiles of doc_id,
    so each document stands with its successor in one sorted partition; the
    first document of each bucket is added to the bucket before as well.
    Documents of one id are not split (a row key is expected to be an id).
    The only shuffle is that of the texts.  An empty table gives no row.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    facts = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.sum(F.col("doc_id").isNull().cast("int")).alias("nulls")).first()
    partitions = shuffle_partitions(spark)
    buckets = max(partitions, min(4 * partitions, -(-facts["n"] // rows_per_bucket)))
    cuts: list[int] = []
    if facts["lo"] is not None and buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        found = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * buckets)).alias("q")).first()["q"]
        cuts = sorted({c for c in found if c > facts["lo"] or facts["nulls"]})
    last = len(cuts)
    key = F.col("doc_id")
    bucket, begins = _bucket_of(key, cuts)
    is_first = key.isNull() if facts["nulls"] else key.eqNullSafe(F.lit(facts["lo"]).cast("long"))
    none = F.struct(F.lit(-1).alias("bucket"), F.lit(1).alias("extra"))
    places = F.array(
        F.struct(bucket.alias("bucket"), F.lit(0).alias("extra")),
        F.when(begins, F.struct((bucket - 1).alias("bucket"), F.lit(1).alias("extra"))).otherwise(none),
        F.when(is_first, F.struct(F.lit(last).alias("bucket"), F.lit(1).alias("extra"))).otherwise(none),
    )
    placed = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .select("doc_id", "text", F.explode(places).alias("place"))
        .where("place.bucket >= 0")
        .select("doc_id", "text", "place.bucket", "place.extra")
    )
    ordered = placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "extra", "doc_id", "text")
    return ordered.mapInArrow(_edit_stream, EDIT_SCHEMA)
