"""Near-duplicate classes by DartMinHash signatures and exact verification.

A document is the weighted set of its five-word shingles; a shingle's weight
is how often it occurs.  Similarity is weighted Jaccard (sum of minima over
sum of maxima), and documents of similarity ``threshold`` or more are linked;
classes are the connected components of these links.

1. Rows with equal word sequences are one content (grouped with map-side
   combining).  Each content gets a number, and contents, not doc_ids, are
   banded, compared and linked: rows that share a doc_id, but not their text,
   are judged each by its own text.  doc_ids come back at the end.
2. Darts: each unit of a shingle's weight owns a strip of the rank axis, on
   which a hashed Poisson process throws darts of its own, the same ones in
   every document.  A document of total weight W sees the darts of rank below
   (k ln k + 2k) / W; each dart carries one of k coordinates, and the
   earliest dart of each coordinate is the signature.  A document with an
   empty coordinate looks twice as far.
3. Bands of ``ROWS`` coordinates are bucket keys.
4. A bucket is not expanded into pairs.  In a round some of its members lead:
   they are compared exactly with the members that are not yet in their class,
   and then leave the bucket.  Links merge classes, and a bucket whose members
   are all in one class is done; this settles small buckets, and large groups
   whose members are alike.
5. Buckets that still hold several classes after ``ROUNDS`` rounds (near
   copies of near copies, about as similar as the threshold) are cut into
   blocks of bounded size, and each member's items are sent once to every
   block of its bucket.  A task gets two blocks, counts common items by an
   inverted index and returns which classes are linked, no pairs.  So two
   documents of a bucket are in one class or have been compared: no link in a
   bucket is lost.

Words are maximal runs of other characters than space, \\t, \\n, \\v, \\f, \\r; a document
of 1 to 4 words has one shingle.  Null and empty texts have no words: they are
equal contents, linked with no others.  A row without doc_id is not compared
and its class_id is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .graph import components
from .shared import stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5  # a pair of similarity 0.8 shares a band with probability 0.99995
ROUNDS = 2
BLOCK_DOCS, BLOCK_BYTES = 256, 8 << 20  # of a block, on average
_UNIT = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def unit_items(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for every unit of weight of every document, and their number before each document.

    The i-th occurrence of a shingle is an item of its own, so that weighted
    sets with whole weights are plain sets of items.
    """
    shingles, first = T.shingle_hashes(words, first, SHINGLE)
    doc = T.doc_of(first)
    salt = T.mix64(np.arange(1, len(first) + 1, dtype=np.uint64))
    keys = T.mix64(shingles ^ salt[doc])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0)) if len(keys) else np.zeros(0, np.int64)
    occurrence = np.empty(len(keys), np.uint64)
    occurrence[order] = (np.arange(len(keys)) - begin).astype(np.uint64)
    return T.mix64(shingles + occurrence * _UNIT), first


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _throw(items: np.ndarray, first: np.ndarray, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(earliest rank, its dart) for every document and coordinate; rank inf where no dart fell.

    ``reach[d]`` is the rank up to which document d looks.
    """
    n = len(first) - 1
    doc = T.doc_of(first)
    limit = reach[doc]
    rank = np.zeros(len(items))
    alive = np.arange(len(items))
    best_rank = np.full(n * k, np.inf)
    best_dart = np.zeros(n * k, np.uint64)
    arrival = 0
    while len(alive):
        arrival += 1
        dart = T.mix64(items[alive] + np.uint64(arrival * 0xA24BAED4963EE407 & _MASK))
        rank[alive] -= np.log(_uniform(dart))  # gaps of a Poisson process are exponential
        hit = rank[alive] < limit[alive]
        alive, dart = alive[hit], dart[hit]
        cell = doc[alive] * k + (T.mix64(dart ^ _UNIT) % np.uint64(k)).astype(np.int64)
        found = rank[alive]
        np.minimum.at(best_rank, cell, found)
        win = best_rank[cell] == found
        best_dart[cell[win]] = dart[win]
    return best_rank.reshape(n, k), best_dart.reshape(n, k)


def signatures(items: np.ndarray, first: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """(documents, k) signature; a document without items has zeros."""
    counts = np.diff(first)
    out = np.zeros((len(counts), k), np.uint64)
    todo = np.flatnonzero(counts)
    spread = k * np.log(k) + 2 * k
    while len(todo):
        own = items[T.ragged(first[todo], counts[todo])]
        own_first = np.concatenate([[0], np.cumsum(counts[todo])])
        rank, dart = _throw(own, own_first, k, spread / counts[todo])
        full = np.isfinite(rank).all(axis=1)
        out[todo[full]] = dart[full]
        todo, spread = todo[~full], 2 * spread
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(documents, BANDS) bucket keys."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _UNIT, parts.shape[:2]).copy()
    for i in range(ROWS):
        key = T.mix64(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, i])
    return key.view(np.int64)


def content_keys(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every document's word sequence."""
    out = []
    for seed in (1, 2):
        w = T.mix64(words + np.uint64(seed * int(_UNIT) & _MASK))
        index = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        longest = int(np.diff(first).max()) if len(first) > 1 else 0
        powers = np.cumprod(np.full(longest, 0xD6E8FEB86659FD93, dtype=np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * powers[index])])
        out.append(T.mix64(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


SIGNED_SCHEMA = "doc_id long, t long, k1 long, k2 long, bands array<long>"


def _text_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text key, content keys, band keys) of every row; a narrow map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(1))
            for a, b in T.slices(offsets):
                own, own_offsets = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, first = T.word_spans(own, own_offsets)
                words = T.span_hashes(own, start, end)
                k1, k2 = content_keys(words, first)
                bands = band_keys(signatures(*unit_items(words, first)))
                ends = np.concatenate([[0], np.cumsum(np.where(np.diff(first) > 0, BANDS, 0))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands[np.diff(first) > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(k1), pa.array(k2), lists],
                    names=["doc_id", "t", "k1", "k2", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _text_key().alias("t"))
    return rows.mapInArrow(run, SIGNED_SCHEMA)


def _item_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, items) of the wanted contents: their items, sorted, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(1))
            for a, b in T.slices(offsets):
                own, own_offsets = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                start, end, first = T.word_spans(own, own_offsets)
                words = T.span_hashes(own, start, end)
                k1, k2 = content_keys(words, first)
                items, first = unit_items(words, first)
                packed = [np.sort(items[x:y]).tobytes() for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
                want1, want2 = (batch.column(i).slice(a, b - a).to_numpy(zero_copy_only=False) for i in (2, 3))
                same = pa.array((k1 == want1) & (k2 == want2))
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(packed, pa.binary())], names=["id", "items"])
                yield out.filter(same)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _text_key().alias("t"))
    return rows.join(wanted, ["doc_id", "t"]).select("id", "text", "k1", "k2").mapInArrow(run, "id long, items binary").dropDuplicates(["id"])


def similarities(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``s``, their exact weighted Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            out = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = np.count_nonzero(y[at] == x) if len(y) else 0
                out.append(both / max(1, len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "s"])

    left = items.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    right = items.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    joined = pairs.select("a", "b").join(left, "b").join(right, "a")
    return joined.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long, s double")


def _leaders(members: DataFrame, many: int, round_: int) -> DataFrame:
    """(bucket, pick, pick_label): up to ``many`` members of every bucket, pre-aggregated before the shuffle.

    One order holds for all buckets of a round (the smallest ids in the first
    one), so that a pair that shares several buckets is met once.
    """
    order = F.col("id") if round_ == 1 else F.xxhash64("id", F.lit(round_))
    slot = F.pmod(F.xxhash64("id", F.lit(-round_)), F.lit(many)) if many > 1 else F.lit(0)
    best = members.groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct(order.alias("order"), "id", "label")).alias("best"))
    return best.select("bucket", F.col("best.id").alias("pick"), F.col("best.label").alias("pick_label"))


def _several_classes(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one class."""
    open_ = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
    # Written, so that the join is one of two plain shuffles, which AQE can split at a large bucket.
    return members.join(stored(open_.select("bucket"), "dart-open"), "bucket")


def linked_classes(docs: DataFrame, contents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, label): class of every content that shares a bucket, by content numbers.

    ``contents`` has a row of each content: its number ``id``, and the doc_id,
    text key ``t``, content keys and bands of a row that holds it.
    """
    rows = contents.select(F.explode("bands").alias("bucket"), "id")
    members = stored(_several_classes(rows.withColumn("label", F.col("id"))), "dart-buckets")
    wanted = contents.join(members.select("id").distinct(), "id").select("id", "doc_id", "t", "k1", "k2")
    items = stored(_item_sets(docs, wanted), "dart-items")
    labels = items.select("id", F.col("id").alias("label"))
    for round_ in range(1, ROUNDS + 1):
        if members.isEmpty():
            return labels
        chosen = stored(_leaders(members, round_, round_), "dart-leaders")
        met = members.join(chosen, "bucket").where("label != pick_label")
        pairs = met.select(F.least("pick", "id").alias("a"), F.greatest("pick", "id").alias("b")).distinct()
        found = stored(similarities(pairs, items).where(F.col("s") >= threshold), "dart-links")
        la, lb = (labels.select(F.col("id").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
        merged = _merged_labels(found.join(la, "a").join(lb, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
        labels = stored(_relabelled(labels, merged), "dart-labels")
        left = members.join(chosen.select("bucket", F.col("pick").alias("id")), ["bucket", "id"], "left_anti")
        members = stored(_several_classes(_relabelled(left, merged)), "dart-buckets")
    if members.isEmpty():
        return labels
    return stored(_relabelled(labels, _merged_labels(_block_links(members, items, threshold))), "dart-labels")


def _merged_labels(links: DataFrame) -> DataFrame:
    """(label, new): labels of linked classes (a, b) that are replaced."""
    merged = components(links, "dart-classes").where("id != label")
    return merged.select(F.col("id").alias("label"), F.col("label").alias("new"))


def _relabelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
    return rows.join(merged, "label", "left").select(*[F.coalesce("new", "label").alias(c) if c == "label" else c for c in rows.columns])


def _block_links(members: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(a, b): labels of classes of one bucket that a pair of their members links."""
    sized = members.join(items.select("id", F.octet_length("items").cast("long").alias("bytes")), "id")
    whole = sized.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("long")
    placed = members.join(stored(whole.select("bucket", blocks.alias("blocks")), "dart-blocks"), "bucket")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("id", "label", "block", "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def link(group: pa.Table) -> pa.Table:
        label = group.column("label").to_numpy()
        block = group.column("block").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("items")]
        size = np.array([len(x) for x in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        root = {x: x for x in label.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for i in np.flatnonzero(block == lo).tolist():
            begin = np.searchsorted(flat, sets[i], side="left")
            end = np.searchsorted(flat, sets[i], side="right")
            common = np.bincount(owner[T.ragged(begin, end - begin)], minlength=len(sets))
            near = common / np.maximum(size + size[i] - common, 1) >= threshold
            for j in np.flatnonzero(near & (block == hi) & (label != label[i])).tolist():
                x, y = find(int(label[i])), find(int(label[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return placed.join(items, "id").groupBy("bucket", "lo", "hi").applyInArrow(link, "a long, b long")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, k1, k2, t, class): a row for each row of ``docs``; class_id is the class's smallest doc_id.

    ``k1`` and ``k2`` are the hashes of the row's word sequence, ``t`` its text
    key.  Where rows of one doc_id are in several classes, that id names none
    of them as long as the class has another one.  ``class`` is a number that
    tells classes apart in any case; it may differ from run to run.
    """
    rows = stored(signed(docs), "dart-signed")
    known = rows.where(F.col("doc_id").isNotNull())
    # Numbered and written at once, so that a number stays the same content's whatever is computed again.
    contents = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")).withColumn("id", F.monotonically_increasing_id())
    contents = stored(contents, "dart-numbered")
    bands = known.join(contents, ["doc_id", "k1", "k2"]).dropDuplicates(["doc_id", "k1", "k2"])
    representatives = stored(bands.select("id", "doc_id", "t", "k1", "k2", "bands"), "dart-contents")
    label = linked_classes(docs, representatives, threshold)
    named = stored(contents.join(label, "id", "left").select("k1", "k2", "doc_id", F.coalesce("label", "id").alias("class")), "dart-classed")
    # Tables are written before joins for the same reason as above: a content or class that a third of the rows have
    # must not be one task's join.
    tops = stored(_class_ids(known, named), "dart-tops")
    named = stored(named.join(tops, "class").select("k1", "k2", "class", "class_id"), "dart-named")
    found = rows.select("doc_id", "t", "k1", "k2").join(named, ["k1", "k2"], "left")
    return found.select("doc_id", _known(F.col("class_id")).alias("class_id"), "k1", "k2", "t", _known(F.col("class")).alias("class"))


def _class_ids(known: DataFrame, named: DataFrame) -> DataFrame:
    """(class, class_id) of all classes."""
    keys = [f(k).alias(f.__name__ + k) for k in ("k1", "k2") for f in (F.min, F.max)]
    shared = known.groupBy("doc_id").agg(*keys).where("mink1 != maxk1 or mink2 != maxk2").select("doc_id")
    shared = stored(shared, "dart-shared")
    if shared.isEmpty():
        return named.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    placed = stored(known.select("doc_id", "k1", "k2").join(named.select("k1", "k2", "class"), ["k1", "k2"]).select("doc_id", "class"), "dart-placed")
    several = placed.join(shared, "doc_id").groupBy("doc_id").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi")
    several = stored(several.select("doc_id", F.lit(True).alias("several")), "dart-several")
    own = F.min(F.when(F.col("several").isNull(), F.col("doc_id")))
    return placed.join(several, "doc_id", "left").groupBy("class").agg(F.coalesce(own, F.min("doc_id")).alias("class_id"))


def _known(class_id: Column) -> Column:
    return F.when(F.col("doc_id").isNotNull(), class_id)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which one row of each class is left: the one with the smallest doc_id.

    Different texts under one doc_id are in classes of their own, unless they
    are near.  Of rows that repeat a doc_id and its text one stays; rows
    without doc_id stay.
    """
    found = classes(docs, threshold).where(F.col("doc_id").isNotNull())
    keep = found.groupBy("class").agg(F.min(F.struct("doc_id", "t")).alias("keep"))
    keep = keep.select(F.col("keep.doc_id").alias("keep_id"), F.col("keep.t").alias("keep_t")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    left = docs.select(F.col("doc_id").cast("long").alias("id"), _text_key().alias("t"), row)
    known = left.where(F.col("id").isNotNull()).join(keep, (F.col("id") == F.col("keep_id")) & (F.col("t") == F.col("keep_t")), "left_semi")
    first = Window.partitionBy("id", "t").orderBy(F.xxhash64("row.text"))
    known = known.withColumn("copy", F.row_number().over(first)).where("copy = 1").drop("copy")
    return known.unionByName(left.where(F.col("id").isNull())).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
