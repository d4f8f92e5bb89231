"""Shortest-pack-first packing of token sequences over their length histogram.

1. Every document is tokenised (one pass; only lengths and checksums are kept).
   It is cut into full sequences of ``max_tokens`` and a tail.
2. The tails' length histogram (at most ``max_tokens`` rows, whatever the
   corpus) is packed on the driver: lengths are placed longest first, each
   into the emptiest pack with room for it, by counts of packing patterns and
   not one by one.
3. Patterns that leave more than ``max_gap`` tokens of padding are dissolved:
   their packs are laid end to end and that stream is cut every
   ``max_tokens``; its rest is cut into powers of two, which need no padding.
4. Patterns are joined back to documents by rank within a tail length.  Ranks
   are counted in salted groups with a small prefix table above them, so a
   length that a third of all documents share is not one task's work.

A null text is an empty one; its only token is the end id.  Rows are told
apart by ``doc_id`` and text; equal rows are packed once each.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import stored

MAX_TOKENS = 4096
MAX_GAP = 20  # at most 0.5 % padding in a pack that is kept as it is
END_ID = 2
CACHE_WORDS = 1_000_000  # words whose ids a Python worker remembers
ENCODE_WORDS = 1_000
LEARN_WORDS = 50_000


class WordTokenizer:
    """Ids of whole texts, with the ids of single words remembered.

    The vocabulary's own rules drop white space and never join what stands on
    both sides of it, so a text's ids are those of its words in a row.
    """

    _by_path: dict[str, WordTokenizer] = {}  # one in each Python worker

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found, sizes = [self.ids], []
        for at in range(0, len(words), ENCODE_WORDS):  # an encoding is much larger than its ids, and so is a list of them
            batch = [e.ids for e in self.tokenizer.encode_batch_fast(words[at : at + ENCODE_WORDS], add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in batch], np.int32))
            found.append(np.fromiter((i for x in batch for i in x), np.uint32, int(sizes[-1].sum())))
        counts = np.concatenate(sizes)
        starts = len(self.ids) + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.ids = np.concatenate(found)
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.counts = np.concatenate([self.counts, counts])[order]

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``, and the number of ids before each text."""
        start, end, first = T.word_spans(raw, offsets)
        kinds, at, which = np.unique(T.span_hashes(raw, start, end), return_index=True, return_inverse=True)
        if len(self.hashes) + len(kinds) > CACHE_WORDS:
            self.clear()
        place = np.searchsorted(self.hashes, kinds)
        known = np.zeros(len(kinds), dtype=bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == kinds[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            data = raw.tobytes()
            for lo in range(0, len(new), LEARN_WORDS):
                part = new[lo : lo + LEARN_WORDS]
                self._learn(kinds[part], [data[s:e].decode() for s, e in zip(start[at[part]].tolist(), end[at[part]].tolist())])
            del data
            place = np.searchsorted(self.hashes, kinds)
        ids = np.append(self.ids, np.uint32(end_id))
        starts = np.insert(self.starts[place][which], first[1:], len(self.ids))
        counts = np.insert(self.counts[place][which], first[1:], 1)
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids[T.ragged(starts, counts)].astype("<u4"), before[first + np.arange(len(first))]


LENGTH_SCHEMA = "doc_id long, text_key long, doc_tokens long, chunk_crcs array<long>, tail int, tail_crc long"


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def token_lengths(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Per row: number of ids, and CRC-32 of every full chunk and of the tail.  A narrow map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer.of(vocabulary)
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                ids, first = encoder.encode(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
                chunks, tails, tail_crcs = [], [], []
                for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                    whole = lo + (hi - lo) // max_tokens * max_tokens
                    chunks.append([zlib.crc32(ids[i : i + max_tokens]) for i in range(lo, whole, max_tokens)])
                    tails.append(hi - whole)
                    tail_crcs.append(zlib.crc32(ids[whole:hi]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(chunks, pa.list_(pa.int64())),
                        pa.array(tails, pa.int32()),
                        pa.array(tail_crcs, pa.int64()),
                    ],
                    names=["doc_id", "text_key", "doc_tokens", "chunk_crcs", "tail", "tail_crc"],
                )

    return _keyed(docs).mapInArrow(run, LENGTH_SCHEMA)


@dataclass
class Pattern:
    """``count`` packs of the same lengths: ``runs`` of (length, how many), longest first."""

    count: int
    runs: list[tuple[int, int]]

    @property
    def used(self) -> int:
        return sum(length * many for length, many in self.runs)


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[Pattern]:
    """Packing patterns of a length histogram, by counts.

    Lengths go longest first; each is put into the packs with the most room
    left, as many packs of a pattern at a time as there are, and into new
    packs only when no open pack has room.
    """
    room: list[int] = []  # heap of the negated rooms with open patterns
    open_packs: dict[int, list[Pattern]] = {}
    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        left = histogram[length]
        while left:
            while room and not open_packs.get(-room[0]):
                open_packs.pop(-heapq.heappop(room), None)
            if room and -room[0] >= length:
                space = -room[0]
                pattern = open_packs[space].pop()
                many = min(left, pattern.count)
                if many < pattern.count:
                    open_packs[space].append(Pattern(pattern.count - many, pattern.runs))
                runs = list(pattern.runs)
                if runs[-1][0] == length:
                    runs[-1] = (length, runs[-1][1] + 1)
                else:
                    runs.append((length, 1))
                grown, space = Pattern(many, runs), space - length
            else:
                many, grown, space = left, Pattern(left, [(length, 1)]), max_tokens - length
            left -= many
            if space not in open_packs:
                open_packs[space] = []
                heapq.heappush(room, -space)
            open_packs[space].append(grown)
    return [p for space in sorted(open_packs) for p in open_packs[space]]


@dataclass
class Layout:
    """Where the document of a rank goes, for every tail length; a few arrays, sorted by key.

    ``key`` is ``length << 44 | first rank``; of ``per_pack`` documents in a
    row each pack takes that many.  Kept patterns give a sequence and an
    offset, dissolved ones a position in the stream.
    """

    key: np.ndarray
    per_pack: np.ndarray
    base: np.ndarray  # first sequence of a kept pattern, first position of a dissolved one
    step: np.ndarray  # 1, or the length of a dissolved pack
    offset: np.ndarray
    dissolved: np.ndarray
    packed: int  # sequences of kept patterns
    stream: int  # tokens of dissolved packs
    stream_cuts: np.ndarray  # positions at which the stream's sequences begin, and its end
    class_base: dict[int, int]  # documents with a smaller tail


def _is_power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


def layout(histogram: dict[int, int], max_tokens: int = MAX_TOKENS, max_gap: int = MAX_GAP) -> Layout:
    """Patterns of the histogram's positive lengths, and the ranks that go to each."""
    patterns = shortest_pack_first({n: c for n, c in histogram.items() if n > 0}, max_tokens)
    next_rank = dict.fromkeys(histogram, 0)
    rows: list[tuple[int, int, int, int, int, bool]] = []
    packed = stream = 0
    for p in patterns:
        gap = max_tokens - p.used
        dissolve = gap > max_gap and not _is_power_of_two(p.used)
        offset = 0
        for length, many in p.runs:
            rows.append((length << 44 | next_rank[length], many, stream if dissolve else packed, p.used if dissolve else 1, offset, dissolve))
            next_rank[length] += many * p.count
            offset += length * many
        if dissolve:
            stream += p.used * p.count
        else:
            packed += p.count
    whole = stream // max_tokens * max_tokens
    rest = [1 << bit for bit in range(max_tokens.bit_length(), -1, -1) if (stream - whole) >> bit & 1]
    cuts = np.concatenate([np.arange(0, whole, max_tokens), whole + np.cumsum([0, *rest])]).astype(np.int64)
    class_base, total = {}, 0
    for length in sorted(histogram):
        class_base[length] = total
        total += histogram[length]
    rows.sort()
    key, per_pack, base, step, offsets, dissolved = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 6
    return Layout(key, per_pack, base, step, offsets, dissolved.astype(bool), packed, stream, cuts, class_base)


def _ranked(lengths: DataFrame, salts: int) -> DataFrame:
    """``lengths`` with ``rank``, 0-based within a tail length."""
    salted = lengths.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(salts)))
    own = Window.partitionBy("tail", "salt").orderBy("doc_id", "text_key")
    counts = salted.groupBy("tail", "salt").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("tail").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tail", "salt", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    return (
        salted.withColumn("local", F.row_number().over(own) - 1)
        .join(before, ["tail", "salt"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .drop("salt", "before", "local")
    )


PIECE_SCHEMA = (
    "doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _place(ranked: DataFrame, plan: Layout, max_tokens: int, most_chunks: int) -> DataFrame:
    """The pieces of every document; ``ids_crc32`` is null where a tail is cut."""
    stream_base = plan.packed
    chunk_base = stream_base + len(plan.stream_cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.tidied(batches):
            get = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc_tokens", "tail", "tail_crc", "rank")}
            tail, rank, n = get["tail"].astype(np.int64), get["rank"].astype(np.int64), batch.num_rows
            row, start, length, crc, sequence, offset = ([] for _ in range(6))

            # Full chunks are sequences of their own.
            chunks = batch.column("chunk_crcs").combine_chunks() if isinstance(batch.column("chunk_crcs"), pa.ChunkedArray) else batch.column("chunk_crcs")
            counts = get["doc_tokens"] // max_tokens
            number = T.ragged(np.zeros(n, np.int64), counts)
            whole = np.repeat(np.arange(n), counts)
            bases = np.array([plan.class_base[t] for t in tail.tolist()], np.int64)
            row.append(whole)
            start.append(number * max_tokens)
            length.append(np.full(len(whole), max_tokens))
            crc.append(chunks.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            sequence.append(chunk_base + (bases + rank)[whole] * most_chunks + number)
            offset.append(np.zeros(len(whole), np.int64))

            # Tails go where their rank says.
            with_tail = np.flatnonzero(tail > 0)
            t, r = tail[with_tail], rank[with_tail]
            at = np.searchsorted(plan.key, t << 44 | r, side="right") - 1
            local = r - (plan.key[at] & ((1 << 44) - 1))
            pack, slot = local // plan.per_pack[at], local % plan.per_pack[at]
            where = plan.offset[at] + slot * t
            tail_start = get["doc_tokens"][with_tail] - t
            crcs = get["tail_crc"][with_tail].astype(np.int64)
            kept = ~plan.dissolved[at]
            row.append(with_tail[kept])
            start.append(tail_start[kept])
            length.append(t[kept])
            crc.append(crcs[kept])
            sequence.append((plan.base[at] + pack)[kept])
            offset.append(where[kept])

            # Tails of dissolved packs lie in the stream, cut wherever a sequence begins.
            loose = np.flatnonzero(~kept)
            begin = (plan.base[at] + pack * plan.step[at] + where)[loose]
            end = begin + t[loose]
            lo = np.searchsorted(plan.stream_cuts, begin, side="right") - 1
            hi = np.searchsorted(plan.stream_cuts, end, side="left")
            cut = T.ragged(lo, hi - lo)
            piece = np.repeat(np.arange(len(loose)), hi - lo)
            from_ = np.maximum(begin[piece], plan.stream_cuts[cut])
            to = np.minimum(end[piece], plan.stream_cuts[np.minimum(cut + 1, len(plan.stream_cuts) - 1)])
            row.append(with_tail[loose][piece])
            start.append(tail_start[loose][piece] + from_ - begin[piece])
            length.append(to - from_)
            crc.append(np.where((hi - lo)[piece] == 1, crcs[loose][piece], -1))
            sequence.append(stream_base + cut)
            offset.append(from_ - plan.stream_cuts[cut])

            row_, crc_ = np.concatenate(row).astype(np.int64), np.concatenate(crc)
            take = pa.array(row_)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_key").take(take),
                    pa.array(np.concatenate(start), pa.int64()),
                    pa.array(np.concatenate(length), pa.int64()),
                    pa.array(crc_, pa.int64(), mask=crc_ < 0),
                    pa.array(get["doc_tokens"][row_], pa.int64()),
                    pa.array(np.concatenate(sequence), pa.int64()),
                    pa.array(np.concatenate(offset), pa.int64()),
                ],
                names=[p.split()[0] for p in PIECE_SCHEMA.split(", ")],
            )

    return ranked.mapInArrow(run, PIECE_SCHEMA)


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text_key, text, cuts) of the documents of ``wanted`` (doc_id, text_key, cuts)."""
    return _keyed(docs).join(
        wanted.withColumnRenamed("doc_id", "cut_id").withColumnRenamed("text_key", "cut_key"),
        F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("text_key") == F.col("cut_key")),
    ).select("doc_id", "text_key", "text", "cuts")


def sequences(docs: DataFrame, pieces: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from the texts and the pieces of :func:`pack`.

    A sequence gathers at most ``max_tokens`` ids.  Rows that are equal in
    doc_id and text are packed once each and read once.
    """
    wanted = pieces.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    texts = _with_texts(docs, wanted).dropDuplicates(["doc_id", "text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer.of(vocabulary)
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                ids, first = encoder.encode(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
                cuts = batch.column(3).slice(a, b - a)
                flat = cuts.flatten()
                start, length, sequence, offset = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
                begin = np.repeat(first[:-1], cuts.value_lengths().to_numpy(zero_copy_only=False)) + start
                values = pa.array(ids[T.ragged(begin, length)].astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pa.array(sequence), pa.array(offset), lists], names=["sequence_id", "offset", "ids"])

    found = texts.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    parts = found.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def _cut_crcs(cut: DataFrame, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Checksums of the pieces of cut tails, from the texts of those documents alone."""
    wanted = cut.select("doc_id", "text_key", "start", "length").distinct()
    wanted = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "length")).alias("cuts"))
    joined = _with_texts(docs, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer.of(vocabulary)
        for batch in T.tidied(batches):
            raw, offsets = T.string_buffer(batch.column(2))
            for a, b in T.slices(offsets):
                ids, first = encoder.encode(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
                part, rows = batch.slice(a, b - a), []
                for doc, key, cuts, at in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist(), first.tolist()):
                    for c in cuts:
                        lo = at + c["start"]
                        rows.append((doc, key, c["start"], c["length"], zlib.crc32(ids[lo : lo + c["length"]])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5,
                    names=["doc_id", "text_key", "start", "length", "crc"],
                )

    return joined.mapInArrow(run, "doc_id long, text_key long, start long, length long, crc long").distinct()


def pack(
    docs: DataFrame,
    vocabulary: str,
    max_tokens: int = MAX_TOKENS,
    max_gap: int = MAX_GAP,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, text_key): every piece of every row.

    ``text_key`` is the hash of the row's text; :func:`sequences` makes the sequences of ids from the pieces.
    """
    lengths = stored(token_lengths(docs, vocabulary, max_tokens, end_id), "packing-lengths")
    facts = lengths.groupBy("tail").agg(F.count(F.lit(1)).alias("n"), F.max("doc_tokens").alias("most")).collect()
    histogram = {r["tail"]: r["n"] for r in facts}
    most_chunks = max((r["most"] for r in facts), default=0) // max_tokens + 1
    plan = layout(histogram, max_tokens, max_gap)
    salts = max(1024, sum(histogram.values()) // 250_000)
    pieces = stored(_place(_ranked(lengths, salts), plan, max_tokens, most_chunks), "packing-pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "text_key"]
    cut = pieces.where(F.col("ids_crc32").isNull())
    crcs = _cut_crcs(cut, docs, vocabulary, end_id).select(*[F.col(c).alias(f"c_{c}") for c in ("doc_id", "text_key", "start", "length", "crc")])
    matched = cut.join(
        crcs,
        F.col("doc_id").eqNullSafe(F.col("c_doc_id"))
        & (F.col("text_key") == F.col("c_text_key"))
        & (F.col("start") == F.col("c_start"))
        & (F.col("length") == F.col("c_length")),
    ).withColumn("ids_crc32", F.col("c_crc"))
    return pieces.where(F.col("ids_crc32").isNotNull()).select(*names).unionByName(matched.select(*names))
