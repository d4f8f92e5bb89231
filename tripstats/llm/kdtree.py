"""K-d tree partitioning of documents into shards of near equal bytes; DataFrame and SQL functions only.

Rows have a coordinate in each metadata dimension, one of :data:`CELLS` cells:
a number's root, scaled to the range of the whole table; of any other value the
first digits of its md5, so that equal names share a cell.  A node that stands
for n shards is split along the dimension in which its rows reach widest (max
cell less min cell; the first such dimension), at the weighted place that
leaves n // 2 of n parts of its bytes before it: the median where n is even.
Leaves stand for one shard each, so they have the target bytes.

The place is found by two grouped sums a level, for all nodes at once: bytes by
(node, dimension, cell), which give widths and the cell of the cut, then bytes
by block of the tie key inside that cell.  So a value that holds a third of all
rows is cut as well.  Both tables have a bounded number of rows a node (3 x 4096
and 65536); no row of the corpus is sorted, and none is shuffled before its
slot.  The order in a cell is that of md5(doc_id : crc32 of the text : copy),
copies of a row being numbered, so repeated rows can be cut too.  A cut falls
between blocks, where it comes nearest to the wanted bytes.

Slots number the rows of a shard by tie key: windows over 256 blocks of a shard
and a prefix table.

Defined results: null text has size 1 and the CRC-32 of nothing; a null name or
number counts as an empty name or 0, a negative one or NaN as 0; null doc_id as
an empty name in the tie key; an empty table has no shards; with fewer rows
than shards some shards stay empty; equal rows are exchangeable.  Shards depend
on the rows alone, not on files or partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .shared import stored

CELLS = 4096  # three hex digits
CELL_DIGITS = 3
BLOCK_DIGITS = 4
SLOT_DIGITS = 2
CHUNK_BITS = 16  # consecutive rows that are numbered in one window


@dataclass(frozen=True)
class KdTree:
    """Number of shards and the metadata dimensions, in the order that breaks equal widths."""

    shards: int = 16
    dimensions: tuple[str, ...] = ("lang", "source", "n_chars")


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """Number of leaves at which each has at most about ``target_bytes``."""
    return max(1, -(-total_bytes // target_bytes))


def _is_number(docs: DataFrame, name: str) -> bool:
    return isinstance(docs.schema[name].dataType, NumericType)


def _root(name: str) -> Column:
    number = F.nanvl(F.coalesce(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.sqrt(F.greatest(number, F.lit(0.0)))


def _coordinate(docs: DataFrame, name: str, ranges: dict[str, tuple[float, float]]) -> Column:
    if not _is_number(docs, name):
        digits = F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))
        return F.conv(F.substring(digits, 1, CELL_DIGITS), 16, 10).cast("int")
    low, high = ranges[name]
    if high <= low:
        return F.lit(0)
    return F.floor(F.lit(CELLS - 1.0) * (_root(name) - F.lit(low)) / F.lit(high - low)).cast("int")


def _coordinates(tree: KdTree) -> list[str]:
    return [f"c{i}" for i in range(len(tree.dimensions))]


def narrow(docs: DataFrame, tree: KdTree) -> DataFrame:
    """(doc_id, size, text_crc32, coordinates, name, row_no) of every row; ``name`` is equal for equal rows."""
    docs = docs.select("doc_id", "text", *[F.col(f"`{d}`") for d in tree.dimensions])
    numbers = [d for d in tree.dimensions if _is_number(docs, d)]
    ranges: dict[str, tuple[float, float]] = {}
    if numbers:
        ends = docs.agg(*[f(_root(d)) for d in numbers for f in (F.min, F.max)]).first()
        ranges = {d: (ends[2 * i] or 0.0, ends[2 * i + 1] or 0.0) for i, d in enumerate(numbers)}
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        *[_coordinate(docs, d, ranges).alias(c) for c, d in zip(_coordinates(tree), tree.dimensions)],
    )
    parts = ["doc_id", "text_crc32", "size", *_coordinates(tree)]
    name = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return stored(rows.withColumn("name", name).withColumn("row_no", F.monotonically_increasing_id()), "kd-rows")


def numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` without ``name`` and ``row_no``, with ``copy`` 0, 1, 2 … among rows of one name.

    Names that occur once need no number.  The others are numbered in chunks of
    2 ** 16 consecutive rows, and a name's chunks by a prefix over their counts.
    """
    columns = [c for c in rows.columns if c not in ("name", "row_no")]
    repeats = stored(rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "kd-repeats")
    if repeats.isEmpty():
        return rows.select(*columns, F.lit(0).cast("long").alias("copy"))
    once = rows.join(repeats, "name", "left_anti").select(*columns, F.lit(0).cast("long").alias("copy"))
    chunk = F.shiftright("row_no", CHUNK_BITS)
    again = stored(rows.join(repeats, "name", "left_semi").withColumn("chunk", chunk), "kd-repeated")
    counts = again.groupBy("name", "chunk").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("name").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("name", "chunk", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    inside = again.withColumn("at", F.row_number().over(Window.partitionBy("name", "chunk").orderBy("row_no")))
    numbered = inside.join(counts, ["name", "chunk"])
    return once.unionByName(numbered.select(*columns, (F.col("before") + F.col("at") - 1).alias("copy")))


def _tie() -> Column:
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.col("copy").cast("string")]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _chosen(tree: KdTree) -> Column:
    """The row's cell in the dimension of its node."""
    return F.element_at(F.array(*_coordinates(tree)), F.col("dimension") + 1)


def cell_cuts(rows: DataFrame, tree: KdTree) -> DataFrame:
    """For every node of more than one shard: its dimension, the last cell wholly on the left (or -1), the cell that
    the cut divides (or null), the bytes before that cell, and the node's bytes."""
    coordinates = F.array(*_coordinates(tree))
    spread = rows.where("n > 1").select("first", "n", "size", F.posexplode(coordinates).alias("dimension", "cell"))
    cells = spread.groupBy("first", "n", "dimension", "cell").agg(F.sum("size").alias("bytes"))
    whole = Window.partitionBy("first", "n", "dimension")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select(
        "*",
        (F.max("cell").over(whole) - F.min("cell").over(whole)).alias("width"),
        F.sum("bytes").over(whole).alias("total"),
        F.sum("bytes").over(upto).alias("behind"),
    )
    left = F.floor(F.col("n") / 2) * F.col("total")  # n times the bytes wanted on the left
    ends, begins = F.col("behind") * F.col("n"), (F.col("behind") - F.col("bytes")) * F.col("n")
    divided = (begins < left) & (left < ends)
    cuts = cells.groupBy("first", "n", "dimension", "width", "total").agg(
        F.coalesce(F.max(F.when(ends <= left, F.col("cell"))), F.lit(-1)).alias("last"),
        F.max(F.when(divided, F.col("cell"))).alias("cut"),
        F.coalesce(F.max(F.when(divided, F.col("behind") - F.col("bytes"))), F.lit(0)).alias("before"),
    )
    widest = Window.partitionBy("first", "n").orderBy(F.col("width").desc(), "dimension")
    return cuts.withColumn("place", F.row_number().over(widest)).where("place = 1").drop("place", "width")


def block_cuts(rows: DataFrame, cuts: DataFrame, tree: KdTree) -> DataFrame:
    """``cuts`` (first, dimension, last, cut) with the last block of the divided cell that goes left (or null)."""
    block = F.substring("tie", 1, BLOCK_DIGITS)
    inside = rows.join(F.broadcast(cuts), ["first", "n"]).where(_chosen(tree) == F.col("cut"))  # a row for each node
    blocks = inside.groupBy("first", "n", block.alias("block")).agg(
        F.sum("size").alias("bytes"), F.max("before").alias("before"), F.max("total").alias("total")
    )
    upto = Window.partitionBy("first").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    twice_middle = 2 * (F.col("before") + F.sum("bytes").over(upto)) - F.col("bytes")
    left = blocks.withColumn("left", twice_middle * F.col("n") < 2 * F.floor(F.col("n") / 2) * F.col("total")).where("left")
    last = left.groupBy("first", "n").agg(F.max("block").alias("block"))
    return cuts.join(last, ["first", "n"], "left").select("first", "n", "dimension", "last", "cut", "block")


def assigned(docs: DataFrame, tree: KdTree) -> DataFrame:
    """(doc_id, size, text_crc32, coordinates, tie, shard) of every row of ``docs``."""
    rows = numbered_copies(narrow(docs, tree)).withColumn("tie", _tie()).drop("copy")
    rows = stored(rows.select("*", F.lit(0).alias("first"), F.lit(tree.shards).alias("n")), "kd-level")
    for _ in range((tree.shards - 1).bit_length()):
        cuts = stored(cell_cuts(rows, tree), "kd-cells")
        splits = stored(block_cuts(rows, cuts, tree), "kd-splits")
        columns = [c for c in rows.columns if c not in ("first", "n")]
        held = F.col("block").isNotNull() & (_chosen(tree) == F.col("cut")) & (F.substring("tie", 1, BLOCK_DIGITS) <= F.col("block"))
        left = (_chosen(tree) <= F.col("last")) | held
        half = F.floor(F.col("n") / 2).cast("int")
        # At most one row for each node, nodes being at most as many as shards; leaves have none.
        placed = rows.join(F.broadcast(splits), ["first", "n"], "left").withColumn("left", F.coalesce(left, F.lit(True)))
        split = F.col("n") > 1
        rows = stored(
            placed.select(
                *columns,
                F.when(split & ~F.col("left"), F.col("first") + half).otherwise(F.col("first")).alias("first"),
                F.when(~split, F.col("n")).when(F.col("left"), half).otherwise(F.col("n") - half).alias("n"),
            ),
            "kd-level",
        )
    return rows.withColumnRenamed("first", "shard").drop("n")


def kd_shards(docs: DataFrame, tree: KdTree | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``; the law is ``bytes``."""
    tree = tree or KdTree()
    rows = assigned(docs, tree).withColumn("block", F.substring("tie", 1, SLOT_DIGITS))
    sizes = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "block", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    order = ["tie", "doc_id", "text_crc32", "size", *_coordinates(tree)]
    inside = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard", "block").orderBy(*order)))
    slots = inside.join(F.broadcast(sizes), ["shard", "block"])  # 256 rows a shard
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("at") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def kd_shards_sql(tree: KdTree | None = None, numbers: tuple[str, ...] = ("n_chars",)) -> str:
    """DuckDB SQL for :func:`kd_shards`: one sort of every node's rows instead of cells and blocks."""
    tree = tree or KdTree()
    cs, ds = _coordinates(tree), tree.dimensions
    roots = ", ".join(f"sqrt(greatest(coalesce({d}::DOUBLE, 0), 0)) AS r_{d}" for d in ds if d in numbers)
    cells = []
    for c, d in zip(cs, ds):
        if d in numbers:
            low, wide = f"min(r_{d}) OVER ()", f"(max(r_{d}) OVER () - min(r_{d}) OVER ())"
            cells.append(f"CASE WHEN {wide} > 0 THEN floor({CELLS - 1}.0::DOUBLE * (r_{d} - {low}) / {wide})::INTEGER ELSE 0 END AS {c}")
        else:
            cells.append(f"('0x' || substr(md5(coalesce({d}::VARCHAR, '')), 1, {CELL_DIGITS}))::INTEGER AS {c}")
    same = ", ".join(["doc_id", "text_crc32", "size", *cs])
    ctes = [
        """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
)""",
        f"raw AS (SELECT doc_id, {', '.join(ds)}, coalesce(text, '') AS text FROM documents)",
        "hexed AS (SELECT text, hex(encode(text)) AS x FROM (SELECT DISTINCT text FROM raw))",
        "bytes AS (SELECT text, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT) AS b FROM hexed)",
        """sums AS (
  SELECT text, xor(4294967295, list_reduce([4294967295::BIGINT] || b, lambda c, k: xor(tab[(xor(c, k) & 255) + 1], c >> 8)))::BIGINT AS text_crc32
  FROM bytes, crc
)""",
        f"sized AS (SELECT doc_id, {', '.join(ds)}, (octet_length(encode(text)) + 1)::BIGINT AS size, text_crc32{', ' + roots if roots else ''} FROM raw JOIN sums USING (text))",
        f"celled AS (SELECT doc_id, size, text_crc32, {', '.join(cells)} FROM sized)",
        f"copied AS (SELECT *, row_number() OVER (PARTITION BY {same}) - 1 AS copy FROM celled)",
        f"t0 AS (SELECT {same}, md5(coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || copy) AS tie, 0 AS first, {tree.shards} AS n FROM copied)",
    ]
    for level in range((tree.shards - 1).bit_length()):
        widths = [f"max({c}) OVER node - min({c}) OVER node" for c in cs]
        widest = f"greatest({', '.join(widths)})"
        cell = " ".join(f"WHEN {w} = {widest} THEN {c}" for w, c in zip(widths, cs))
        ctes += [
            f"w{level} AS (SELECT *, CASE {cell} END AS cell, substr(tie, 1, {BLOCK_DIGITS}) AS block FROM t{level} WINDOW node AS (PARTITION BY first))",
            f"b{level} AS (SELECT *, sum(size) OVER (PARTITION BY first ORDER BY cell, block) AS upto, "
            f"sum(size) OVER (PARTITION BY first, cell, block) AS own, sum(size) OVER (PARTITION BY first) AS total FROM w{level})",
            f"t{level + 1} AS (SELECT * EXCLUDE (cell, block, upto, own, total, first, n, on_left), "
            "CASE WHEN n > 1 AND NOT on_left THEN first + n // 2 ELSE first END AS first, "
            "CASE WHEN n = 1 THEN 1 WHEN on_left THEN n // 2 ELSE n - n // 2 END AS n "
            f"FROM (SELECT *, (2 * upto - own) * n < 2 * (n // 2) * total AS on_left FROM b{level}))",
        ]
    last = (tree.shards - 1).bit_length()
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, size, text_crc32, 'bytes' AS law, first::INTEGER AS shard, "
        f"(row_number() OVER (PARTITION BY first ORDER BY tie, doc_id, text_crc32, size, {', '.join(cs)}) - 1)::BIGINT AS slot, "
        f"NULL::INTEGER AS grown_shard FROM t{last}"
    )
