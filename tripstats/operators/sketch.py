"""Count-Min sketch kept as an ordinary table.

A sketch of width ``w`` and depth ``d`` is the cell table ``(d, b, c)``: for
every key inserted, each row ``d`` adds 1 to bucket ``b = (h1 + d*h2) mod w``
(see :mod:`tripstats.functions.hashing`).  Kept as a DataFrame the sketch is

* built by a grouped count -- partial aggregation holds at most ``w * d``
  groups per task, so task memory is bounded whatever the input size;
* mergeable by ``union`` + ``sum`` (sketches of months add up to the sketch
  of the year);
* queried by a join: keys x depth rows against the cells, ``min`` per key.
  The cell table is at most ``w * d`` rows, so it is broadcast if that many
  bytes are under the session's broadcast threshold.

Two hash families place a key: ``md5`` of its text with double hashing (any
SQL engine can rebuild the cells) and ``xxhash64`` of its values, one
independent hash for each row, several times cheaper and without any text.

Spark's native ``count_min_sketch`` aggregate is offered as well: a compact
binary artefact, cheaper to build, but it can only be read back through the
JVM on the driver, so estimates are taken from the cell table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket, digest_pair
from ..functions.keys import ColumnLike, as_column, key_part_text, key_text, seeded, value_columns
from ..schemas import DEFAULT_CMS_CONFIDENCE, DEFAULT_CMS_EPS, DEFAULT_CMS_SEED
from ..session import broadcast_threshold

HASHES = ("md5", "xxhash64")
CELL_BYTES = 32  # of one (int, int, bigint) row, generously


@dataclass(frozen=True)
class SketchParams:
    eps: float = DEFAULT_CMS_EPS
    confidence: float = DEFAULT_CMS_CONFIDENCE
    seed: int = DEFAULT_CMS_SEED
    hash: str = "md5"

    def __post_init__(self) -> None:
        if self.hash not in HASHES:
            raise ValueError(f"unknown hash {self.hash!r}; use one of {HASHES}")

    @property
    def label(self) -> str:
        """Name of this parameter set; only sketches of one label can be merged."""
        return f"{self.width}x{self.depth}-{self.hash}-{self.seed}"

    @property
    def width(self) -> int:
        return int(math.ceil(2.0 / self.eps))

    @property
    def depth(self) -> int:
        return int(math.ceil(-math.log(1.0 - self.confidence) / math.log(2.0)))

    @property
    def cells(self) -> int:
        return self.width * self.depth


def _rows_index(depth: int):
    return F.explode(F.sequence(F.lit(0), F.lit(depth - 1)))


def _hash_columns(keys: Sequence[Column], params: SketchParams) -> dict[str, Column]:
    """What has to be known of a key to find its cells."""
    if params.hash == "md5":
        h1, h2 = digest_pair(seeded(key_text(keys), params.seed))
        return {"_h1": h1, "_h2": h2}
    # Null flags keep ('a', null) and (null, 'a') apart: the hash skips nulls.
    flags = [k.isNull() for k in keys]
    return {"_h1": F.xxhash64(F.lit(params.seed), *keys, *flags)}


def _bucket_of(d: Column, params: SketchParams) -> Column:
    if params.hash == "md5":
        return bucket(F.col("_h1"), F.col("_h2"), d, params.width)
    return F.pmod(F.xxhash64(F.col("_h1"), d), F.lit(params.width)).cast("int")


def cms_cells(
    df: DataFrame,
    key_cols: Sequence[ColumnLike],
    params: SketchParams = SketchParams(),
    pre_group: bool = False,
    group_cols: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Build the cell table ``(group_cols..., d, b, c)`` of the keys of ``df``.

    ``pre_group=False`` hashes row by row; the aggregation state per task is
    at most ``depth * width`` cells.  ``pre_group=True`` counts each distinct
    key first and hashes every key once -- cheaper when keys repeat a lot,
    but its first aggregate holds the distinct keys.  The cells are the same.

    ``group_cols`` builds one sketch per group (e.g. per month) in one pass.
    ``weight`` names a column of pre-aggregated rows: a row inserts its key
    ``weight`` times.
    """
    weighted = [F.col(weight).cast("bigint").alias("_n")] if weight else []
    if pre_group:
        # Group on the key values themselves (no per-row text), then build
        # the key text once per distinct key.
        parts = [as_column(c).alias(f"_g{i}") for i, c in enumerate(key_cols)]
        total_n = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
        grouped = df.groupBy(*group_cols, *parts).agg(total_n.cast("bigint").alias("_n"))
        names = [f"_g{i}" for i in range(len(parts))]
        base, keys, weighted = grouped, value_columns(grouped, names), ["_n"]
    else:
        base, keys = df, value_columns(df, key_cols)
    carry = ["_n"] if (pre_group or weight) else []
    hashes = _hash_columns(keys, params)
    hashed = base.select(*group_cols, *weighted, *[c.alias(n) for n, c in hashes.items()])
    exploded = hashed.select(*group_cols, *carry, *hashes, _rows_index(params.depth).alias("d"))
    cell = [*group_cols, F.col("d").cast("int").alias("d"), _bucket_of(F.col("d"), params).alias("b")]
    total = F.sum("_n") if carry else F.count(F.lit(1))
    return exploded.groupBy(*cell).agg(total.cast("bigint").alias("c"))


def cms_cells_from_counts(
    counts: DataFrame,
    key_cols: Sequence[str],
    count_col: str,
    params: SketchParams = SketchParams(),
) -> DataFrame:
    """Cell table of a key multiset given as ``(keys..., count)`` rows.

    Each distinct key is hashed once and adds its count to its ``depth``
    cells -- the same cells as inserting every row.  Used where exact group
    counts of the same domain are computed anyway: Spark then shares the
    group-count exchange between the exact answer and the sketch.
    """
    hashes = _hash_columns(value_columns(counts, key_cols), params)
    hashed = counts.select(F.col(count_col).alias("_n"), *[c.alias(n) for n, c in hashes.items()])
    exploded = hashed.select("_n", *hashes, _rows_index(params.depth).alias("d"))
    cell = [F.col("d").cast("int").alias("d"), _bucket_of(F.col("d"), params).alias("b")]
    return exploded.groupBy(*cell).agg(F.sum("_n").cast("bigint").alias("c"))


def cms_merge(*cell_tables: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Merge sketches of the same parameters: cell-wise sum."""
    if not cell_tables:
        raise ValueError("nothing to merge")
    merged = cell_tables[0]
    for t in cell_tables[1:]:
        merged = merged.unionByName(t)
    return merged.groupBy(*group_cols, "d", "b").agg(F.sum("c").cast("bigint").alias("c"))


def cms_estimate(
    keys_df: DataFrame,
    key_cols: Sequence[str],
    cells: DataFrame,
    params: SketchParams = SketchParams(),
    out_col: str = "cms_estimated_count",
) -> DataFrame:
    """Add the point estimate ``min_d cells[d, bucket_d(key)]`` to each row.

    ``keys_df`` must have one row per key (e.g. a grouped result); all its
    columns are kept.  A key that was never inserted estimates to 0.
    """
    carry = list(keys_df.columns)
    # One projection for both halves (the digest is computed once per row by
    # subexpression elimination).  A single projection over a top-k keeps the
    # ``Limit(Project(Sort))`` shape that Spark plans as TakeOrderedAndProject.
    hashes = _hash_columns(value_columns(keys_df, key_cols), params)
    probes = keys_df.select(*carry, *[c.alias(n) for n, c in hashes.items()])
    probes = probes.select(*carry, *hashes, _rows_index(params.depth).alias("_d"))
    probes = probes.withColumn("_b", _bucket_of(F.col("_d"), params))
    side = cells.select(F.col("d").alias("_d"), F.col("b").alias("_b"), F.col("c").alias("_c"))
    if params.cells * CELL_BYTES <= broadcast_threshold(keys_df.sparkSession):
        side = F.broadcast(side)  # never more than width * depth rows
    joined = probes.join(side, ["_d", "_b"], "left")
    return joined.groupBy(*carry).agg(
        F.min(F.coalesce(F.col("_c"), F.lit(0))).cast("bigint").alias(out_col)
    )


def cms_native(
    df: DataFrame,
    key_cols: Sequence[ColumnLike],
    params: SketchParams = SketchParams(),
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Spark's ``count_min_sketch`` aggregate over the key text (binary).

    The aggregate refuses double columns, so the key is always given as
    text; one serialized sketch per group.  Partial sketches of a group meet
    in one task, each of ``8 * width * depth`` bytes for every task that holds
    the group, so build it for groups that are spread over few tasks (a
    month of a partitioned layer); for the whole of a large table use cells.
    """
    text = key_text(key_cols) if len(key_cols) > 1 else key_part_text(key_cols[0])
    return df.groupBy(*group_cols).agg(
        F.count_min_sketch(text, F.lit(params.eps), F.lit(params.confidence), F.lit(params.seed)).alias(
            "sketch"
        ),
        F.count(F.lit(1)).alias("total_count"),
    )
