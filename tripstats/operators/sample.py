"""Uniform samples whose content does not depend on partitioning.

``orderBy(rand(seed)).limit(k)`` draws a different sample when the input is
split differently.  Here every row gets a 60-bit rank from ``md5`` of its
identifying key (with a seed prefix), and the sample is the ``k`` rows of
smallest rank -- a bottom-k sample, uniform without replacement, with the same
output distribution as a reservoir sample.

Scale: a plain ``orderBy(rank).limit(k)`` lets every task send its best ``k``
rows to the one task that merges them -- ``tasks * k`` rows, too many on a
large cluster.  So rows are first pre-filtered to ``rank < T`` where ``T`` is
chosen from the population size ``N`` so that about ``k + 8 sqrt(k) + 64``
rows pass (at least ``k`` except with probability below 1e-15); only those
reach the final top-k merge.  The sample is then written once to the shared
checkpoint folder and its row count checked: if fewer than ``min(k, N)`` rows
passed, the pass is redone without the pre-filter, so the result is always
exact.  The written sample also cuts the lineage -- later queries read ``k``
rows, not the plan that chose them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import RANK_BITS, RANK_SPACE, rank_hash, rank_threshold
from ..functions.keys import ColumnLike, as_column, key_text, seeded, value_columns
from ..schemas import DEFAULT_SAMPLE_SEED
from ..session import fresh_path

_RANK = "_tripstats_rank"
_TIE = "_tripstats_tie"


@dataclass(frozen=True)
class Sample:
    """Sample rows plus the population and sample sizes behind them."""

    rows: DataFrame
    population: int
    size: int

    @property
    def factor(self) -> float:
        """Horvitz-Thompson scale ``N / n``; 1.0 for an empty sample."""
        return self.population / self.size if self.size > 0 else 1.0


def sample_rank(key_cols: Sequence[ColumnLike], seed: int = DEFAULT_SAMPLE_SEED) -> Column:
    """The rank of a row (hex digest text); ``key_cols`` must identify the row."""
    return rank_hash(seeded(key_text(key_cols), seed))


RANK_METHODS = ("md5", "xxhash64")


def _with_rank(df: DataFrame, key_cols: Sequence[ColumnLike], seed: int, method: str = "md5") -> DataFrame:
    """Add the rank and a tie-breaker.

    ``md5``: the digest of the key text (portable: any SQL engine with md5
    reproduces it).  ``xxhash64``: Spark's 64-bit hash of the key values with
    the seed and null flags mixed in -- no text is built, an order of
    magnitude cheaper per row, Spark-only; ties are broken by a second hash.
    """
    if method == "md5":
        text = seeded(key_text(key_cols), seed)
        return df.withColumn(_RANK, rank_hash(text)).withColumn(_TIE, text)
    if method == "xxhash64":
        cols = [as_column(c) for c in key_cols]
        flags = [c.isNull() for c in cols]
        return df.withColumn(_RANK, F.xxhash64(F.lit(seed), *cols, *flags)).withColumn(
            _TIE, F.xxhash64(F.lit(~seed), *cols, *flags)
        )
    raise ValueError(f"unknown rank method {method!r}; use one of {RANK_METHODS}")


def _rank_filter(threshold: int, method: str) -> Column:
    """``rank < threshold`` with ``threshold`` given in the 60-bit space."""
    if method == "md5":
        return F.col(_RANK) < F.lit(rank_threshold(threshold))
    # xxhash64 ranks span the signed 64-bit range
    return F.col(_RANK) < F.lit(-(1 << 63) + (threshold << 4))


def prefilter_threshold(size: int, population: int) -> int:
    """Rank threshold that keeps ``size`` rows out of ``population`` with a
    margin of 8 standard deviations (``RANK_SPACE``: keep everything)."""
    if population <= 0 or size >= population:
        return RANK_SPACE
    expected = size + 8.0 * math.sqrt(size) + 64.0
    if expected >= population:
        return RANK_SPACE
    return int(math.ceil(expected / population * float(RANK_SPACE)))


def _bottom(ranked: DataFrame, size: int, threshold: int, method: str = "md5") -> DataFrame:
    kept = ranked if threshold >= RANK_SPACE else ranked.where(_rank_filter(threshold, method))
    return kept.orderBy(_RANK, _TIE).limit(size).drop(_RANK, _TIE)


def sample_bottom_k(
    df: DataFrame,
    k: int,
    key_cols: Sequence[ColumnLike],
    seed: int = DEFAULT_SAMPLE_SEED,
    path: str | None = None,
    population: int | None = None,
    method: str = "md5",
) -> Sample:
    """The ``min(k, N)`` rows of smallest rank, written to ``path``.

    ``key_cols`` must be unique per row (use all columns, or a key plus an
    occurrence number); rows sharing a key share a rank and would enter the
    sample together.  ``path`` defaults to a fresh folder under the shared
    checkpoint folder; ``population`` may be passed when already known (for a
    plain Parquet scan ``count()`` reads only file footers).  ``method``
    chooses the rank hash (see :func:`_with_rank`).
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    spark = df.sparkSession
    if population is None:
        population = df.count()
    size = min(k, population)
    if path is None:
        path = fresh_path(spark, "sample")
    ranked = _with_rank(df, key_cols, seed, method)
    rows = _written_bottom(ranked, size, population, method, path)
    return Sample(rows=rows, population=population, size=size)


def _written_bottom(ranked: DataFrame, size: int, population: int, method: str, path: str) -> DataFrame:
    """The ``size`` rows of smallest rank, written to ``path`` (pre-filtered, checked, redone if need be)."""
    spark = ranked.sparkSession
    threshold = prefilter_threshold(size, population)
    _bottom(ranked, size, threshold, method).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    if threshold < RANK_SPACE and rows.count() < size:
        # Fewer than ``size`` rows under the threshold (p < 1e-15): redo the
        # pass over all rows, beside the first try.
        path = f"{path}-redo"
        _bottom(ranked, size, RANK_SPACE, method).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path)
    return rows


# Copy numbers that one row is spread into at a time; a content with more
# copies is split over several rows (and tasks) first.
COPIES_PER_CHUNK = 1 << 16


def sample_content_k(
    df: DataFrame,
    k: int,
    seed: int = DEFAULT_SAMPLE_SEED,
    path: str | None = None,
    method: str = "xxhash64",
) -> Sample:
    """``min(k, N)`` rows of smallest rank, a row's identity being its content.

    A row is ranked by the hash of all its columns and its copy number
    (0, 1, ... among equal rows), so the sample depends on nothing but the
    rows and the seed: not on files, their names, or partitions.  Copies get
    ranks of their own, so a row with many copies enters in proportion.

    1. Equal rows are counted by hash (combined before the shuffle).
    2. Each content's copies are ranked, in chunks of bounded size, and the
       ``k`` smallest ranks are chosen: at most ``k`` hashes.
    3. Those hashes are joined back to the rows; one row of each content is
       kept and repeated as often as it was chosen.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    if method not in RANK_METHODS:
        raise ValueError(f"unknown rank method {method!r}; use one of {RANK_METHODS}")
    spark = df.sparkSession
    path = path or fresh_path(spark, "sample")
    values = value_columns(df, df.columns)
    if method == "md5":
        identity = {"_id": F.md5(key_text(values))}
    else:
        flags = [c.isNull() for c in values]
        identity = {"_id": F.xxhash64(F.lit(1), *values, *flags), "_id2": F.xxhash64(F.lit(2), *values, *flags)}
    ids = list(identity)
    counted = df.select(*[c.alias(n) for n, c in identity.items()]).groupBy(*ids).agg(F.count(F.lit(1)).alias("_n"))
    counted.write.mode("overwrite").parquet(f"{path}-contents")
    counted = spark.read.parquet(f"{path}-contents")
    population = int(counted.agg(F.sum("_n")).first()[0] or 0)
    size = min(k, population)
    many = F.col("_n") > COPIES_PER_CHUNK
    chunk = F.lit(COPIES_PER_CHUNK)
    single = counted.where(~many).select(*ids, "_n", F.lit(0).cast("bigint").alias("_from"))
    split = counted.where(many).select(*ids, "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, chunk)).alias("_from"))
    parts = single.unionByName(split.repartition("_id", "_from"))
    last = F.least(F.col("_from") + chunk, F.col("_n")) - 1
    copies = parts.select(*ids, F.explode(F.sequence(F.col("_from"), last)).alias("_copy"))
    ranked = _with_rank(copies, [*ids, "_copy"], seed, method)
    chosen = _written_bottom(ranked, size, population, method, f"{path}-chosen").groupBy(*ids).agg(F.count(F.lit(1)).alias("_times"))
    # At most k rows; Spark broadcasts them if they are small enough.
    rows = df.select(F.struct(*df.columns).alias("_row"), *[c.alias(n) for n, c in identity.items()]).join(chosen, ids)
    rows = rows.groupBy(*ids).agg(F.min("_row").alias("_row"), F.max("_times").alias("_times"))
    rows = rows.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select("_row.*")
    rows.write.mode("overwrite").parquet(path)
    return Sample(rows=spark.read.parquet(path), population=population, size=size)


# Columns that a sample state has beside those of the rows.
STATE_RANK = "sample_rank"
STATE_TIE = "sample_tie"
STATE_POPULATION = "stratum_population"
STATE_COLUMNS = (STATE_RANK, STATE_TIE, STATE_POPULATION)


def sample_states(
    df: DataFrame,
    k: int,
    group_cols: Sequence[str],
    seed: int = DEFAULT_SAMPLE_SEED,
    path: str | None = None,
    method: str = "xxhash64",
) -> DataFrame:
    """The ``min(k, N)`` rows of smallest content rank of every group, with rank, tie-breaker and the group's size.

    Ranks are those of :func:`sample_content_k`.  If equal rows always share a
    group (the group columns are columns of ``df``), the ``k`` smallest ranks
    of several groups' states are the ``k`` smallest of all their rows: states
    of months merge into the sample of the months, see :func:`merge_states`.

    One pass for all groups; a group's cut reads about ``k + 8 sqrt(k) + 64``
    rows, by a threshold of its own.  There are few groups (months).
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if method not in RANK_METHODS:
        raise ValueError(f"unknown rank method {method!r}; use one of {RANK_METHODS}")
    spark = df.sparkSession
    path = path or fresh_path(spark, "sample-state")
    groups = list(group_cols)
    counted, identity = _counted_contents(df, groups, method)
    ids = list(identity)
    counted.write.mode("overwrite").parquet(f"{path}-contents")
    counted = spark.read.parquet(f"{path}-contents")
    sizes = [tuple(r) for r in counted.groupBy(*groups).agg(F.sum("_n").cast("bigint")).collect()]  # a row a group
    ranked = _with_rank(_copies(counted, [*groups, *ids]), [*ids, "_copy"], seed, method)
    chosen = _written_states(ranked, k, groups, sizes, {*map(tuple, (r[:-1] for r in sizes))}, method, f"{path}-chosen")
    short = _short_groups(chosen, k, groups, sizes)
    if short:  # p < 1e-15 a group: cut those again, without thresholds
        chosen = _written_states(ranked, k, groups, sizes, set(), method, f"{path}-chosen-redo")
    # At most k contents a group; equal rows are alike, so one of each content is kept.
    rows = df.select(F.struct(*df.columns).alias("_row"), *[c.alias(n) for n, c in identity.items()])
    rows = rows.join(chosen.select(*ids).distinct(), ids, "left_semi").groupBy(*ids).agg(F.min("_row").alias("_row"))
    picked = chosen.select(*ids, F.col(_RANK).alias(STATE_RANK), F.col(_TIE).alias(STATE_TIE), STATE_POPULATION)
    return rows.join(picked, ids).select("_row.*", *STATE_COLUMNS)


def _counted_contents(df: DataFrame, groups: list[str], method: str) -> tuple[DataFrame, dict[str, Column]]:
    """(groups, identity of a row's content, ``_n`` equal rows), and the identity's columns."""
    values = value_columns(df, df.columns)
    if method == "md5":
        identity = {"_id": F.md5(key_text(values))}
    else:
        flags = [c.isNull() for c in values]
        identity = {"_id": F.xxhash64(F.lit(1), *values, *flags), "_id2": F.xxhash64(F.lit(2), *values, *flags)}
    ids = [c.alias(n) for n, c in identity.items()]
    return df.select(*groups, *ids).groupBy(*groups, *identity).agg(F.count(F.lit(1)).alias("_n")), identity


def _copies(counted: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each copy (``_copy`` 0, 1, ...) of counted contents; many copies are spread over several tasks."""
    once = counted.where("_n = 1").select(*keep, F.lit(0).cast("bigint").alias("_copy"))
    chunk = F.lit(COPIES_PER_CHUNK)
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, chunk)).alias("_from")
    again = counted.where("_n > 1").select(*keep, "_n", starts)
    many = again.where(F.col("_n") > COPIES_PER_CHUNK).repartition(*keep, "_from")
    again = again.where(F.col("_n") <= COPIES_PER_CHUNK).unionByName(many)
    last = F.least(F.col("_from") + chunk, F.col("_n")) - 1
    return once.unionByName(again.select(*keep, F.explode(F.sequence(F.col("_from"), last)).alias("_copy")))


def _written_states(
    ranked: DataFrame, k: int, groups: list[str], sizes: list[tuple], filtered: set[tuple], method: str, path: str
) -> DataFrame:
    """The smallest ranks of every group, written; groups in ``filtered`` are cut by a threshold before they are sorted."""
    spark = ranked.sparkSession
    cuts = []
    for *group, n in sizes:
        threshold = prefilter_threshold(min(k, n), n) if tuple(group) in filtered else RANK_SPACE
        limit = None if threshold >= RANK_SPACE else rank_threshold(threshold) if method == "md5" else -(1 << 63) + (threshold << 4)
        cuts.append((*group, limit, n))
    fields = [ranked.schema[g] for g in groups]
    renamed = [T.StructField(f"_g{i}", f.dataType) for i, f in enumerate(fields)]
    limit_type = T.StringType() if method == "md5" else T.LongType()
    schema = T.StructType([*renamed, T.StructField("_limit", limit_type), T.StructField(STATE_POPULATION, T.LongType())])
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    # One row a group.
    kept = ranked.join(F.broadcast(spark.createDataFrame(cuts, schema)), same).where(F.col("_limit").isNull() | (F.col(_RANK) < F.col("_limit")))
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(_RANK, _TIE))
    kept = kept.withColumn("_place", place).where(F.col("_place") <= k).drop("_place", "_limit", *[f.name for f in renamed])
    kept.write.mode("overwrite").parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def _short_groups(chosen: DataFrame, k: int, groups: list[str], sizes: list[tuple]) -> bool:
    found = {tuple(r[:-1]): r[-1] for r in chosen.groupBy(*groups).count().collect()}  # a row a group
    return any(found.get(tuple(group), 0) < min(k, n) for *group, n in sizes)


def merge_states(states: DataFrame, k: int, group_cols: Sequence[str], path: str | None = None) -> Sample:
    """The ``min(k, N)`` rows of smallest rank of all groups in ``states``, each of which was cut at ``k`` or more."""
    spark = states.sparkSession
    path = path or fresh_path(spark, "sample-merged")
    sizes = states.groupBy(*group_cols).agg(F.max(STATE_POPULATION).alias("n"))
    population = int(sizes.agg(F.sum("n")).first()[0] or 0)
    states.orderBy(STATE_RANK, STATE_TIE).limit(k).drop(*STATE_COLUMNS).write.mode("overwrite").parquet(path)
    return Sample(spark.read.parquet(path), population, min(k, population))


def bernoulli_threshold(k: int, population: int) -> int:
    """Rank threshold of a Bernoulli sample with fraction ``min(1, k / max(1, N))``."""
    fraction = min(1.0, k / max(1, population))
    return int(math.floor(fraction * float(RANK_SPACE)))


def sample_bernoulli_hash(
    df: DataFrame,
    k: int,
    key_cols: Sequence[ColumnLike],
    seed: int = DEFAULT_SAMPLE_SEED,
) -> Sample:
    """Keep each row independently with probability ``min(1, k/N)``.

    The coin of a row is its rank, so the sample is reproducible and
    independent of partitioning; its size varies around ``k``.
    """
    population = df.count()
    threshold = bernoulli_threshold(k, population)
    rank = sample_rank(key_cols, seed)
    return _stored(df.where(rank < F.lit(rank_threshold(threshold))), population)


def _stored(rows: DataFrame, population: int) -> Sample:
    """Write the rows once; their number is then a matter of file footers."""
    path = fresh_path(rows.sparkSession, "sample")
    rows.write.parquet(path)
    rows = rows.sparkSession.read.parquet(path)
    return Sample(rows=rows, population=population, size=rows.count())


def sample_bernoulli_native(df: DataFrame, k: int, seed: int = DEFAULT_SAMPLE_SEED) -> Sample:
    """Spark's own ``sample(fraction, seed)``; depends on partitioning."""
    population = df.count()
    fraction = min(1.0, k / max(1, population))
    return _stored(df.sample(withReplacement=False, fraction=fraction, seed=seed), population)


def with_sample_sizes(sample: Sample) -> DataFrame:
    """Sample rows with the population and sample sizes kept beside them."""
    return sample.rows.withColumns(
        {
            "sample_population": F.lit(sample.population).cast("bigint"),
            "sample_size": F.lit(sample.size).cast("bigint"),
        }
    )


__all__ = [
    "Sample",
    "RANK_BITS",
    "STATE_COLUMNS",
    "bernoulli_threshold",
    "merge_states",
    "prefilter_threshold",
    "sample_bernoulli_hash",
    "sample_bernoulli_native",
    "sample_bottom_k",
    "sample_content_k",
    "sample_rank",
    "sample_states",
    "with_sample_sizes",
]
