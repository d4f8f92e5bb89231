"""Heavy hitters without an exact count of all groups: mergeable Misra-Gries summaries.

A task keeps at most ``capacity`` keys with counters.  When there are more, the
(capacity + 1)-th largest counter is taken off all of them and those at 0 or
below go; what was taken off adds up to the task's *slack*.  Each unit of slack
takes away capacity + 1 rows at least, so it is at most ``rows / (capacity +
1)``, and a key's count lies between its counter and counter + slack.
Summaries merge by adding counters and slacks, which keeps both statements
true of the sums (Agarwal et al., Mergeable Summaries, 2012).

So tasks send at most ``capacity`` rows each, whatever the number of groups,
and months' summaries add up to that of the year.  :func:`top_k_by_summary`
turns a summary into the exact top k: it counts the candidates only, in a
second pass, and proves that no other key can reach the k-th count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import value_columns
from ..session import broadcast_threshold, fresh_path
from .group_count import exact_counts, top_k

DEFAULT_CAPACITY = 10_000
KEY_BYTES = 64  # of one key of a candidate table, generously
COUNTER = "counter"
SLACK = "slack"
MASS = "mass"


def _reduced(table: pa.Table, keys: list[str], capacity: int) -> tuple[pa.Table, int]:
    """Counters summed by key and cut to ``capacity``, and what was taken off each."""
    table = table.group_by(keys).aggregate([(COUNTER, "sum")]).rename_columns([*keys, COUNTER])
    if table.num_rows <= capacity:
        return table, 0
    counters = table[COUNTER]
    order = pc.select_k_unstable(pa.table({COUNTER: counters}), capacity + 1, [(COUNTER, "descending")])
    taken = counters[order[capacity].as_py()].as_py()
    table = table.set_column(table.num_columns - 1, COUNTER, pc.subtract(counters, taken))
    return table.filter(pc.greater(table[COUNTER], 0)), taken


class _Held:
    """The summary of one group in a task."""

    def __init__(self, keys: list[str], capacity: int) -> None:
        self.keys, self.capacity = keys, capacity
        self.table: pa.Table | None = None
        self.slack = self.mass = 0

    def add(self, part: pa.Table) -> None:
        self.mass += pc.sum(part[COUNTER]).as_py() or 0
        self.table = part if self.table is None else pa.concat_tables([self.table, part]).combine_chunks()
        if self.table.num_rows > 2 * self.capacity:
            self.cut()

    def cut(self) -> None:
        self.table, taken = _reduced(self.table, self.keys, self.capacity)
        self.slack += taken


def _by_group(table: pa.Table, groups: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The parts of a table by the values of its group columns, which are few."""
    if not groups:
        yield (), table
        return
    for found in table.group_by(groups).aggregate([]).to_pylist():
        same = None
        for g in groups:
            here = pc.is_null(table[g]) if found[g] is None else pc.fill_null(pc.equal(table[g], found[g]), False)
            same = here if same is None else pc.and_(same, here)
        yield tuple(found[g] for g in groups), table.filter(same).drop_columns(groups)


def summaries(
    df: DataFrame,
    key_cols: Sequence[str],
    capacity: int = DEFAULT_CAPACITY,
    weight: str | None = None,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """(group_cols, keys, counter, slack, mass): the tasks' summaries side by side.

    Each task adds, for each group, one row without keys and counter that has
    its slack and the rows (or weight) it read; a key's row has neither.  A
    task holds at most ``2 * capacity`` counters a group (months are few, and a
    task of a month-partitioned layer meets one or two) and a batch.
    """
    if capacity < 1:
        raise ValueError("capacity must be >= 1")
    names = [f"k{i}" for i in range(len(key_cols))]
    groups = [f"g{i}" for i in range(len(group_cols))]
    columns = [c.alias(n) for c, n in zip(value_columns(df, list(key_cols)), names)]
    total = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    base = df.select(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], *columns, total.alias(COUNTER))
    marks = [T.StructField(c, T.LongType()) for c in (COUNTER, SLACK, MASS)]
    schema = T.StructType([*base.schema.fields[:-1], *marks])
    all_names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Held] = {}
        types: dict[str, pa.DataType] = {}
        for batch in batches:
            types = {f.name: f.type for f in batch.schema}
            counted = pa.Table.from_batches([batch]).group_by([*groups, *names]).aggregate([(COUNTER, "sum")])
            for group, part in _by_group(counted.rename_columns([*groups, *names, COUNTER]), groups):
                held.setdefault(group, _Held(names, capacity)).add(part)
        for group, summary in held.items():
            summary.cut()
            n = summary.table.num_rows
            place = [pa.array([v] * n, types[g]) for g, v in zip(groups, group)]
            none = pa.nulls(n, pa.int64())
            yield from pa.table([*place, *summary.table.columns, none, none], names=all_names).to_batches()
            last = [pa.array([v], types[g]) for g, v in zip(groups, group)] + [pa.nulls(1, types[k]) for k in names]
            last += [pa.nulls(1, pa.int64()), pa.array([summary.slack], pa.int64()), pa.array([summary.mass], pa.int64())]
            yield pa.RecordBatch.from_arrays(last, names=all_names)

    out = base.mapInArrow(run, schema)
    return out.withColumnsRenamed(dict(zip([*groups, *names], [*group_cols, *key_cols])))


def added_up(parts: DataFrame, key_cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Summaries of one group made one: counters by key, and a row of the slacks and masses in total."""
    known = F.col(COUNTER).isNotNull()
    none = F.lit(None).cast("bigint")
    counters = parts.where(known).groupBy(*group_cols, *key_cols).agg(F.sum(COUNTER).alias(COUNTER))
    counters = counters.select(*group_cols, *key_cols, COUNTER, none.alias(SLACK), none.alias(MASS))
    totals = parts.where(~known).groupBy(*group_cols).agg(F.sum(SLACK).alias(SLACK), F.sum(MASS).alias(MASS))
    keys = [F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in key_cols]
    return counters.unionByName(totals.select(*group_cols, *keys, none.alias(COUNTER), SLACK, MASS))


@dataclass(frozen=True)
class Summary:
    """Counters by key, the slack of all of them, and the rows counted."""

    counters: DataFrame
    slack: int
    mass: int


def merged(parts: DataFrame, key_cols: Sequence[str], path: str | None = None) -> Summary:
    """Summaries added up: counters by key, slacks and masses in total.  ``parts`` may be stored summaries of months."""
    spark = parts.sparkSession
    path = path or fresh_path(spark, "summaries")
    parts.write.mode("overwrite").parquet(path)
    parts = spark.read.schema(parts.schema).parquet(path)
    totals = parts.agg(F.sum(SLACK).alias("s"), F.sum(MASS).alias("m")).first()
    counters = parts.where(F.col(COUNTER).isNotNull()).groupBy(*key_cols).agg(F.sum(COUNTER).alias(COUNTER))
    return Summary(counters, int(totals["s"] or 0), int(totals["m"] or 0))


def bounded_top_k(summary: Summary, key_cols: Sequence[str], k: int) -> DataFrame:
    """(keys, lower_bound, upper_bound, guaranteed) of the k largest counters.

    ``guaranteed``: the key is among the true k largest, since its count is at
    least any that the (k + 1)-th counter, or a key without one, can have.
    """
    ranked = summary.counters.orderBy(F.desc(COUNTER), *key_cols).limit(k + 1).collect()  # k + 1 rows
    behind = (ranked[k][COUNTER] if len(ranked) > k else 0) + summary.slack
    top = top_k(summary.counters, COUNTER, key_cols, k)
    return top.select(
        *key_cols,
        F.col(COUNTER).alias("lower_bound"),
        (F.col(COUNTER) + F.lit(summary.slack)).alias("upper_bound"),
        (F.col(COUNTER) >= F.lit(behind)).alias("guaranteed"),
    )


def candidates(summary: Summary, key_cols: Sequence[str], k: int) -> DataFrame:
    """Keys whose count may be among the k largest: upper bound at least the k-th lower bound."""
    ranked = summary.counters.orderBy(F.desc(COUNTER)).limit(k).select(COUNTER).collect()  # k numbers
    kth = ranked[k - 1][0] if len(ranked) == k else 0
    return summary.counters.where(F.col(COUNTER) + F.lit(summary.slack) >= F.lit(kth))


def _wanted(df: DataFrame, keys: DataFrame, key_cols: Sequence[str], bound: int) -> DataFrame:
    """Rows of ``df`` whose keys are in ``keys``, null-safe; the keys are broadcast if ``bound`` of them fit."""
    values = value_columns(df, list(key_cols))
    side = keys.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(key_cols)])
    if bound * KEY_BYTES * len(key_cols) <= broadcast_threshold(df.sparkSession):
        side = F.broadcast(side)
    same = [v.eqNullSafe(F.col(f"_w{i}")) for i, v in enumerate(values)]
    return df.join(side, same, "left_semi")


def top_k_by_summary(
    df: DataFrame,
    key_cols: Sequence[str],
    k: int,
    count_col: str = "n",
    capacity: int = DEFAULT_CAPACITY,
    weight: str | None = None,
) -> DataFrame:
    """The exact k largest groups (ties by key), with the summary's bounds: (keys, count, lower_bound, upper_bound).

    1. One pass makes the summaries; tasks send ``capacity`` rows at most.
    2. The candidates, at most ``capacity`` rows a task of step 1, are counted
       exactly; no other group takes part in an exchange.
    3. A key without a counter has at most ``slack`` rows.  If the k-th count
       is above that, the result is proven; if not, one more try has eight
       times the capacity.  A table too even for that is counted in full (its
       bounds are then the counts).
    """
    keys = list(key_cols)
    spark = df.sparkSession
    for size in (capacity, 8 * capacity):
        summary = merged(summaries(df, keys, size, weight), keys)
        path = fresh_path(spark, "candidates")
        chosen = candidates(summary, keys, k)
        chosen.write.parquet(path)
        chosen = spark.read.schema(chosen.schema).parquet(path)
        counts = exact_counts(_wanted(df, chosen, keys, chosen.count()), keys, count_col, weight)
        top = top_k(counts, count_col, keys, k)
        if summary.slack == 0 or _all_above(top, count_col, k, summary.slack):
            return _with_bounds(top, chosen, keys, count_col, summary.slack)
    top = top_k(exact_counts(df, keys, count_col, weight), count_col, keys, k)
    return top.select(*keys, count_col, F.col(count_col).alias("lower_bound"), F.col(count_col).alias("upper_bound"))


def _all_above(top: DataFrame, count_col: str, k: int, slack: int) -> bool:
    found = top.select(count_col).collect()  # k numbers
    return len(found) == k and min(r[0] for r in found) > slack


def _with_bounds(top: DataFrame, chosen: DataFrame, keys: list[str], count_col: str, slack: int) -> DataFrame:
    bounds = chosen.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(keys)], F.col(COUNTER).alias("lower_bound"))
    same = [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(keys)]
    upper = (F.col("lower_bound") + F.lit(slack)).alias("upper_bound")
    return top.join(bounds, same).select(*keys, count_col, "lower_bound", upper)
