"""State kept by month beside a silver layer, and brought up to date month by month.

Four kinds of state, each a :class:`~tripstats.sources.month_store.MonthStore`:
Count-Min cells, heavy-hitter summaries (both for each question), sample states
(for all questions) and the quality gate's counts.  All merge, so an answer for any range of months is
the merge of their states.  The manifest of a store names, for each month, the
silver files it was computed from.  A refresh recomputes the months whose files
are others now, and only reads those; an answer is refused if a month it needs
is not up to date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import heavy_hitters as hh
from ..operators.compare import GroupCountQuery, sketch_cells_for
from ..operators.quality import gate_counts, reject_reason, report_of
from ..operators.sample import Sample, merge_states, sample_states
from ..operators.sketch import SketchParams, cms_merge
from ..schemas import DEFAULT_SAMPLE_SEED, DEFAULT_SAMPLE_SIZE, SILVER_PARTITION_COLUMNS, SILVER_SCHEMA
from ..session import fresh_path
from ..sources.layers import month_range_predicate, read_layer
from ..sources.month_store import Month, MonthStore, StaleMonths, month_identities, only_months, stale_months

MONTH_FIELDS = [T.StructField(c, T.IntegerType()) for c in SILVER_PARTITION_COLUMNS]
CELL_SCHEMA = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.LongType()), *MONTH_FIELDS])


def read_published(
    spark: SparkSession, path: str, schema: T.StructType, months: tuple[str, str] | None = None
) -> DataFrame:
    """A layer's current rows: a published one by its manifest, a plain ``year=/month=`` folder as it is."""
    store = MonthStore(spark, path)
    if store.exists():
        return store.read(schema, months)
    layer = read_layer(spark, path, schema)
    return layer if months is None else layer.where(month_range_predicate(*months))


def _refresh(store: MonthStore, silver_path: str, months: tuple[str, str] | None, build) -> list[Month]:
    """Recompute the stale months of ``store``; ``build`` makes the state of silver rows."""
    source = month_identities(store.spark, silver_path, months)
    stale = stale_months(store.entries(), source, months)
    if stale:
        silver = only_months(read_published(store.spark, silver_path, SILVER_SCHEMA), stale)
        store.write(build(silver), months=stale, sources={m: source[m] for m in stale if m in source})
    return stale


def _covered(store: MonthStore, silver_path: str, months: tuple[str, str] | None) -> MonthStore:
    source = month_identities(store.spark, silver_path, months)
    stale = stale_months(store.entries(), source, months)
    if stale:
        raise StaleMonths(f"{store.root} is not up to date with {silver_path} for {len(stale)} months, the first {stale[0]}; refresh it")
    return store


# --- Count-Min cells -------------------------------------------------------------------


def sketch_folder(root: str, number: int, params: SketchParams) -> str:
    return f"{root}/query{number}-{params.label}"


def refresh_sketch(
    spark: SparkSession,
    silver_path: str,
    path: str,
    query: GroupCountQuery,
    params: SketchParams,
    months: tuple[str, str] | None = None,
) -> list[Month]:
    """Bring the monthly cells of a question at ``path`` up to date; returns the months recomputed.

    One pass over their silver rows, with state of at most depth x width cells
    a task and month.  ``months`` restricts the refresh; other months stay.
    """
    build = lambda silver: sketch_cells_for(query, silver, params, group_cols=SILVER_PARTITION_COLUMNS)
    return _refresh(MonthStore(spark, path), silver_path, months, build)


def merged_sketch(spark: SparkSession, silver_path: str, path: str, months: tuple[str, str] | None = None) -> DataFrame:
    """The cells of all months, or of a range, added up; :class:`StaleMonths` if they do not match silver."""
    cells = _covered(MonthStore(spark, path), silver_path, months).read(CELL_SCHEMA, months)
    return cms_merge(cells.select("d", "b", "c"))


# --- samples ---------------------------------------------------------------------------


def sample_folder(root: str, k: int, seed: int, method: str) -> str:
    return f"{root}/state-{k}-{method}-{seed}"


def _state_schema(method: str) -> T.StructType:
    rank = T.StringType() if method == "md5" else T.LongType()
    extra = [T.StructField("sample_rank", rank), T.StructField("sample_tie", rank), T.StructField("stratum_population", T.LongType())]
    return T.StructType([*SILVER_SCHEMA.fields, *extra])


def refresh_sample(
    spark: SparkSession,
    silver_path: str,
    root: str,
    k: int = DEFAULT_SAMPLE_SIZE,
    seed: int = DEFAULT_SAMPLE_SEED,
    method: str = "xxhash64",
    months: tuple[str, str] | None = None,
) -> list[Month]:
    """Bring the monthly sample states (the ``k`` smallest ranks of each month) up to date; returns the months redrawn."""
    schema = _state_schema(method)
    build = lambda silver: sample_states(silver, k, SILVER_PARTITION_COLUMNS, seed, method=method).select(*schema.names)
    return _refresh(MonthStore(spark, sample_folder(root, k, seed, method)), silver_path, months, build)


def sample_state_rows(
    spark: SparkSession,
    silver_path: str,
    root: str,
    k: int = DEFAULT_SAMPLE_SIZE,
    seed: int = DEFAULT_SAMPLE_SEED,
    method: str = "xxhash64",
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """The stored states of all months, or of a range: one stratum a month."""
    store = _covered(MonthStore(spark, sample_folder(root, k, seed, method)), silver_path, months)
    return store.read(_state_schema(method), months)


def merged_sample(
    spark: SparkSession,
    silver_path: str,
    root: str,
    k: int = DEFAULT_SAMPLE_SIZE,
    seed: int = DEFAULT_SAMPLE_SEED,
    method: str = "xxhash64",
    months: tuple[str, str] | None = None,
) -> Sample:
    """The sample of all months, or of a range of months (of full size), merged from the stored states."""
    states = sample_state_rows(spark, silver_path, root, k, seed, method, months)
    return merge_states(states, k, SILVER_PARTITION_COLUMNS, fresh_path(spark, "sample-merged"))


# --- heavy hitters ---------------------------------------------------------------------


def summary_folder(root: str, number: int, capacity: int) -> str:
    return f"{root}/query{number}-heavy-{capacity}"


def _summary_schema(spark: SparkSession, query: GroupCountQuery) -> T.StructType:
    keys = query.domain(spark.createDataFrame([], SILVER_SCHEMA)).select(*query.keys).schema.fields
    marks = [T.StructField(c, T.LongType()) for c in (hh.COUNTER, hh.SLACK, hh.MASS)]
    return T.StructType([*keys, *marks, *MONTH_FIELDS])


def refresh_summary(
    spark: SparkSession,
    silver_path: str,
    path: str,
    query: GroupCountQuery,
    capacity: int = hh.DEFAULT_CAPACITY,
    months: tuple[str, str] | None = None,
) -> list[Month]:
    """Bring the monthly heavy-hitter summaries of a question up to date; returns the months recomputed."""
    schema = _summary_schema(spark, query)

    def build(silver: DataFrame) -> DataFrame:
        parts = hh.summaries(query.domain(silver), query.keys, capacity, group_cols=SILVER_PARTITION_COLUMNS)
        return hh.added_up(parts, query.keys, SILVER_PARTITION_COLUMNS).select(*schema.names)

    return _refresh(MonthStore(spark, path), silver_path, months, build)


def merged_summary(
    spark: SparkSession, silver_path: str, path: str, query: GroupCountQuery, months: tuple[str, str] | None = None
) -> hh.Summary:
    """The summary of all months, or of a range, from the stored ones."""
    parts = _covered(MonthStore(spark, path), silver_path, months).read(_summary_schema(spark, query), months)
    return hh.merged(parts.drop(*SILVER_PARTITION_COLUMNS), query.keys)


# --- quality gate ----------------------------------------------------------------------

GATE_COUNTS = ("n", "v2", "v3", "v4")
GATE_SCHEMA = T.StructType([*[T.StructField(c, T.LongType()) for c in GATE_COUNTS], *MONTH_FIELDS])


def refresh_gate(spark: SparkSession, silver_path: str, path: str, months: tuple[str, str] | None = None) -> list[Month]:
    """Bring the gate's monthly counts up to date; returns the months checked, the others are not scanned."""
    build = lambda silver: gate_counts(silver, group_cols=SILVER_PARTITION_COLUMNS).select(*GATE_SCHEMA.names)
    return _refresh(MonthStore(spark, path), silver_path, months, build)


def merged_gate(spark: SparkSession, silver_path: str, path: str, months: tuple[str, str] | None = None) -> DataFrame:
    """The gate's report over all months, or a range, from the stored counts."""
    counts = _covered(MonthStore(spark, path), silver_path, months).read(GATE_SCHEMA, months)
    return report_of(counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in GATE_COUNTS]))


def quarantine_months(spark: SparkSession, silver_path: str, gate_path: str, quarantine_path: str) -> dict[str, int]:
    """Move the rows that break a row rule out of a published silver; returns their number by reason.

    The gate's counts tell which months have such rows, and only those are
    read and published again; their rejects, with ``reject_reason``, replace
    those months of the quarantine layer, which is written first.
    """
    refresh_gate(spark, silver_path, gate_path)
    counts = MonthStore(spark, gate_path).read(GATE_SCHEMA)
    bad = [(r["year"], r["month"]) for r in counts.where("v2 + v3 + v4 > 0").select("year", "month").collect()]  # months
    if not bad:
        return {}
    store = MonthStore(spark, silver_path)
    marked = only_months(store.read(SILVER_SCHEMA), bad).withColumn("reject_reason", reject_reason())
    rejects = MonthStore(spark, quarantine_path)
    rejects.write(marked.where(F.col("reject_reason").isNotNull()), months=bad)
    sources = {m: e.source for m, e in store.entries().items() if e.source is not None}
    store.write(marked.where(F.col("reject_reason").isNull()).drop("reject_reason"), months=bad, sources=sources)
    refresh_gate(spark, silver_path, gate_path)
    found = only_months(rejects.read(marked.schema), bad).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return {r["reject_reason"]: r["n"] for r in found.collect()}  # a row a rule


def refresh_sketches(
    spark: SparkSession,
    silver_path: str,
    root: str,
    params: SketchParams,
    queries: Sequence[GroupCountQuery],
    months: tuple[str, str] | None = None,
) -> dict[str, list[Month]]:
    """:func:`refresh_sketch` of several questions under one root; the months recomputed, by question."""
    return {
        q.name: refresh_sketch(spark, silver_path, sketch_folder(root, i, params), q, params, months)
        for i, q in enumerate(queries, start=1)
    }
