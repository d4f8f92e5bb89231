"""The whole batch pipeline over trip files: raw -> bronze -> silver -> gold.

Each stage reads the previous layer from storage and writes its own, so a
failed or lost executor only costs the stage it was in, and no stage keeps a
long lineage.  Nothing but small results (gate report, row counts, metrics)
reaches the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import INCLUSIVE_MIDNIGHT, clean_trips
from ..operators.compare import CMS_COL, GroupCountQuery, cms_side, combine, comparison, exact_side, sample_side
from ..operators.errors import error_metrics
from ..operators.quality import enforce_gate, gate_report, reject_reason
from ..operators.sample import Sample, with_sample_sizes
from ..operators.sketch import SketchParams
from ..schemas import (
    CORRUPT_RECORD_COL,
    DEFAULT_DATE_HI,
    DEFAULT_DATE_LO,
    DEFAULT_SAMPLE_SEED,
    DEFAULT_SAMPLE_SIZE,
    METRICS_SCHEMA,
    RAW_TRIP_SCHEMA,
    SILVER_SCHEMA,
)
from ..sources.csv_source import read_raw_csv
from ..sources.layers import file_count, month_range_predicate, read_layer, write_flat
from ..sources.month_store import Month, MonthStore
from .monthly import (
    merged_gate,
    merged_sample,
    merged_sketch,
    quarantine_months,
    read_published,
    refresh_gate,
    refresh_sample,
    refresh_sketch,
    refresh_sketches,
    sketch_folder,
)
from .taxi import TAXI_QUERIES


@dataclass
class Layout:
    """Paths of the layers under one root (any Hadoop URI)."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def sample(self) -> str:
        return f"{self.root}/silver_sample"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def rejects(self) -> str:
        return f"{self.root}/silver_rejects"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"


@dataclass
class PipelineResult:
    status: str
    layout: Layout
    counts: dict[str, int] = field(default_factory=dict)
    metrics: list[dict] = field(default_factory=list)


def ingest(spark: SparkSession, raw_path: str, bronze_path: str) -> tuple[int, int]:
    """Raw CSV -> bronze Parquet (typed, unchanged rows).

    Returns ``(rows, malformed_rows)``: rows whose values did not parse keep
    their original line in ``_corrupt_record`` and are counted in the same
    aggregate as the row count (over the written bronze, one pass).
    """
    write_flat(read_raw_csv(spark, raw_path, keep_corrupt=True), bronze_path)
    stats = spark.read.parquet(bronze_path).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT_RECORD_COL).isNotNull()).alias("bad")
    ).first()
    return int(stats["n"]), int(stats["bad"])


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    date_lo: str = DEFAULT_DATE_LO,
    date_hi: str = DEFAULT_DATE_HI,
    range_mode: str = INCLUSIVE_MIDNIGHT,
    dedup: bool | Sequence[str] = False,
    incremental: bool = False,
) -> int:
    """Bronze -> silver, published by pickup year and month; returns the rows written.

    The layer is a :class:`~tripstats.sources.month_store.MonthStore`: a run
    that fails leaves the old one readable.  With ``incremental`` only the
    months of ``bronze`` are replaced, else it is the whole new layer.
    """
    bronze = read_layer(spark, bronze_path, RAW_TRIP_SCHEMA)
    silver = clean_trips(bronze, date_lo=date_lo, date_hi=date_hi, range_mode=range_mode, dedup=dedup)
    return MonthStore(spark, silver_path).write(silver, replace=not incremental)


def read_silver(spark: SparkSession, silver_path: str, months: tuple[str, str] | None = None) -> DataFrame:
    """Silver as it is published now, or a plain ``year=/month=`` folder (of the stream, say)."""
    return read_published(spark, silver_path, SILVER_SCHEMA, months)


def silver_files(spark: SparkSession, silver_path: str) -> int:
    """Number of silver's current data files."""
    store = MonthStore(spark, silver_path)
    return sum(e.files for e in store.entries().values()) if store.exists() else file_count(spark, silver_path)


def run_gate(spark: SparkSession, silver_path: str, report_path: str, state_path: str | None = None) -> int:
    """One-pass gate over silver; the report (with the check time and the row
    count, like a success marker) is written, then enforced.

    With ``state_path`` the counts are kept there by month, and only months
    whose files have changed are scanned."""
    if state_path is None:
        report = gate_report(read_silver(spark, silver_path))
    else:
        refresh_gate(spark, silver_path, state_path)
        report = merged_gate(spark, silver_path, state_path)
    write_flat(report.withColumn("checked_at", F.current_timestamp()).coalesce(1), report_path)
    return enforce_gate(spark.read.parquet(report_path))


def write_quarantine(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows with their ``reject_reason`` once, split by acceptance.

    One scan of ``df``: the folders ``rejected=false`` and ``rejected=true``
    under ``path`` hold the two sides, which are returned as read back.
    """
    reason = reject_reason()
    marked = df.withColumn("reject_reason", reason).withColumn("rejected", F.col("reject_reason").isNotNull())
    schema = marked.schema
    marked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(schema).parquet(path)
    return stored.where(~F.col("rejected")).drop("rejected", "reject_reason"), stored.where("rejected").drop("rejected")


def build_sample(
    spark: SparkSession,
    silver_path: str,
    sample_path: str,
    k: int = DEFAULT_SAMPLE_SIZE,
    seed: int = DEFAULT_SAMPLE_SEED,
    rank_method: str = "xxhash64",
) -> Sample:
    """Sample of silver by row content, stored with its population and size.

    Equal silver rows and seed give an equal sample, wherever the layer lies
    and however it is split into files.  It is merged from a state for each
    month, kept beside it (``<sample_path>_months``), so only months that have
    changed are drawn again.  The rank is ``xxhash64`` by default; ``md5``
    gives a sample that other SQL engines can reproduce row for row.
    """
    if k == 0:
        empty = spark.createDataFrame([], SILVER_SCHEMA)
        drawn = Sample(empty, read_silver(spark, silver_path).count(), 0)
    else:
        refresh_sample(spark, silver_path, f"{sample_path}_months", k, seed, rank_method)
        drawn = merged_sample(spark, silver_path, f"{sample_path}_months", k, seed, rank_method)
    write_flat(with_sample_sizes(drawn), sample_path)
    return read_sample(spark, sample_path)


def read_sample(spark: SparkSession, sample_path: str) -> Sample:
    stored = spark.read.parquet(sample_path)
    sizes = stored.select("sample_population", "sample_size").limit(1).collect()
    # An empty sample stores no row; its scale factor is 1.0 whatever N is.
    population, size = (int(sizes[0][0]), int(sizes[0][1])) if sizes else (0, 0)
    return Sample(stored.drop("sample_population", "sample_size"), population, size)


def _timed_write(df: DataFrame, path: str) -> int:
    t0 = time.perf_counter()
    write_flat(df, path)
    return int((time.perf_counter() - t0) * 1000)


# The pipeline's sketches: cheap hashes, since no other engine rebuilds them.
PIPELINE_SKETCH = SketchParams(hash="xxhash64")


def build_sketches(
    spark: SparkSession,
    silver_path: str,
    sketch_path: str,
    params: SketchParams = PIPELINE_SKETCH,
    queries: Sequence[GroupCountQuery] = TAXI_QUERIES,
    months: tuple[str, str] | None = None,
) -> dict[str, list[Month]]:
    """Bring the stored sketch of each question and month up to date; returns the months recomputed.

    Months whose silver files have not changed are left alone, and so are
    those outside ``months``.  For the others, one pass over their rows for
    each question, with state bounded by the sketch size a month.
    """
    return refresh_sketches(spark, silver_path, sketch_path, params, queries, months)


@dataclass(frozen=True)
class SampleState:
    """Where the monthly sample states lie, and the parameters they were drawn with."""

    path: str
    k: int = DEFAULT_SAMPLE_SIZE
    seed: int = DEFAULT_SAMPLE_SEED
    method: str = "xxhash64"


def build_gold(
    spark: SparkSession,
    silver_path: str,
    sample_path: str,
    gold_path: str,
    params: SketchParams = PIPELINE_SKETCH,
    queries: Sequence[GroupCountQuery] = TAXI_QUERIES,
    measure_times: bool = False,
    months: tuple[str, str] | None = None,
    sketch_path: str | None = None,
    sample_state: SampleState | None = None,
) -> list[dict]:
    """Write one comparison table per query and the metrics JSON.

    ``months=(first, last)`` (dates, e.g. ``("2023-01-01", "2023-06-30")``)
    restricts the answers to those pickup months; the predicate is on the
    partition columns, so only those directories are read.

    Sketch answers come from monthly sketches: those stored at
    ``sketch_path`` by :func:`build_sketches` if it is given (no pass over
    silver; refused with ``StaleMonths`` if one was made from other files than
    silver has now), else those under ``gold/_sketches``, brought up to date first.
    With ``months`` and a ``sample_state`` (the ``_months`` folder that
    :func:`build_sample` keeps) the sample of those months is merged from
    their states and has full size; without, the stored sample is filtered.

    With ``measure_times`` each method is run, written on its own (under
    ``gold/_parts``) and timed: exact top groups; scaled sample counts;
    building the sketch, if that is done here, and estimating.  The
    comparison is then a join of the stored parts.  Without it the exact
    answer and the comparison are one plan.  Error metrics are computed from
    the written comparison tables.
    """
    silver = read_silver(spark, silver_path, months)
    if months is not None and sample_state is not None:
        s = sample_state
        sample = merged_sample(spark, silver_path, s.path, s.k, s.seed, s.method, months)
    else:
        sample = read_sample(spark, sample_path)
        if months is not None:
            sample = Sample(sample.rows.where(month_range_predicate(*months)), sample.population, sample.size)
    metric_frames = []
    for i, q in enumerate(queries, start=1):
        out = f"{gold_path}/query{i}"
        times = {"exact_time_ms": None, "sample_time_ms": None, "cms_time_ms": None}
        t0 = time.perf_counter()
        folder = sketch_folder(sketch_path or f"{gold_path}/_sketches", i, params)
        if sketch_path is None:
            refresh_sketch(spark, silver_path, folder, q, params, months)
        build_ms = int((time.perf_counter() - t0) * 1000)
        cells = merged_sketch(spark, silver_path, folder, months)
        if measure_times:
            parts = f"{gold_path}/_parts/query{i}"
            times["exact_time_ms"] = _timed_write(exact_side(q, silver), f"{parts}/exact")
            times["sample_time_ms"] = _timed_write(sample_side(q, sample), f"{parts}/sample")
            exact = spark.read.parquet(f"{parts}/exact")
            estimates = cms_side(q, silver, params, exact=exact, cells=cells)
            times["cms_time_ms"] = build_ms + _timed_write(estimates, f"{parts}/cms")
            table = combine(q, spark.read.parquet(f"{parts}/cms"), spark.read.parquet(f"{parts}/sample"))
        else:
            table = comparison(q, silver, sample, params, cells=cells)
        write_flat(table, out)
        errors = error_metrics(spark.read.parquet(out), q.name, q.exact_col, q.sampled_col, CMS_COL)
        metric_frames.append(
            errors.select(
                "query_name",
                *[F.lit(v).cast("bigint").alias(k) for k, v in times.items()],
                "sample_absolute_error",
                "sample_pct_error",
                "cms_absolute_error",
                "cms_pct_error",
            )
        )
    metrics = metric_frames[0]
    for m in metric_frames[1:]:
        metrics = metrics.unionByName(m)
    metrics = spark.createDataFrame(metrics.collect(), METRICS_SCHEMA)  # six rows
    metrics.coalesce(1).write.mode("overwrite").json(f"{gold_path}/metrics")
    return [r.asDict() for r in metrics.collect()]


def read_metrics(spark: SparkSession, gold_path: str) -> DataFrame:
    """The metrics JSON of :func:`build_gold`."""
    return spark.read.schema(METRICS_SCHEMA).json(f"{gold_path}/metrics")


def volume_status(files: int, min_files: int) -> str:
    """Whether a layer with so many data files is enough to answer from."""
    return "ok" if files >= min_files else "insufficient_data"


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    out_root: str,
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    sample_seed: int = DEFAULT_SAMPLE_SEED,
    params: SketchParams = PIPELINE_SKETCH,
    date_lo: str = DEFAULT_DATE_LO,
    date_hi: str = DEFAULT_DATE_HI,
    range_mode: str = INCLUSIVE_MIDNIGHT,
    dedup: bool = False,
    min_files: int = 1,
    gate_before_gold: bool = True,
    measure_times: bool = False,
    months: tuple[str, str] | None = None,
    quarantine: bool = False,
) -> PipelineResult:
    """ingest -> clean -> volume check -> gate -> sample -> gold.

    If silver has fewer than ``min_files`` data files (by default: none at
    all) the run stops with status ``insufficient_data``.  The gate runs
    before gold by default, so failed data never reaches the gold layer
    (``gate_before_gold=False`` runs it last).  With ``quarantine`` the rows
    that break a row rule are moved to ``silver_rejects`` first and reported
    by reason (``counts["rejected_<reason>"]``); else the gate stops the run.
    """
    layout = Layout(out_root.rstrip("/"))
    result = PipelineResult(status="running", layout=layout)
    result.counts["bronze_rows"], result.counts["malformed_rows"] = ingest(spark, raw_path, layout.bronze)
    result.counts["silver_rows"] = build_silver(
        spark, layout.bronze, layout.silver, date_lo, date_hi, range_mode, dedup
    )
    result.counts["silver_files"] = silver_files(spark, layout.silver)
    if volume_status(result.counts["silver_files"], min_files) != "ok":
        result.status = volume_status(result.counts["silver_files"], min_files)
        return result
    gate_state = f"{layout.quality}/gate_state"
    if quarantine:
        for reason, n in quarantine_months(spark, layout.silver, gate_state, layout.rejects).items():
            result.counts[f"rejected_{reason}"] = n
    if gate_before_gold:
        run_gate(spark, layout.silver, f"{layout.quality}/gate", gate_state)
    sample = build_sample(spark, layout.silver, layout.sample, sample_size, sample_seed)
    result.counts["sample_rows"] = sample.size
    state = SampleState(f"{layout.sample}_months", sample_size, sample_seed) if sample_size else None
    result.metrics = build_gold(
        spark, layout.silver, layout.sample, layout.gold, params, measure_times=measure_times, months=months, sample_state=state
    )
    if not gate_before_gold:
        run_gate(spark, layout.silver, f"{layout.quality}/gate", gate_state)
    result.status = "ok"
    return result
