"""One group-count question answered exactly, from a sample and from a sketch.

The six gold queries are parameter sets of :class:`GroupCountQuery`; this
module turns one into DataFrames.  The whole comparison is one lazy plan --
exact top-k, joined to the scaled sample counts and to the sketch estimates --
with no collect on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .group_count import exact_counts, order_result, scaled_counts, top_k
from .sample import Sample
from .sketch import SketchParams, cms_cells, cms_cells_from_counts, cms_estimate

CMS_COL = "cms_estimated_count"


@dataclass(frozen=True)
class GroupCountQuery:
    """A group count with its domain, cut and output names.

    * ``derive``: adds derived key columns (e.g. ``hour``) to a table; applied
      to the full table and to the sample alike.
    * ``where``: the domain predicate, applied to exact and sample counts.
    * ``sketch_filtered``: whether the sketch is built on the filtered domain
      (True) or on the whole table, keys looked up only for the domain.
    * ``top``: keep the ``top`` largest exact groups (ties by key); ``None``
      keeps all groups.
    * ``order``: ``"count"`` or ``"key"`` for the output order.
    * ``weight``: the table's rows are pre-aggregated and this column holds
      how many original rows each stands for (counts become sums).
    """

    name: str
    keys: tuple[str, ...]
    exact_col: str = "exact_trip_count"
    sampled_col: str = "sampled_trip_count"
    derive: Callable[[DataFrame], DataFrame] | None = None
    where: Callable[[], Column] | None = None
    sketch_filtered: bool = True
    top: int | None = None
    order: str = "count"
    weight: str | None = None
    description: str = field(default="", compare=False)

    def prepared(self, df: DataFrame) -> DataFrame:
        return self.derive(df) if self.derive is not None else df

    def domain(self, df: DataFrame) -> DataFrame:
        df = self.prepared(df)
        return df.where(self.where()) if self.where is not None else df

    def sketch_domain(self, df: DataFrame) -> DataFrame:
        return self.domain(df) if self.sketch_filtered else self.prepared(df)


def exact_all(q: GroupCountQuery, table: DataFrame) -> DataFrame:
    """Exact counts of every group of the domain."""
    return exact_counts(q.domain(table), q.keys, q.exact_col, q.weight)


def exact_side(q: GroupCountQuery, table: DataFrame) -> DataFrame:
    """Exact counts of the domain, cut to the top groups when ``q.top``."""
    counts = exact_all(q, table)
    return top_k(counts, q.exact_col, q.keys, q.top) if q.top is not None else counts


def sample_side(q: GroupCountQuery, sample: Sample) -> DataFrame:
    """Scaled counts of the sample's domain (all groups)."""
    return scaled_counts(q.domain(sample.rows), q.keys, sample.factor, q.sampled_col, q.weight)


def sample_top(q: GroupCountQuery, sample: Sample, k: int | None = None) -> DataFrame:
    """The sample's own top groups, ranked by the scaled count."""
    counts = sample_side(q, sample)
    return top_k(counts, q.sampled_col, q.keys, k or q.top or 20)


def sketch_cells_for(
    q: GroupCountQuery,
    table: DataFrame,
    params: SketchParams,
    mode: str = "rows",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Cell table of the query's sketch domain.

    ``mode="rows"`` hashes row by row: one pass, state bounded by the sketch's
    size, no exact counts.  ``mode="grouped"`` first counts each distinct key
    exactly (unbounded state, but fewer hashes where keys repeat a lot).  Both
    give the same cells.  ``group_cols`` builds a sketch for each group.
    """
    if mode == "rows":
        return cms_cells(q.sketch_domain(table), q.keys, params, group_cols=group_cols, weight=q.weight)
    if mode != "grouped":
        raise ValueError(f"unknown sketch mode {mode!r}")
    if group_cols:
        return cms_cells(q.sketch_domain(table), q.keys, params, pre_group=True, group_cols=group_cols, weight=q.weight)
    if q.sketch_filtered:
        return cms_cells_from_counts(exact_all(q, table), q.keys, q.exact_col, params)
    return cms_cells(q.sketch_domain(table), q.keys, params, pre_group=True, weight=q.weight)


def cms_side(
    q: GroupCountQuery,
    table: DataFrame,
    params: SketchParams,
    mode: str = "rows",
    exact: DataFrame | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Sketch estimates for the keys of the exact side (its top keys).

    ``cells`` is a stored (merged) sketch; without it one is built from the table.
    """
    exact = exact if exact is not None else exact_side(q, table)
    cells = cells if cells is not None else sketch_cells_for(q, table, params, mode)
    return cms_estimate(exact, q.keys, cells, params, CMS_COL)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def combine(q: GroupCountQuery, with_cms: DataFrame, sampled: DataFrame, ordered: bool = True) -> DataFrame:
    """Join the exact+sketch side to the sample side and order the result.

    ``with_cms`` has ``keys, exact, cms_estimated_count`` (one row per kept
    group), ``sampled`` has ``keys, sampled``.  ``ordered=False`` leaves the
    presentation order out, for a result that is aggregated further.
    """
    joined = _join_null_safe(with_cms, sampled, q.keys, "left")
    out = joined.select(*q.keys, q.exact_col, q.sampled_col, CMS_COL)
    return order_result(out, q.order, q.exact_col, q.keys) if ordered else out


def comparison(
    q: GroupCountQuery,
    table: DataFrame,
    sample: Sample,
    params: SketchParams = SketchParams(),
    mode: str = "rows",
    cells: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """``keys, exact, sampled, cms_estimated_count`` for the exact top groups.

    The cut is taken once, on the exact counts; sketch estimates are computed
    for exactly those keys, and the sample's counts are joined on (null-safe)
    keys, so a group missing from the sample has a null sampled count.
    """
    exact = exact_side(q, table)
    with_cms = cms_side(q, table, params, mode, exact=exact, cells=cells)
    return combine(q, with_cms, sample_side(q, sample), ordered)
