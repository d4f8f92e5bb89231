"""Operators: each a function from DataFrames to a DataFrame (lazy plan)."""

from .clean import HALF_OPEN, INCLUSIVE_MIDNIGHT, clean_trips, pickup_range
from .compare import GroupCountQuery, cms_side, comparison, exact_side, sample_side, sample_top
from .errors import error_metrics, per_key_error_metrics
from .group_count import exact_counts, order_result, scaled_counts, top_k
from .quality import GateColumns, QualityGateError, enforce_gate, gate_report, quarantine
from .sample import (
    Sample,
    sample_bernoulli_hash,
    sample_bernoulli_native,
    sample_bottom_k,
    sample_rank,
    with_sample_sizes,
)
from .sketch import SketchParams, cms_cells, cms_cells_from_counts, cms_estimate, cms_merge, cms_native

__all__ = [
    "HALF_OPEN",
    "INCLUSIVE_MIDNIGHT",
    "clean_trips",
    "pickup_range",
    "GroupCountQuery",
    "cms_side",
    "comparison",
    "exact_side",
    "sample_side",
    "sample_top",
    "error_metrics",
    "per_key_error_metrics",
    "exact_counts",
    "order_result",
    "scaled_counts",
    "top_k",
    "GateColumns",
    "QualityGateError",
    "enforce_gate",
    "gate_report",
    "quarantine",
    "Sample",
    "sample_bernoulli_hash",
    "sample_bernoulli_native",
    "sample_bottom_k",
    "sample_rank",
    "with_sample_sizes",
    "SketchParams",
    "cms_cells",
    "cms_cells_from_counts",
    "cms_estimate",
    "cms_merge",
    "cms_native",
]
