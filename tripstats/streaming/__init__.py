"""Structured Streaming form of the ingest + clean steps, and of the monthly sketches."""

from .ingest import late_rows, malformed_rows, publish_batches, start_published_stream, start_silver_stream
from .sketches import Merged, merge_published

__all__ = [
    "Merged",
    "late_rows",
    "malformed_rows",
    "merge_published",
    "publish_batches",
    "start_published_stream",
    "start_silver_stream",
]
