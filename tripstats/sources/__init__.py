"""Sources and sinks: the given tables, CSV at the edge, Parquet layers."""

from .csv_source import read_raw_csv, write_csv
from .layers import (
    file_count,
    month_range_predicate,
    partition_volume,
    read_layer,
    read_months,
    write_flat,
    write_partitioned,
)
from .tables import read_table, table_path

__all__ = [
    "read_raw_csv",
    "write_csv",
    "file_count",
    "month_range_predicate",
    "partition_volume",
    "read_layer",
    "read_months",
    "write_flat",
    "write_partitioned",
    "read_table",
    "table_path",
]
