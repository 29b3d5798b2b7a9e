"""Scans, merges and sinks."""

from contrail.sources.files import merge_inputs, scan_csv, scan_dimension
from contrail.sources.rejects import scan_csv_checked
from contrail.sources.sinks import preview, write_parquet
from contrail.sources.tables import TABLES, load_table, trips, trips_text

__all__ = [
    "TABLES",
    "load_table",
    "merge_inputs",
    "preview",
    "scan_csv",
    "scan_csv_checked",
    "scan_dimension",
    "trips",
    "trips_text",
    "write_parquet",
]
