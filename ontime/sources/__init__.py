"""Readers with declared schemas."""

from ontime.sources.delimited import ingest_csv, ingest_new_csv, scan_csv
from ontime.sources.files import (
    scan_avro,
    scan_csv_report,
    scan_partitioned,
    scan_raw,
)
from ontime.sources.lineitem_flights import flights

__all__ = [
    "flights",
    "ingest_csv",
    "ingest_new_csv",
    "scan_avro",
    "scan_csv",
    "scan_csv_report",
    "scan_partitioned",
    "scan_raw",
]
