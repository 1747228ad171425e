"""Writers: partitioned tables, report files, keyed records, discarded rows."""

from ontime.sinks.files import noop_run, write_partitioned, write_report_csv
from ontime.sinks.keyed import (
    keyed_replace,
    keyed_upsert,
    read_keyed,
    write_keyed_connector,
)

__all__ = [
    "keyed_replace",
    "keyed_upsert",
    "noop_run",
    "read_keyed",
    "write_keyed_connector",
    "write_partitioned",
    "write_report_csv",
]
