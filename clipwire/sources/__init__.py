"""Sources and sinks: payload files, tables and CSV exports."""

from clipwire.sources.payloads import (
    history_union,
    ingest_articles,
    read_payload_files,
    rejected_articles,
    rejected_payloads,
)
from clipwire.sources.tables import (
    append_as_dealt,
    load_table,
    read_csv_export,
    write_csv_export,
    write_overwrite,
    write_partition_append,
    write_partition_overwrite,
)

__all__ = [
    "append_as_dealt",
    "history_union",
    "ingest_articles",
    "load_table",
    "read_csv_export",
    "read_payload_files",
    "rejected_articles",
    "rejected_payloads",
    "write_csv_export",
    "write_overwrite",
    "write_partition_append",
    "write_partition_overwrite",
]
