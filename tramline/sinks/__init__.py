"""Where rows go: files, batches conformed to a table, and table-write protocols."""

from tramline.sinks.commits import CommittedTable, Conflict
from tramline.sinks.conform import (
    SchemaDrift,
    accepted,
    align_by_name,
    load_continue,
    load_report,
    rejected,
    schema_guard,
)
from tramline.sinks.files import (
    write_date_folders,
    write_json,
    write_parquet,
    write_parquet_chunked,
)
from tramline.sinks.tables import (
    append_load,
    complete_days,
    full_refresh,
    restore,
    incremental_append,
    ingest_days_if_complete,
    late_rows,
    materialize,
    read_if_present,
    replace_by_date,
    replace_days,
)

__all__ = [
    "CommittedTable", "Conflict", "SchemaDrift", "accepted", "align_by_name", "append_load", "complete_days", "full_refresh", "restore",
    "incremental_append", "ingest_days_if_complete", "late_rows", "load_continue", "load_report",
    "materialize", "read_if_present", "rejected", "replace_by_date", "replace_days",
    "schema_guard", "write_date_folders", "write_json", "write_parquet", "write_parquet_chunked",
]
