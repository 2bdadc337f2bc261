"""Where rows come from: landed files, page plans, audits and date ranges."""

from tramline.sources.audit import IncompleteLanding, landing_audit, require_complete
from tramline.sources.catalog import RAW_SOURCES, register_sources
from tramline.sources.census import LandedDay, landed_days, read_range, widens
from tramline.sources.files import (
    full_scan,
    scan_glob,
    broken_files,
    scan_hourly_json,
    scan_json_rows,
    scan_parquet_day,
    scan_xml_rows,
)
from tramline.sources.paging import missing_pages, page_plan
from tramline.sources.payloads import (
    array_position_seq,
    envelope_totals,
    promised_by_day,
    scan_xml_pages,
    unwrap_json_envelope,
    unwrap_json_list,
    unwrap_xml,
    xml_totals,
)
from tramline.sources.ranges import (
    MissingDays,
    absent_days,
    backfill_range,
    date_hour_spine,
    previous_month,
    previous_month_bounds,
)

__all__ = [
    "IncompleteLanding", "LandedDay", "MissingDays", "RAW_SOURCES", "absent_days", "array_position_seq",
    "backfill_range", "date_hour_spine", "envelope_totals", "full_scan", "landed_days", "landing_audit", "missing_pages",
    "page_plan", "previous_month", "previous_month_bounds", "promised_by_day", "read_range", "register_sources",
    "require_complete", "broken_files", "scan_glob", "scan_hourly_json", "scan_json_rows", "scan_parquet_day",
    "scan_xml_rows", "unwrap_json_envelope", "scan_xml_pages", "unwrap_json_list", "unwrap_xml", "widens",
    "xml_totals",
]
