"""Table, file and record sources."""

from millrace.sources.catalog import catalog_scan, table_metadata, view_scan
from millrace.sources.files import (
    LARGE_FILE_SPLIT_BYTES,
    scan_csv,
    scan_csv_inferred,
    scan_splits,
    scan_table,
)
from millrace.sources.multiline import scan_csv_multiline, text_records
from millrace.sources.records import infer_record_schema, promote_field, records_to_rows

__all__ = [
    "LARGE_FILE_SPLIT_BYTES",
    "catalog_scan",
    "infer_record_schema",
    "promote_field",
    "records_to_rows",
    "scan_csv",
    "scan_csv_inferred",
    "scan_csv_multiline",
    "scan_splits",
    "scan_table",
    "table_metadata",
    "text_records",
    "view_scan",
]
