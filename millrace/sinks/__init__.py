"""Table and report sinks."""

from millrace.sinks.metrics import store_states, stored_states
from millrace.sinks.reports import csv_new, csv_report
from millrace.sinks.slots import read_keys, reslot, slots_for, upsert_slotted_table
from millrace.sinks.tables import (
    create_table_like,
    insert_by_name,
    overwrite_partitions,
    publish_snapshot,
    upsert_partitioned_table,
    upsert_partitions,
    upsert_table,
    write,
    write_counted,
    write_snapshot,
)

__all__ = [
    "create_table_like",
    "csv_new",
    "csv_report",
    "insert_by_name",
    "overwrite_partitions",
    "publish_snapshot",
    "read_keys",
    "reslot",
    "slots_for",
    "store_states",
    "stored_states",
    "upsert_partitioned_table",
    "upsert_partitions",
    "upsert_slotted_table",
    "upsert_table",
    "write",
    "write_counted",
    "write_snapshot",
]
