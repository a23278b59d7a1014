"""Whole jobs: parameters, SQL text and table loads."""

from millrace.plans.loads import (
    custom_sql_job,
    load_append,
    load_event,
    load_insert_select,
    load_overwrite,
    load_overwrite_keyed,
    load_upsert,
    load_warehouse,
    quality_report,
    table_job,
)
from millrace.plans.params import JobParams, join_uri
from millrace.plans.sqljob import sql_job

__all__ = [
    "JobParams",
    "custom_sql_job",
    "join_uri",
    "load_append",
    "load_event",
    "load_insert_select",
    "load_overwrite",
    "load_overwrite_keyed",
    "load_upsert",
    "load_warehouse",
    "quality_report",
    "sql_job",
    "table_job",
]
