"""Whole load jobs: scan, stamp and write, for each way to keep a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.codec import decode_base64
from millrace.operators.dedup import dedup_latest
from millrace.operators.envelope import decode_envelope, event_frame, explode_records
from millrace.operators.quality import (
    Analyzer,
    Check,
    run_metrics,
    run_verification,
)
from millrace.operators.stamp import LOAD_TIME_COLUMN, stamp_load_time
from millrace.plans.params import JobParams
from millrace.plans.sqljob import sql_job
from millrace.sinks.reports import csv_report
from millrace.sinks.tables import (
    create_table_like,
    insert_by_name,
    upsert_table,
    write,
    write_counted,
)
from millrace.sources.catalog import catalog_scan, table_metadata
from millrace.sources.files import scan_csv
from millrace.sources.records import infer_record_schema
from millrace.workspace import stage


def load_append(
    spark: SparkSession,
    source: str,
    target: str,
    sep: str = ";",
    fmt: str = "parquet",
    at: datetime | Column | None = None,
) -> int:
    """Append a stamped file to a table; returns the number of rows."""
    return write_counted(stamp_load_time(scan_csv(spark, source, sep), at=at), target, fmt)


def load_overwrite(
    spark: SparkSession,
    source: str,
    target: str,
    sep: str = ",",
    fmt: str = "parquet",
    at: datetime | Column | None = None,
) -> int:
    """Replace a table by a stamped file; returns the number of rows."""
    rows = stamp_load_time(scan_csv(spark, source, sep), at=at)
    return write_counted(rows, target, fmt, mode="overwrite")


def load_overwrite_keyed(
    spark: SparkSession,
    source: str,
    target: str,
    keys: Sequence[str],
    ties: Sequence[str],
    sep: str = ",",
    fmt: str = "parquet",
    at: datetime | Column | None = None,
) -> int:
    """Replace a keyed table by the latest row per key of a stamped file."""
    rows = stamp_load_time(scan_csv(spark, source, sep), at=at)
    latest = dedup_latest(rows, keys, [LOAD_TIME_COLUMN], ties)
    return write_counted(latest, target, fmt, mode="overwrite")


def load_upsert(
    spark: SparkSession,
    source: str,
    table: str,
    root: str,
    keys: Sequence[str],
    ties: Sequence[str],
    sep: str = ";",
    at: datetime | Column | None = None,
) -> str:
    """Upsert a stamped file into a keyed catalog table.

    All rows of one load carry the same time, so ``ties`` picks the winner
    among repeats of a key within the file.
    """
    rows = stamp_load_time(scan_csv(spark, source, sep), at=at)
    return upsert_table(rows, table, root, keys, [LOAD_TIME_COLUMN], ties)


def load_event(
    spark: SparkSession,
    event: str | Mapping[str, Any],
    schema: T.StructType | None,
    table: str,
    root: str,
    keys: Sequence[str],
    ties: Sequence[str],
    at: datetime | Column | None = None,
    rest: str | None = None,
) -> str:
    """Upsert the records of one event into a keyed catalog table.

    Without a schema the fields are the union of those in the records, with
    the types of the table's columns where it has them. Fields of the table
    that the event lacks are NULL in its rows; fields that the table lacks
    raise an error, and nothing is loaded, unless ``rest`` names the table's
    VARIANT column that keeps them. The load time replaces the one that
    a record may carry. Records that do not decode are left out;
    ``quarantine`` shows them. An event is one value in the driver, and one
    task decodes it; for larger input see ``ingest_available``.
    """
    lines = event_frame(spark, event)
    if schema is None:
        texts = explode_records(lines).select(decode_base64(F.col("data")).alias("data"))
        schema = infer_record_schema(texts)
    if spark.catalog.tableExists(table):
        schema = _fitted(schema, spark.table(table).schema, rest)
    rows = stamp_load_time(decode_envelope(lines, schema, rest=rest), at=at)
    return upsert_table(rows, table, root, keys, [LOAD_TIME_COLUMN], ties)


def _fitted(event: T.StructType, stored: T.StructType, rest: str | None) -> T.StructType:
    """The fields to decode from an event for the rows of a stored table."""
    fields = T.StructType([f for f in stored.fields if f.name not in (LOAD_TIME_COLUMN, rest)])
    unknown = set(event.names) - set(stored.names)
    if unknown and rest is None:
        raise ValueError(f"the table has no columns for the fields {sorted(unknown)}")
    return fields


def load_insert_select(
    spark: SparkSession,
    source: str,
    table: str,
    sep: str = ";",
    location: str | None = None,
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Create a table from a file's columns if it is absent, and insert the file."""
    rows = scan_csv(spark, source, sep)
    if columns is not None:
        rows = rows.select(*columns)
    create_table_like(rows, table, location, partition_by=partition_by)
    insert_by_name(rows, table)


def load_warehouse(
    spark: SparkSession,
    source: str,
    connector: str,
    options: Mapping[str, str],
    sep: str = ";",
) -> None:
    """Overwrite a warehouse table through its connector.

    Account, credentials, database and table name are connector options; the
    connector has to be on the class path.
    """
    write(scan_csv(spark, source, sep), fmt=connector, mode="overwrite", options=options)


def quality_report(
    df: DataFrame,
    output: str,
    checks: Sequence[Check],
    analyzers: Sequence[Analyzer] = (),
    land: Sequence[str] = (),
) -> DataFrame:
    """Verify a table and keep the results and their metrics as CSV files.

    Each set of uniqueness columns takes a scan of its own. For text, which has
    to be read whole every time, name the checked columns in ``land``: they are
    then read once and kept in columnar form for the scans. Returns the results
    of the constraints.
    """
    base = output.rstrip("/")
    if land:
        df = stage(df.select(*land), "quality-input", measure=[]).df
    done = run_verification(df, checks)
    csv_report(done.results, f"{base}/verification-results")
    csv_report(done.metrics, f"{base}/verification-results-metrics")
    if analyzers:
        csv_report(run_metrics(df, analyzers), f"{base}/metrics")
    return done.results


def custom_sql_job(
    spark: SparkSession,
    params: JobParams,
    inputs: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run the SQL statement that a job was given as a parameter."""
    return sql_job(spark, params.require("custom_sql").custom_sql, inputs, args)


def table_job(spark: SparkSession, params: JobParams, fmt: str = "parquet") -> DataFrame:
    """Scan the table that a job was given by name, as the catalog describes it."""
    return catalog_scan(spark, table_metadata(spark, params.qualified_table), fmt)
