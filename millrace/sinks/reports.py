"""Small result tables as one delimited file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.sources.files import EXACT_TEXT
from millrace.workspace import stage


def csv_report(report: DataFrame, path: str, sep: str = ",") -> None:
    """Write a report as a single CSV file with a header.

    For metric and check tables only: they have one row per metric or
    constraint, however large the data is, and one task writes them all.
    """
    # Staged, so that the one task only writes rows that are there already.
    _write(stage(report, "report", measure=[]).df.coalesce(1), path, sep, "overwrite")


def csv_new(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write delimited text with a header; fail if the path exists."""
    _write(df, path, sep, "errorifexists")


def _write(df: DataFrame, path: str, sep: str, mode: str) -> None:
    df.write.mode(mode).options(**EXACT_TEXT).csv(path, sep=sep, header=True)
