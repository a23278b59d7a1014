"""Registration of named queries and the SQL that yields the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import EXACT_TEXT
from millrace.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the test tables, with its check if SQL has one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_INPUTS: dict[tuple[str, str, str], str] = {}


def input_file(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], object]
) -> str:
    """Path of an input that a query reads, written once per session.

    Queries that are run again, such as by the bench, then take the time of
    the operator alone.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _INPUTS:
        path = fresh_path(spark, label)
        write(path)
        _INPUTS[key] = path
    return _INPUTS[key]


def csv_input(spark: SparkSession, sf_dir: str, name: str, sep: str = ",") -> str:
    """Path of a table as delimited text."""
    label = f"{name}-csv-{ord(sep)}"
    return input_file(spark, sf_dir, label, lambda p: write_csv(table(spark, sf_dir, name), p, sep))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Delimited input file for the queries that read one."""
    (
        df.write.options(**EXACT_TEXT)
        .option("header", True)
        .option("sep", sep)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path
