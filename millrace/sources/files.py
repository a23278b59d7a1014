"""File scans: delimited text and columnar formats."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.workspace import sql_settings

# Options that keep every character of a text when it is written and read: blanks
# at its ends stay, quotes are doubled, and a backslash is like any other character.
EXACT_TEXT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Fixed value: bytes of input given to one task by the large-file reader.
LARGE_FILE_SPLIT_BYTES = 400_000_000


def scan_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Delimited text with a header line; every column is a string.

    Without a schema Spark reads one header line to name the columns and
    does not look at the data. Empty fields are NULL. A backslash before a
    quote escapes it; pass ``EXACT_TEXT`` as options for text whose quotes are
    doubled, such as what this library writes.
    """
    reader = spark.read.options(**(options or {})).option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Comma-separated text with types inferred from all of the data.

    Inference reads the input once more. Pass a schema to ``scan_csv`` where
    the types are known.
    """
    return spark.read.csv(path, header=True, sep=sep, inferSchema=True)


@contextmanager
def scan_splits(spark: SparkSession, split_bytes: int = LARGE_FILE_SPLIT_BYTES) -> Iterator[None]:
    """Give each scan task up to ``split_bytes`` of input inside the block."""
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": str(split_bytes)}):
        yield


def scan_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan of any format the session has a reader for.

    With a schema only its columns are read, and no file is opened to infer
    one.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
