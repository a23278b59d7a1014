"""Scans of tables that a catalog describes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.catalog_types import (
    MissingMetadataError,
    catalog_to_struct,
    storage_descriptor,
)
from millrace.functions.names import quoted
from millrace.functions.uri import rewrite_path_scheme
from millrace.sources.files import scan_table


# Marks metadata documents that describe tables of Spark's own catalog.
SESSION_CATALOG = "session"


def table_metadata(spark: SparkSession, name: str) -> dict[str, Any]:
    """Metadata document of a table in Spark's own catalog.

    Raises if the table does not exist. The location is the one that
    ``DESCRIBE EXTENDED`` reports; a view has none.
    """
    if not spark.catalog.tableExists(name):
        raise MissingMetadataError(f"no table or view named {name}")
    columns = spark.catalog.listColumns(name)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    details = {row["col_name"]: row["data_type"] for row in described}
    descriptor: dict[str, Any] = {
        "Columns": [
            {"Name": c.name, "Type": c.dataType} for c in columns if not c.isPartition
        ],
    }
    if details.get("Location"):
        descriptor["Location"] = details["Location"]
    if any(c.isBucket for c in columns):
        # Rows are hashed over the columns in their declared order.
        declared = details["Bucket Columns"]
        descriptor["BucketColumns"] = [
            name.replace("``", "`") for name in re.findall(r"`((?:[^`]|``)*)`", declared)
        ]
        descriptor["NumberOfBuckets"] = int(details["Num Buckets"])
    return {
        "Table": {
            "Name": name,
            "Catalog": SESSION_CATALOG,
            "StorageDescriptor": descriptor,
            "PartitionKeys": [
                {"Name": c.name, "Type": c.dataType} for c in columns if c.isPartition
            ],
        }
    }


def catalog_scan(
    spark: SparkSession, metadata: Mapping[str, Any] | None, fmt: str = "parquet"
) -> DataFrame:
    """Scan what a metadata document describes, with the schema it declares.

    A table without partitions, or whose partitions lie below its location in
    folders named after them, is read from its location. Partitions may lie
    anywhere: those of a table in Spark's own catalog are found by the catalog,
    and other documents list them as ``Partitions``, each with its ``Values``
    and ``StorageDescriptor.Location``; nothing else is read then.
    """
    schema = catalog_to_struct(metadata)
    table = metadata["Table"]  # type: ignore[index]
    keys = [key["Name"] for key in table.get("PartitionKeys") or []]
    if keys and table.get("Catalog") == SESSION_CATALOG:
        return spark.table(table["Name"]).select(*[f"`{name}`" for name in schema.names])
    if keys and "Partitions" in metadata:  # type: ignore[operator]
        return _scan_partitions(spark, metadata["Partitions"], schema, keys, fmt)  # type: ignore[index]
    location = storage_descriptor(metadata).get("Location")
    if not location:
        raise MissingMetadataError("Table.StorageDescriptor.Location is missing")
    return scan_table(spark, rewrite_path_scheme(location), fmt, schema)


def _scan_partitions(
    spark: SparkSession,
    partitions: Sequence[Mapping[str, Any]],
    schema: T.StructType,
    keys: Sequence[str],
    fmt: str,
) -> DataFrame:
    """Rows of the listed partitions.

    Those whose folders are named ``key=value`` are read together with all others
    below the same folder; Spark takes the values from the names. The rest are
    read one by one, with the values that are listed.
    """
    stored = T.StructType([f for f in schema.fields if f.name not in keys])
    together: dict[str, list[str]] = {}
    frames = []
    for partition in partitions:
        place = storage_descriptor({"Table": partition}).get("Location")
        if not place:
            raise MissingMetadataError("Partitions hold no StorageDescriptor.Location")
        place = rewrite_path_scheme(place).rstrip("/")
        parts = place.rsplit("/", len(keys))
        if [part.split("=", 1)[0] for part in parts[1:]] == list(keys):
            together.setdefault(parts[0], []).append(place)
            continue
        values = {
            key: F.lit(value).cast(schema[key].dataType)
            for key, value in zip(keys, partition["Values"], strict=True)
        }
        frames.append(scan_table(spark, place, fmt, stored).withColumns(values))
    for base, places in together.items():
        reader = spark.read.format(fmt).schema(schema).option("basePath", base)
        frames.append(reader.load(places))
    if not frames:
        return spark.createDataFrame([], schema)
    names = [f"`{name}`" for name in schema.names]
    return reduce(DataFrame.unionByName, [frame.select(*names) for frame in frames])


def view_scan(spark: SparkSession, name: str) -> DataFrame:
    """All columns of a table or view by name."""
    return spark.table(name)
